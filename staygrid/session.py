"""Session construction and the shared folder used for lineage cuts and stream state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC dates, AQE re-planning (partition coalescing and
# skew-join splitting), and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "staygrid", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the submitter supplies master and sizing."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``. On a cluster it must be set;
    a single local JVM (tests, bench) gets a private folder where it is not."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="staygrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (stream state, written tables); its
    writers create it."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df):
    """``df.checkpoint()`` into the shared checkpoint folder (set from the session, or a
    private folder only when none is configured). Cuts lineage; survives executor loss."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


class utc_session:
    """Run a block with the session time zone set to UTC (event-time windows are UTC days),
    restoring the caller's setting afterwards."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.prev = None

    def __enter__(self):
        self.prev = self.spark.conf.get("spark.sql.session.timeZone")
        self.spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.spark

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.session.timeZone", self.prev)
        return False
