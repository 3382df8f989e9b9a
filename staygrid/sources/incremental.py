"""Incremental columnar copy of a row source: batches of new and corrected rows change only the
date partitions they touch, and a batch that comes again changes nothing.

A copy is a folder of three Parquet tables:

``table``    the rows, partitioned by a date unit (``_part``), each with its identity and row hash;
``pending``  per batch, the whole new content of the partitions that batch touches;
``ledger``   a row a batch that has been applied, with its counts.

A batch is applied in three steps. (1) Its rows are compared with the stored (identity, hash) pairs,
three narrow columns of the table; what is new or different, with all other rows of the touched
partitions, is written to ``pending``. (2) Those partitions are overwritten from there (dynamic
partition overwrite). (3) The batch enters the ledger. If a run ends between the steps, the next call
finds a complete pending batch without a ledger row and repeats step 2 from it, so no reader's
partition stays lost and no row enters twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Date unit of a partition: the pattern of its name. The letter before it keeps the name a text.
UNITS = {"day": "'d'yyyy-MM-dd", "month": "'m'yyyy-MM", "year": "'y'yyyy"}
NO_DATE = "none"
LEDGER = ("batch string, inserted long, updated long, unchanged long, superseded long, partitions long, "
          "rewritten long")
#: Internal columns of the stored rows.
OWN = ["_id", "_hash", "_gone", "_part"]


def _path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, for the folders' own bookkeeping."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def _row_hash(columns: list[str]) -> F.Column:
    """Hash of a row's values and of which of them are NULL (the hash alone skips NULLs)."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(*columns, nulls)


@dataclass
class IncrementalCopy:
    """``key`` names a row; ``version``, where given, tells which of several rows of one key in a batch
    is the latest (the greatest wins, NULL lowest; then the greater row hash). A row without a key is
    named by its content: it is stored once however often it comes. A row without a date lies in a
    partition of its own. All batches have the columns of the first one."""

    spark: SparkSession
    path: str
    key: str
    date: str
    unit: str = "day"
    version: str | None = None

    # ------------------------------------------------------------ reading

    def read(self) -> DataFrame:
        """The stored rows, with the columns of the batches."""
        rows = self._stored().filter(~F.col("_gone"))
        return rows.select(*[c for c in rows.columns if c not in OWN])

    def ledger(self) -> DataFrame:
        if not _exists(self.spark, f"{self.path}/ledger"):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger")

    def _stored(self) -> DataFrame:
        """All rows of the table; the schema lies beside it, so that an empty copy has its columns too."""
        schema = self.spark.read.parquet(f"{self.path}/schema").schema
        if not _exists(self.spark, f"{self.path}/table"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/table")

    def started(self) -> bool:
        """Whether a batch has ever come, so that ``read`` knows the columns."""
        return _exists(self.spark, f"{self.path}/schema")

    # ------------------------------------------------------------ writing

    def applied(self, name: str) -> Row | None:
        """The ledger row of a batch, after any interrupted one has been finished."""
        self._finish_pending()
        return self.ledger().filter(F.col("batch") == name).first()

    def apply(self, batch: DataFrame, name: str) -> Row:
        """Apply a batch; returns its ledger row. A name already in the ledger is a replay: nothing is
        read or written and the row of the first time comes back. ``superseded`` counts rows of
        the batch that a later row of the same key replaces, repeats included."""
        done = self.applied(name)
        if done:
            return done
        if set(batch.columns) & set(OWN):
            raise ValueError(f"the copy keeps {OWN} for itself")
        if not self.started():
            self._prepared(batch).drop("_n").limit(0).write.parquet(f"{self.path}/schema")
        return self._commit(name, self._stage(batch.select(*[c for c in self._stored().columns if c not in OWN]), name))

    def _prepared(self, batch: DataFrame) -> DataFrame:
        """One row a key, the latest, with its identity, hash, partition and ``_n``, the number of the key's
        rows. An aggregate, so that a key with most of a batch's rows is merged where they lie."""
        columns = batch.columns
        part = F.coalesce(F.date_format(self.date, UNITS[self.unit]), F.lit(NO_DATE))
        rows = batch.withColumn("_hash", _row_hash(columns))
        # a key's text starts with k, a content's with c: no key looks like a content
        rows = rows.withColumn("_id", F.coalesce(F.concat(F.lit("k"), F.col(self.key).cast("string")),
                                                 F.concat(F.lit("c"), F.col("_hash").cast("string"))))
        latest = F.struct(*([self.version] if self.version else []), "_hash")
        last = rows.groupBy("_id").agg(F.max_by(F.struct(*columns, "_hash"), latest).alias("r"), F.count(F.lit(1)).alias("_n"))
        return last.select("r.*", "_id", "_n").select(*columns, "_id", "_hash", F.lit(False).alias("_gone"), part.alias("_part"), "_n")

    def _stage(self, batch: DataFrame, name: str) -> dict:
        """Write the new content of the touched partitions to ``pending``; returns the counts."""
        columns, work = batch.columns, f"{self.path}/pending/{name}"
        self._prepared(batch).write.mode("overwrite").parquet(f"{work}/batch")
        rows, stored = self.spark.read.parquet(f"{work}/batch"), self._stored().filter(~F.col("_gone"))
        known = stored.select(F.col("_id").alias("_k"), F.col("_hash").alias("_h"), F.col("_part").alias("_old"))
        changes = rows.join(known, F.col("_id") == F.col("_k"), "left").filter(
            F.col("_h").isNull() | (F.col("_h") != F.col("_hash"))).drop("_k", "_h", "_n")
        changes.write.mode("overwrite").parquet(f"{work}/changes")
        changes = self.spark.read.parquet(f"{work}/changes")
        # partition names, one a date unit
        touched = [r[0] for r in changes.select(F.explode(F.array("_part", "_old")).alias("p"))
                   .filter("p IS NOT NULL").distinct().collect()]
        # a row that moves leaves its identity behind, so that its old partition is never without
        # rows and is overwritten too; the next change of that partition drops it
        moved = changes.filter(F.col("_old") != F.col("_part")).select(
            *[F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in columns],
            "_id", "_hash", F.lit(True).alias("_gone"), F.col("_old").alias("_part"))
        kept = stored.filter(F.col("_part").isin(touched)).join(changes.select("_id"), "_id", "left_anti")
        content = changes.select(*columns, *OWN).unionByName(moved).unionByName(kept.select(*columns, *OWN))
        content.write.mode("overwrite").parquet(f"{work}/content")
        given, distinct = rows.agg(F.sum("_n"), F.count(F.lit(1))).first()
        counts = changes.agg(F.count_if(F.col("_old").isNull()), F.count_if(F.col("_old").isNotNull())).first()
        return {"inserted": counts[0], "updated": counts[1], "unchanged": distinct - counts[0] - counts[1],
                "superseded": (given or 0) - distinct, "partitions": len(touched),
                "rewritten": self.spark.read.parquet(f"{work}/content").count()}

    def _commit(self, name: str, counts: dict) -> Row:
        row = Row(batch=name, **counts)
        self.spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/pending/{name}/entry")
        self._finish(name)
        return row

    def _finish(self, name: str) -> None:
        """Put a batch's content in the place of its partitions and enter it in the ledger. Rows are dealt
        by partition, so each task writes few files and AQE splits a large partition."""
        work = f"{self.path}/pending/{name}"
        entry = self.spark.read.schema(LEDGER).parquet(f"{work}/entry")
        if entry.first().partitions:
            (self.spark.read.parquet(f"{work}/content").hint("rebalance", "_part").write.mode("overwrite")
             .partitionBy("_part").option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/table"))
        entry.write.mode("append").parquet(f"{self.path}/ledger")
        fs, p = _path(self.spark, work)
        fs.delete(p, True)

    def _finish_pending(self) -> None:
        """Batches left between the steps: those whose entry is whole are finished (again), unless the
        ledger has them already."""
        fs, p = _path(self.spark, f"{self.path}/pending")
        names = sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
        done = {r.batch for r in self.ledger().filter(F.col("batch").isin(names)).collect()} if names else set()
        for name in names:
            if name not in done and _exists(self.spark, f"{self.path}/pending/{name}/entry/_SUCCESS"):
                self._finish(name)
