"""Readers: declared-schema file tables, topic payloads, driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staygrid.sources.schemas import DATE_COLUMNS


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None, options: dict | None = None) -> DataFrame:
    """File-backed table. ``fmt`` is a parameter (parquet, orc, json, avro when its jar is present).

    Reader errors (missing path, unknown format) surface as Spark's own exceptions.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def parse_dates(df: DataFrame, columns=None) -> DataFrame:
    """Parse text columns to DATE once, at the boundary, as a cast does: ``yyyy-MM-dd``, with or
    without a time part. Malformed text becomes NULL instead of failing the job under ANSI mode.
    """
    cols = [c for c in (columns or DATE_COLUMNS) if c in df.columns]
    for c in cols:
        if dict(df.dtypes)[c] == "string":
            df = df.withColumn(c, F.col(c).try_cast("date"))
    return df


#: Column of a payload that is not JSON of the declared schema.
REJECTED = "_rejected"


def topic_payloads(spark: SparkSession, schema: T.StructType, fmt: str = "kafka",
                   options: dict | None = None, path: str | None = None) -> DataFrame:
    """A topic as a bounded table, earliest to latest: the payload's columns and ``_rejected``, the raw
    text of a record that cannot be parsed (NULL otherwise).

    With ``fmt="kafka"`` the options carry ``kafka.bootstrap.servers`` and ``subscribe``;
    any file format that yields a ``value`` column (e.g. ``text``) works the same way.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        opts.setdefault("endingOffsets", "latest")
    reader = spark.read.format(fmt).options(**opts)
    raw = reader.load(path) if path else reader.load()
    whole = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    parsed = F.from_json(F.col("value").cast("string"), whole, {"columnNameOfCorruptRecord": REJECTED})
    return raw.select(parsed.alias("r")).select("r.*")


def read_topic(spark: SparkSession, schema: T.StructType, fmt: str = "kafka",
               options: dict | None = None, path: str | None = None) -> DataFrame:
    """The topic's parsed payloads; ``rejected_records`` has the others."""
    return topic_payloads(spark, schema, fmt, options, path).filter(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_records(spark: SparkSession, schema: T.StructType, fmt: str = "kafka",
                     options: dict | None = None, path: str | None = None) -> DataFrame:
    """value: the raw text of the records that ``read_topic`` leaves out."""
    return topic_payloads(spark, schema, fmt, options, path).filter(F.col(REJECTED).isNotNull()) \
        .select(F.col(REJECTED).alias("value"))


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
