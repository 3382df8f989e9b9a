"""Structured Streaming jobs: de-duplicating ingest, cell enrichment, topic publishing.

Sources are any streaming format (``kafka`` in production, a file directory in tests);
every sink keeps its progress in a checkpoint folder under the shared ``spark.checkpoint.dir``
so a restarted query resumes where it stopped, and state stays bounded by watermarks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from staygrid.functions.geohash import valid_point, with_geohash

# Timestamps travel in JSON with full microsecond precision.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def topic_stream(spark: SparkSession, schema: T.StructType, options: dict) -> DataFrame:
    """Kafka topic as a stream of parsed JSON payloads."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema, JSON_OPTIONS).alias("r")).select("r.*")


def event_time(df: DataFrame, col: str, out: str = "event_ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); interpreted in the session zone (UTC)."""
    return df.withColumn(out, F.col(col).cast("timestamp"))


def dedup_within_watermark(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop redelivered rows: the first row per key is kept; state for a key is released once
    the watermark passes its event time plus ``delay``."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def ingest(stream: DataFrame, out_path: str, checkpoint: str, partition_by: list[str],
           fmt: str = "parquet", available_now: bool = True) -> StreamingQuery:
    """Append a stream into a partitioned columnar table (exactly-once file sink)."""
    w = (stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
         .partitionBy(*partition_by))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_path)


def daily_cell_enrichment(readings: DataFrame, hotels: DataFrame, ts: str, value: str,
                          delay: str = "1 hour", precision: int = 4) -> DataFrame:
    """Readings stream joined to static hotels on the geohash cell, averaged per hotel and
    UTC day. Append mode emits a day once the watermark passes its end, so state holds only
    open days; ``with_close`` closes the last ones. (Only matched readings: the dense grid with
    empty days stays a batch job.)"""
    timed = readings.withWatermark(ts, delay)
    usable = timed.filter(valid_point(F.col("lat"), F.col("lng")))
    tagged = with_geohash(usable, "lat", "lng", precision, "geohash", null_as_empty=True)
    joined = tagged.join(hotels.select(F.col("id").alias("hotel_id"), "geohash"), "geohash")
    return (joined.groupBy(F.window(ts, "1 day"), "hotel_id")
            .agg(F.avg(value).alias("avg_value"), F.count(F.lit(1)).alias("n"))
            .select("hotel_id", F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "avg_value", "n"))


def with_close(stream: DataFrame, ts: str, marks: str, fill: dict | None = None) -> DataFrame:
    """``stream`` together with the rows of the folder ``marks`` (a time in ``ts``, ``fill``'s values, all
    else NULL). A mark far ahead, written by ``close_stream`` once the source has ended, moves the
    watermark past every open window, so a last run emits them all; the mark's own window stays
    open. ``fill`` must carry a mark through the job's filters, which Spark may apply before the
    watermark."""
    spark = stream.sparkSession
    kind = T.StructType([T.StructField(ts, T.TimestampType())])
    spark.createDataFrame([], kind).coalesce(1).write.mode("append").parquet(marks)
    ends = spark.readStream.schema(kind).parquet(marks)
    rest = [F.lit((fill or {}).get(f.name)).cast(f.dataType).alias(f.name) for f in stream.schema.fields if f.name != ts]
    return stream.unionByName(ends.select(F.col(ts), *rest))


def close_stream(spark: SparkSession, ts: str, marks: str, at: str = "9999-01-01 00:00:00") -> None:
    spark.range(1).select(F.lit(at).cast("timestamp").alias(ts)).write.mode("append").parquet(marks)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had closed their window, over the query's progress."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress
               for op in p["stateOperators"])


def publish_stream(stream: DataFrame, checkpoint: str, fmt: str = "kafka", topic: str | None = None,
                   options: dict | None = None, path: str | None = None,
                   available_now: bool = True) -> StreamingQuery:
    """Stream rows to a topic as JSON ``value`` (Kafka sink), or as text lines to ``path``."""
    records = stream.select(F.to_json(F.struct(*[F.col(c) for c in stream.columns]), JSON_OPTIONS).alias("value"))
    w = records.writeStream.option("checkpointLocation", checkpoint).options(**(options or {}))
    if fmt == "kafka":
        w = w.format("kafka")
        if topic:
            w = w.option("topic", topic)
    else:
        w = w.format(fmt).option("path", path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
