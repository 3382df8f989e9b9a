"""Registered streaming jobs. Each runs its query to completion (availableNow) in a fresh
folder under the shared checkpoint folder and returns a batch read of the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from staygrid.registry import register, round6
from staygrid.session import shared_dir, utc_session
from staygrid.sources import surrogates as sg
from staygrid.sources.readers import driver_table
from staygrid.streaming import jobs, restate

EVENTS_GLOB = "events.parquet"
WATERMARK_DELAY = "1 hour"
READING_LAT_SHIFT = 0.01


def _events_stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{EVENTS_GLOB}").schema
    return jobs.file_stream(spark, sf_dir, schema, glob=EVENTS_GLOB)


@register("stream_ingest_dedup")
def q_stream_ingest_dedup(spark, sf_dir):
    """Every event delivered twice (two readers of the same source); the ingest keeps one
    copy per event_id and writes it partitioned by day."""
    root = shared_dir(spark, "stream_ingest_dedup")
    with utc_session(spark):
        both = _events_stream(spark, sf_dir).unionByName(_events_stream(spark, sf_dir))
        timed = jobs.event_time(both, "ts")
        dedup = jobs.dedup_within_watermark(timed, ["event_id"], "event_ts", WATERMARK_DELAY)
        out = dedup.withColumn("d", F.to_date("ts"))
        q = jobs.ingest(out.drop("event_ts"), f"{root}/out", f"{root}/ckpt", ["d"])
        q.awaitTermination()
    cols = [c for c in spark.read.parquet(f"{sf_dir.rstrip('/')}/{EVENTS_GLOB}").columns]
    return spark.read.parquet(f"{root}/out").select(*cols)


@register("stream_enrich_daily")
def q_stream_enrich_daily(spark, sf_dir):
    """Event values as readings located near hotel ``user_id``'s site, averaged per hotel
    and day. The job runs to the source's end, then closes the days still open."""
    root = shared_dir(spark, "stream_enrich_daily")
    with utc_session(spark):
        ev = jobs.event_time(_events_stream(spark, sf_dir), "ts")
        u = F.col("user_id")
        readings = ev.select("event_ts", "value",
                             (sg.site_lat(u) + F.lit(READING_LAT_SHIFT)).alias("lat"), sg.site_lng(u).alias("lng"))
        whole = jobs.with_close(readings, "event_ts", f"{root}/marks", {"lat": 0.0, "lng": 0.0})
        daily = jobs.daily_cell_enrichment(whole, sg.hotels(spark, sf_dir), "event_ts", "value",
                                           WATERMARK_DELAY)
        # window bounds leave the stream as UTC wall-clock values
        flat = daily.select("hotel_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                            F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                            "avg_value", F.col("n").cast("long").alias("n"))

        def run():
            q = (flat.writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start(f"{root}/out"))
            q.awaitTermination()
            return jobs.late_rows(q)

        late = run()
        jobs.close_stream(spark, "event_ts", f"{root}/marks")
        late += run()
    if late:
        raise RuntimeError(f"{late} rows came later than {WATERMARK_DELAY}: widen the delay or re-run their days")
    return round6(spark.read.parquet(f"{root}/out"), "avg_value")


#: Files of a part of a disordered source; a micro-batch takes one part.
PART_FILES = 4


def disordered(spark, rows, key, name, parts=3):
    """A stream whose ``parts`` micro-batches each hold rows of all times: ``rows`` stored part by part."""
    path = f"{shared_dir(spark, name)}/source"
    for part in range(parts):
        mine = rows.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == part)
        mine.repartition(PART_FILES).write.mode("append").parquet(path)
    return jobs.file_stream(spark, path, rows.schema, max_files=PART_FILES)


@register("stream_enrich_restated")
def q_stream_enrich_restated(spark, sf_dir):
    """``stream_enrich_daily`` over readings that come out of order: later batches bring readings of
    days long past, which restate their days."""
    root = shared_dir(spark, "stream_enrich_restated")
    with utc_session(spark):
        u = F.col("user_id")
        readings = jobs.event_time(driver_table(spark, sf_dir, "events"), "ts").select(
            "event_id", "event_ts", "value", (sg.site_lat(u) + F.lit(READING_LAT_SHIFT)).alias("lat"), sg.site_lng(u).alias("lng"))
        stream = disordered(spark, readings, "event_id", "restated_source")
        copy = restate.daily_copy(spark, f"{root}/days", unit="month")
        restate.restate_days(stream, sg.hotels(spark, sf_dir), copy, f"{root}/late", f"{root}/ckpt", "event_ts", "value",
                             WATERMARK_DELAY).awaitTermination()
        day = F.col("day").cast("timestamp_ntz")
        out = copy.read().select("hotel_id", day.alias("window_start"), (day + F.expr("INTERVAL 1 DAY")).alias("window_end"),
                                 (F.col("total") / F.col("n_values")).alias("avg_value"), "n")
    return round6(out, "avg_value")


@register("stream_idle_days")
def q_stream_idle_days(spark, sf_dir):
    """Idle days kept over a stream of bookings that come out of order, as they stand at its end."""
    root = shared_dir(spark, "stream_idle_days")
    bookings = sg.bookings(spark, sf_dir)
    stream = disordered(spark, bookings.select("id", "hotel_id", "srch_ci"), "id", "idle_source")
    copy = restate.idle_copy(spark, f"{root}/idle", unit="year")
    restate.keep_idle_days(stream, copy, f"{root}/ckpt").awaitTermination()
    return bookings.join(copy.read().select("id", "idle_days"), "id").select(*bookings.columns, "idle_days")


@register("stream_publish")
def q_stream_publish(spark, sf_dir):
    """Events stream -> JSON records (text sink standing in for the topic) -> parsed back."""
    ev = _events_stream(spark, sf_dir)
    schema = ev.schema
    root = shared_dir(spark, "stream_publish")
    q = jobs.publish_stream(ev, f"{root}/ckpt", fmt="text", path=f"{root}/out")
    q.awaitTermination()
    back = spark.read.text(f"{root}/out")
    return back.select(F.from_json("value", schema, jobs.JSON_OPTIONS).alias("r")).select("r.*")
