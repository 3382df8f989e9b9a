"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables through ``sources.surrogates`` and runs a library job
over the whole tables. Floating results are rounded to 6 digits here (and in the oracle)
so that summation order cannot change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid.operators.profile import column_profile
from staygrid.operators.statistics import merged_statistics, stored_statistics, update_statistics
from staygrid.plans import bookings as bk
from staygrid.plans.busy import busy_hotels
from staygrid.plans.enrichment import daily_cell_weather, enrich_hotels, publish_enrichment, publish_weather
from staygrid.plans.temperature import temperature_range_by_cell, temperature_range_topk
from staygrid.plans.trend import weather_trend_by_cell
from staygrid.sources import surrogates as sg
from staygrid.session import shared_dir
from staygrid.sources.incremental import IncrementalCopy
from staygrid.sources.readers import driver_table, parse_dates, read_table, read_topic
from staygrid.sources.schemas import (EXPEDIA, HOTELS, HOTELS_PAYLOAD, HOTELS_WEATHER, RESULT_BUSY_HOTELS,
                                      RESULT_TMPR_DIFF, RESULT_WTHR_TREND, WEATHER)
from staygrid.sources.writers import (ingest_columnar, publish_json, write_by_year, write_overwrite,
                                      write_result_table)

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn
    return deco


def registry() -> dict[str, Query]:
    # geo and streaming modules register on import
    from staygrid import geo_queries, stream_queries  # noqa: F401
    return dict(_REGISTRY)


def round6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_hotels(sg.hotels(spark, sf_dir), sg.weather(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bk.clean_bookings(sg.bookings(spark, sf_dir))


@register("temp_range_topk")
def q_temp_range_topk(spark, sf_dir):
    cells = daily_cell_weather(sg.weather(spark, sf_dir))
    return round6(temperature_range_by_cell(sg.hotels(spark, sf_dir), cells), "max_tmpr_c_diff")


@register("temp_range_topk_readings")
def q_temp_range_topk_readings(spark, sf_dir):
    li = driver_table(spark, sf_dir, "lineitem")
    s = driver_table(spark, sf_dir, "supplier")
    readings = li.join(s, li.l_suppkey == s.s_suppkey).select(
        F.col("l_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.to_date("l_shipdate").alias("wthr_date"),
        (F.col("l_quantity") - F.lit(15.0)).alias("avg_tmpr_c"))
    return round6(temperature_range_topk(readings), "max_tmpr_c_diff")


@register("hotel_weather_enriched")
def q_hotel_weather_enriched(spark, sf_dir):
    return round6(enriched(spark, sf_dir), "avg_tmpr_f", "avg_tmpr_c")


@register("busy_hotels")
def q_busy_hotels(spark, sf_dir):
    return busy_hotels(sg.bookings(spark, sf_dir))


@register("weather_trend")
def q_weather_trend(spark, sf_dir):
    cells = daily_cell_weather(sg.weather(spark, sf_dir))
    out = weather_trend_by_cell(sg.trend_bookings(spark, sf_dir), sg.hotels(spark, sf_dir), cells)
    return round6(out, "checkin_tmpr", "checkout_tmpr", "weather_trend", "avg_tmpr_during_stay")


@register("idle_days")
def q_idle_days(spark, sf_dir):
    return bk.with_idle_days(sg.bookings(spark, sf_dir))


@register("invalid_hotels")
def q_invalid_hotels(spark, sf_dir):
    return bk.invalid_hotels_info(sg.bookings(spark, sf_dir), sg.hotel_info(spark, sf_dir))


@register("clean_bookings")
def q_clean_bookings(spark, sf_dir):
    return cleaned(spark, sf_dir)


@register("booking_audit")
def q_booking_audit(spark, sf_dir):
    return bk.booking_audit(sg.bookings(spark, sf_dir))


@register("bookings_by_country")
def q_bookings_by_country(spark, sf_dir):
    return bk.booking_counts(cleaned(spark, sf_dir), sg.hotel_info(spark, sf_dir), "country")


@register("bookings_by_city")
def q_bookings_by_city(spark, sf_dir):
    return bk.booking_counts(cleaned(spark, sf_dir), sg.hotel_info(spark, sf_dir), "city")


@register("weather_to_json")
def q_weather_to_json(spark, sf_dir):
    """Q1: weather published to the topic (text sink standing in for the broker), read back as
    a bounded table with the declared schema."""
    topic = f"{shared_dir(spark, 'weather_topic')}/topic"
    publish_weather(sg.weather(spark, sf_dir), fmt="text", path=topic)
    return parse_dates(read_topic(spark, WEATHER, fmt="text", path=topic))


# ---------------------------------------------------------------- sinks, written then read back

@register("bookings_by_year_write")
def q_bookings_by_year_write(spark, sf_dir):
    """Valid bookings stored as Parquet partitioned by check-in year, read back."""
    path = f"{shared_dir(spark, 'expedia_validated')}/table"
    write_by_year(cleaned(spark, sf_dir), path)
    return spark.read.parquet(path)


def published(spark, sf_dir):
    """Q2b: the enrichment materialised once and fed to the topic and to the external table."""
    root = shared_dir(spark, "hotels_weather")
    external = publish_enrichment(spark, enriched(spark, sf_dir), f"{root}/staging", f"{root}/external",
                                  fmt="text", topic_path=f"{root}/topic")
    return external, f"{root}/topic"


@register("enrichment_publish")
def q_enrichment_publish(spark, sf_dir):
    """The topic payload of the published enrichment, parsed with the declared schema."""
    _, topic = published(spark, sf_dir)
    return round6(parse_dates(read_topic(spark, HOTELS_WEATHER, fmt="text", path=topic)), "avg_tmpr_f", "avg_tmpr_c")


@register("enrichment_external")
def q_enrichment_external(spark, sf_dir):
    """The external Parquet copy of the published enrichment, read back."""
    external, _ = published(spark, sf_dir)
    return round6(external, "avg_tmpr_f", "avg_tmpr_c")


@register("bookings_bucketed")
def q_bookings_bucketed(spark, sf_dir):
    """Bookings copied into a columnar table partitioned by check-in year and bucketed by
    hotel, then read back through the catalog."""
    root = shared_dir(spark, "expedia_bucketed")
    src = sg.bookings(spark, sf_dir).withColumn("ci_year", F.year("srch_ci"))
    ingest_columnar(src, "expedia_bucketed", "ci_year", "hotel_id", buckets=8, path=f"{root}/table")
    return spark.table("expedia_bucketed").select(*src.columns)


def booking_batches(spark, sf_dir):
    """(name, rows) of the bookings as they come in: a first load in which every fiftieth booking has
    wrong dates and guests, a batch that repeats known rows, the same batch once more, and a last one
    that brings the other bookings and the corrections."""
    b, k = sg.bookings(spark, sf_dir), F.col("id")
    wrong = k % 50 == 0
    first = b.filter(k % 10 < 6).withColumns({
        "srch_ci": F.when(wrong, F.date_sub("srch_ci", 40)).otherwise(F.col("srch_ci")),
        "srch_adults_cnt": F.when(wrong, F.col("srch_adults_cnt") + 1).otherwise(F.col("srch_adults_cnt"))})
    second = b.filter((k % 10).between(5, 8))
    return [("load", first), ("second", second), ("second", second), ("last", b.filter((k % 10 == 9) | wrong))]


BUCKETS = 8


def stored_by_hotel(spark, sf_dir):
    """Bookings and hotel descriptions stored with like buckets: (by hotel_id, by id)."""
    out = []
    for name, rows, key in (("bookings_by_hotel", sg.bookings(spark, sf_dir), "hotel_id"), ("info_by_hotel", sg.hotel_info(spark, sf_dir), "id")):
        root = shared_dir(spark, name)
        table = f"{name}_{root.rsplit('-', 1)[-1]}"
        ingest_columnar(rows, table, None, key, BUCKETS, path=f"{root}/table")
        out.append(spark.table(table))
    return out


@register("clean_bookings_bucketed")
def q_clean_bookings_bucketed(spark, sf_dir):
    return bk.clean_bucketed(stored_by_hotel(spark, sf_dir)[0])


@register("invalid_hotels_bucketed")
def q_invalid_hotels_bucketed(spark, sf_dir):
    return bk.invalid_hotels_bucketed(*stored_by_hotel(spark, sf_dir))


@register("booking_audit_observed")
def q_booking_audit_observed(spark, sf_dir):
    """The audit's counts, observed while the cleaned bookings are written."""
    counts = bk.write_cleaned(stored_by_hotel(spark, sf_dir)[0], f"{shared_dir(spark, 'cleaned')}/table")
    names = ["rows_before", "rows_after", "rows_removed", "invalid_hotels"]
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))


@register("column_statistics")
def q_column_statistics(spark, sf_dir):
    """Statistics of the bookings stored by check-in year, one year at a time, and merged for the table. The
    sketches' answers come as a test of their error: the share of values up to the median is within 2 % of a half, the
    distinct count within 3 % of the exact one."""
    b = sg.bookings(spark, sf_dir).withColumn("ci_year", F.year("srch_ci"))
    path = f"{shared_dir(spark, 'statistics')}/table"
    columns = ["id", "user_id", "hotel_id", "srch_adults_cnt", "srch_children_cnt", "date_time"]
    for year in sorted(r[0] for r in b.select("ci_year").distinct().collect()):
        update_statistics(b.filter(F.col("ci_year") == year), "ci_year", path, columns)
    got = merged_statistics(stored_statistics(spark, path))
    exact = column_profile(b, columns, exact=True).select("column_name", F.col("distinct_count").alias("exact"))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.03)
    middle = b.agg(F.avg((F.col("id") <= got.filter("column_name = 'id'").select("q50").scalar()).cast("double")).alias("m")).first()[0]
    halved = F.when(F.col("column_name") == "id", F.lit(abs(middle - 0.5) < 0.02))
    return got.join(exact, "column_name").select("column_name", "null_count", "min_value", "max_value", F.round("avg_length", 6).alias("avg_length"),
                                                 "max_length", close.alias("distinct_close"), halved.alias("median_close"))


@register("bookings_incremental")
def q_bookings_incremental(spark, sf_dir):
    """Bookings copied batch by batch into a table partitioned by check-in month, read back."""
    copy = IncrementalCopy(spark, shared_dir(spark, "bookings_incremental"), key="id", date="srch_ci", unit="month")
    for name, rows in booking_batches(spark, sf_dir):
        copy.apply(rows, name)
    return copy.read()


@register("expedia_declared")
def q_expedia_declared(spark, sf_dir):
    """Bookings stored with their 20 columns and text dates, read through the declared schema,
    dates parsed at the boundary."""
    path = f"{shared_dir(spark, 'expedia')}/table"
    b = sg.bookings(spark, sf_dir)
    text = [(F.col(f.name) if f.name in b.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in EXPEDIA.fields]
    write_overwrite(b.select(*text), path)
    return parse_dates(read_table(spark, path, schema=EXPEDIA))


def result_table(spark, df, name, schema):
    """A result stored in its ORC table (created if absent, overwritten), read back."""
    typed = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return write_result_table(spark, typed, name, f"{shared_dir(spark, name)}/table", fmt="orc")


@register("busy_hotels_orc")
def q_busy_hotels_orc(spark, sf_dir):
    return result_table(spark, q_busy_hotels(spark, sf_dir), "result_busy_hotels", RESULT_BUSY_HOTELS)


@register("temp_range_orc")
def q_temp_range_orc(spark, sf_dir):
    return result_table(spark, q_temp_range_topk(spark, sf_dir), "result_tmpr_diff", RESULT_TMPR_DIFF)


@register("weather_trend_orc")
def q_weather_trend_orc(spark, sf_dir):
    return result_table(spark, q_weather_trend(spark, sf_dir), "result_wthr_trend", RESULT_WTHR_TREND)


@register("hotels_topic_roundtrip")
def q_hotels_topic_roundtrip(spark, sf_dir):
    """Hotels published with the producer's key case (Id, Name, ..., GeoHash), read back as a
    bounded topic with the declared payload schema and renamed to the table's columns."""
    root = shared_dir(spark, "hotels_topic")
    h = sg.hotels(spark, sf_dir)
    payload = h.select(*[F.col(t.name).alias(p.name) for t, p in zip(HOTELS.fields, HOTELS_PAYLOAD.fields)])
    publish_json(payload, fmt="text", path=f"{root}/topic")
    back = read_topic(spark, HOTELS_PAYLOAD, fmt="text", path=f"{root}/topic")
    return back.select(*[F.col(p.name).alias(t.name) for t, p in zip(HOTELS.fields, HOTELS_PAYLOAD.fields)])
