"""Top hotels by their largest in-month temperature range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.operators.topk import topk_ties_global


def monthly_temperature_range(hotels_weather: DataFrame, measure: str = "avg_tmpr_c") -> DataFrame:
    """|max - min| of the measure per (hotel id, name, year, month); map-side partial
    aggregation keeps the shuffle at one row per key and input partition."""
    return (hotels_weather
            .groupBy("id", "name", F.year("wthr_date").alias("year"), F.month("wthr_date").alias("month"))
            .agg(F.abs(F.max(measure) - F.min(measure)).alias("difference")))


def temperature_range_topk(hotels_weather: DataFrame, k: int = 10,
                           measure: str = "avg_tmpr_c") -> DataFrame:
    """rank, hotel_id, hotel_name, max_tmpr_c_diff for the k largest monthly ranges (ties
    kept, NULL ranges rank last)."""
    per_hotel = (monthly_temperature_range(hotels_weather, measure)
                 .groupBy("id", "name")
                 .agg(F.max("difference").alias("max_tmpr_c_diff")))
    return _ranked(per_hotel, k)


def _ranked(per_hotel: DataFrame, k: int) -> DataFrame:
    ranked = topk_ties_global(per_hotel, "max_tmpr_c_diff", k)
    return ranked.select("rank", F.col("id").alias("hotel_id"), F.col("name").alias("hotel_name"),
                         "max_tmpr_c_diff")


def temperature_range_by_cell(hotels: DataFrame, cells: DataFrame, k: int = 10) -> DataFrame:
    """The same from the hotels and the readings' (wthr_date, geohash) averages: the extremes are
    taken per (cell, year, month) and only then joined to the hotels, so the table of all hotels
    on all dates is never made. Hotels without readings have a NULL range; without any reading
    date there is no result, as the dates make the rows."""
    extremes = (cells.filter(F.col("geohash").isNotNull() & F.col("wthr_date").isNotNull())
                .groupBy("geohash", F.year("wthr_date").alias("year"), F.month("wthr_date").alias("month"))
                .agg(F.max("avg_tmpr_c").alias("hi"), F.min("avg_tmpr_c").alias("lo")))
    any_reading = cells.agg(F.count(F.lit(1)).alias("n")).scalar() > 0
    h = hotels.select("id", "name", "geohash").distinct().filter(any_reading)
    per_hotel = (h.join(extremes, "geohash", "left").groupBy("id", "name", "year", "month")
                 .agg((F.max("hi") - F.min("lo")).alias("difference"))
                 .groupBy("id", "name").agg(F.max("difference").alias("max_tmpr_c_diff")))
    return _ranked(per_hotel, k)
