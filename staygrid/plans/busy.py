"""Busiest hotels per calendar month; a stay counts in every month it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.functions.calendar import explode_stay_months
from staygrid.operators.topk import topk_rows


def monthly_visits(bookings: DataFrame) -> DataFrame:
    """(year, month, hotel_id, visits) with visits = SUM(adults) + SUM(children); a group
    whose children are all NULL has NULL visits."""
    months = explode_stay_months(bookings.select("hotel_id", "srch_ci", "srch_co",
                                                 "srch_adults_cnt", "srch_children_cnt"),
                                 "srch_ci", "srch_co")
    return (months
            .groupBy(F.year("month_date").alias("year"), F.month("month_date").alias("month"), "hotel_id")
            .agg((F.sum("srch_adults_cnt") + F.sum("srch_children_cnt")).alias("visits")))


def busy_hotels(bookings: DataFrame, k: int = 10) -> DataFrame:
    """year, month, rank, hotel_id, visits_per_month: top k hotels of each month (row_number,
    hotel_id breaks ties), newest month first."""
    ranked = topk_rows(monthly_visits(bookings), ["year", "month"],
                       [F.desc_nulls_last("visits"), F.asc("hotel_id")], k)
    return (ranked
            .select("year", "month", "rank", "hotel_id", F.col("visits").cast("long").alias("visits_per_month"))
            .orderBy(F.desc("year"), F.desc("month"), "rank"))
