import datetime as dt

from pyspark.sql import functions as F

from staygrid.functions.calendar import explode_offsets, explode_stay_days, explode_stay_months


def test_offsets_include_n_and_clamp_negative_and_skip_null(spark):
    df = spark.createDataFrame([(1, 2), (2, -3), (3, None), (4, 0)], "k int, n int")
    out = explode_offsets(df, F.col("n")).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in out} == {1: 3, 2: 1, 4: 1}


def test_stay_days_include_checkout(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2020, 1, 9))], "ci date, co date")
    days = [r.visit_date for r in explode_stay_days(df, "ci", "co").collect()]
    assert len(days) == 9 and days[-1] == dt.date(2020, 1, 9)


def test_month_span_truncates(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 31), dt.date(2020, 2, 1)),
                                (2, dt.date(2020, 1, 15), dt.date(2020, 2, 15)),
                                (3, dt.date(2020, 3, 10), dt.date(2020, 2, 20))], "k int, ci date, co date")
    out = explode_stay_months(df, "ci", "co").select("k", F.month("month_date").alias("m")).collect()
    got = sorted((r.k, r.m) for r in out)
    assert got == [(1, 1), (2, 1), (2, 2), (3, 3)]
