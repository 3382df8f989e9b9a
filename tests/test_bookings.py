import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from staygrid.plans import bookings as bk

SCHEMA = "id long, hotel_id long, srch_ci date"


def d(day):
    return dt.date(2020, 1, 1) + dt.timedelta(days=day)


def test_gap_rule_and_taint(spark):
    rows = [(1, 10, d(0)), (2, 10, d(1)), (3, 10, d(31)),          # gaps 1, 30 -> valid hotel
            (4, 20, d(0)), (5, 20, d(2)),                          # gap 2 -> invalid
            (6, 30, d(0)), (7, 30, d(29)),                         # gap 29 -> invalid
            (8, None, d(0)), (9, None, d(5)),                      # NULL hotel, gap 5
            (10, 40, None), (11, 40, d(3))]                        # NULL check-in -> 0
    f = spark.createDataFrame(rows, SCHEMA)
    idle = {r.id: r.idle_days for r in bk.with_idle_days(f).collect()}
    assert idle == {1: 0, 2: 1, 3: 30, 4: 0, 5: 2, 6: 0, 7: 29, 8: 0, 9: 5, 10: 0, 11: 0}
    bad = {r.hotel_id for r in bk.invalid_hotels(f).collect()}
    assert bad == {20, 30, None}
    kept = {r.id for r in bk.clean_bookings(f).collect()}
    assert kept == {1, 2, 3, 8, 9, 10, 11}  # NULL hotel rows survive the anti-join
    audit = bk.booking_audit(f).first()
    assert (audit.rows_before, audit.rows_after, audit.rows_removed, audit.invalid_hotels) == (11, 7, 4, 3)


def test_same_day_bookings_get_zero_after_first(spark):
    rows = [(1, 1, d(0)), (3, 1, d(10)), (2, 1, d(10))]
    idle = {r.id: r.idle_days for r in bk.with_idle_days(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert idle == {1: 0, 2: 10, 3: 0}


def test_idle_days_equals_plain_window(spark):
    rng = random.Random(11)
    rows = [(i, rng.randrange(6), d(rng.randrange(120)) if rng.random() > 0.05 else None) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    w = Window.partitionBy("hotel_id").orderBy(F.col("srch_ci").asc_nulls_first(), "id")
    ref = df.withColumn("ref", F.coalesce(F.datediff("srch_ci", F.lag("srch_ci").over(w)), F.lit(0)))
    got = bk.with_idle_days(df).join(ref.select("id", "ref"), "id")
    assert got.filter(F.col("idle_days") != F.col("ref")).count() == 0


def test_counts_follow_left_join_multiplicity(spark):
    f = spark.createDataFrame([(1, 1, d(0)), (2, 2, d(0)), (3, 9, d(0))], SCHEMA)
    info = spark.createDataFrame(
        [(1, "a", "FR", "Paris", "x", 0.0, 0.0, "u"), (1, "a", "FR", "Lyon", "y", 0.0, 0.0, "u"),
         (2, "b", "DE", "Bonn", "z", 0.0, 0.0, "u"), (2, "b", "DE", "Bonn", "z", 0.0, 0.0, "u")],
        "id long, name string, country string, city string, address string, lat double, lng double, geohash string")
    by_country = {r.country: r.bookings_counts for r in bk.booking_counts(bk.clean_bookings(f), info, "country").collect()}
    assert by_country == {"FR": 2, "DE": 1, None: 1}
    inv = bk.invalid_hotels_info(f, info).count()
    assert inv == 0


def test_null_and_repeated_ids(spark):
    rows = [(1, 7, d(0)), (2, 7, d(10)), (2, 7, d(10)), (None, 7, d(31)), (5, 7, d(31))]
    out = bk.with_idle_days(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted(((r.srch_ci, r.id is not None, r.id or 0, r.idle_days) for r in out), key=lambda r: (r[0], r[1], r[2], -r[3]))
    assert [r[3] for r in got] == [0, 10, 0, 21, 0]


def test_hot_hotel_is_split_by_date(spark):
    df = spark.createDataFrame([(i, 1, d(i % 50)) for i in range(2000)], SCHEMA)
    out = bk.with_idle_days(df)
    assert out.filter("idle_days > 0").count() == 49
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_none" in plan and "windowspecdefinition(_none" in plan and ", srch_ci" in plan


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bk.with_idle_days(empty).count() == 0 and bk.clean_bookings(empty).count() == 0
    assert tuple(bk.booking_audit(empty).first()) == (0, 0, 0, 0)
