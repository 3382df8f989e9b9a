"""Streams that correct what they wrote: late readings and bookings out of order equal the batch jobs."""

import datetime as dt
import random

from pyspark.sql import functions as F

from staygrid.plans import bookings as bk
from staygrid.session import shared_dir, utc_session
from staygrid.streaming import jobs, restate

READING = "id long, event_ts timestamp, value double, lat double, lng double"
BOOK = "id long, hotel_id long, srch_ci date, srch_co date"


def in_files(df, path, parts, by="id"):
    for part in range(parts):
        df.filter(F.pmod(F.xxhash64(by), F.lit(parts)) == part).coalesce(1).write.mode("append").parquet(path)
    return path


def test_late_readings_restate_their_day(spark):
    rnd, root = random.Random(1), shared_dir(spark, "t_restate")
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 12)), rnd.choice([None, rnd.uniform(-5, 5)]),
             rnd.choice([10.01, 20.01, None, 95.0]), 5.01) for i in range(800)] + [(900, None, 1.0, 10.01, 5.01)]
    from staygrid.functions.geohash import with_geohash
    with utc_session(spark):
        df = spark.createDataFrame(rows, READING)
        sites = spark.createDataFrame([(1, 10.02, 5.02), (2, 10.03, 5.03), (3, 20.02, 5.02), (4, 50.0, 5.0)], "id long, lat double, lng double")
        hotels = with_geohash(sites, "lat", "lng", 4, "geohash")
        path = in_files(df, f"{root}/src", 4)
        copy = restate.daily_copy(spark, f"{root}/days")

        def run():
            stream = jobs.file_stream(spark, path, df.schema, max_files=1)
            restate.restate_days(stream, hotels, copy, f"{root}/late", f"{root}/ckpt", "event_ts", "value").awaitTermination()

        run()
        got = {(r.hotel_id, r.day): (r.n, r.n_values, r.total and round(r.total, 9)) for r in copy.read().collect()}
        tagged = with_geohash(df.filter("lat <= 90 AND event_ts IS NOT NULL"), "lat", "lng", 4, "geohash")
        whole = tagged.join(hotels.select(F.col("id").alias("hotel_id"), "geohash"), "geohash").groupBy("hotel_id", F.to_date("event_ts").alias("day")) \
            .agg(F.count("*").alias("n"), F.count("value").alias("v"), F.sum("value").alias("t")).collect()
        assert got == {(r.hotel_id, r.day): (r.n, r.v, r.t and round(r.t, 9)) for r in whole}
        assert copy.ledger().count() == 4
        # of the later batches nearly all rows are late; none is lost
        late = restate.late_readings(spark, f"{root}/late", df.schema)
        ids = [r.id for r in late.collect()]
        assert len(set(ids)) == len(ids) and 500 <= len(ids) < 800
        assert late.select("batch").distinct().count() == 3
        # more readings after a restart go on from there; a run without news changes nothing
        more = spark.createDataFrame([(1000, start, 3.0, 20.01, 5.01)], READING)
        run()
        more.coalesce(1).write.mode("append").parquet(path)
        run()
        r = copy.read().filter("hotel_id = 3 AND day = DATE'2024-01-01'").first()
        assert r.n == got[(3, start.date())][0] + 1 and copy.ledger().count() == 5


def test_bookings_out_of_order_equal_the_batch(spark):
    rnd, root = random.Random(2), shared_dir(spark, "t_idle")
    rows = [(i, rnd.choice([None, 1, 1, 1, 2, 3, 40 + i % 30]),
             rnd.choice([None] + [dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(0, 300))] * 20), None) for i in range(700)]
    df = spark.createDataFrame(rows, BOOK)
    path = in_files(df, f"{root}/src", 5)
    copy = restate.idle_copy(spark, f"{root}/idle")
    stream = jobs.file_stream(spark, path, df.schema, max_files=1)
    restate.keep_idle_days(stream, copy, f"{root}/ckpt").awaitTermination()
    got = {r.id: (r.hotel_id, r.srch_ci, r.idle_days) for r in copy.read().collect()}
    want = {r.id: (r.hotel_id, r.srch_ci, r.idle_days) for r in bk.with_idle_days(df).collect()}
    assert got == want
    entries = copy.ledger().collect()
    assert len(entries) == 5 and sum(e.updated for e in entries) > 100   # corrections came
    assert sum(e.inserted for e in entries) == 700


def test_a_batch_run_again_changes_nothing(spark):
    root = shared_dir(spark, "t_again")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 2.0, 10.01, 5.01)], READING)
    copy = restate.daily_copy(spark, f"{root}/days")
    with utc_session(spark):
        totals = restate.daily_totals(df, spark.createDataFrame([(1, "s1z0")], "id long, geohash string"), "event_ts", "value")
        copy.apply(totals, "batch-000000000")
        first = copy.read().collect()
        copy.apply(totals.withColumn("total", F.lit(99.0)), "batch-000000000")
        assert copy.read().collect() == first


def test_idle_days_of_many_hotels_share_calls(spark):
    """A group's rows are worked through at once: as many calls as groups, whatever the hotels, and the batch's
    result after every batch."""
    rnd = random.Random(7)
    held, last, came = ([], [], []), {}, []
    for _ in range(6):
        batch = [(rnd.randrange(40), rnd.choice([restate.NO_DAY] + list(range(-20, 20))), i) for i in rnd.sample(range(10_000), 120)]
        batch = [b for b in batch if b[2] not in {c[2] for c in came}]
        came += batch
        out, held = restate.idle_rows(held, list(zip(*batch)))
        last |= {r.id: (r.hotel, r.day, r.idle_days) for r in out.itertuples()}
        want = {}
        for h, d, i in came:
            days = sorted({x for g, x, _ in came if g == h and x != restate.NO_DAY and x < d})
            first = d != restate.NO_DAY and i == min(j for g, x, j in came if (g, x) == (h, d))
            want[i] = (h, d, d - days[-1] if first and days else 0)
        assert last == want
        again, same = restate.idle_rows(held, list(zip(*batch)))
        assert {r.id: (r.hotel, r.day, r.idle_days) for r in again.itertuples()}.items() <= want.items()
        assert all((a == b).all() for a, b in zip(same, held))
    none, state = restate.idle_rows(([], [], []), ([3, 3], [restate.NO_DAY] * 2, [8, 9]))
    assert [tuple(r) for r in none.to_numpy().tolist()] == [(8, 3, restate.NO_DAY, 0), (9, 3, restate.NO_DAY, 0)] and not any(len(x) for x in state)
