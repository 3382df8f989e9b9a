"""Benchmark: run every registered query over $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full into Spark's ``noop`` sink (no driver collection) and timed;
one JSON line is printed: {"metric", "value" (sum of query seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from staygrid.registry import registry  # noqa: E402
from staygrid.session import build_session  # noqa: E402


def direct_forms():
    """The rewritten jobs in the plainest form Spark takes (name -> callable): a window over each hotel,
    every booking or reading joined before it is counted, the full hotel-day table under the two
    temperature jobs. Timed warm beside the registered queries, as their baseline."""
    from pyspark.sql import functions as F

    from staygrid import registry as rg
    from staygrid.operators import geo_cells as gc
    from staygrid.plans.temperature import temperature_range_topk
    from staygrid.plans.trend import weather_trend
    from staygrid.sources import surrogates as sg

    def sql(text, **views):
        def run(spark, sf):
            for name, make in views.items():
                make(spark, sf).createOrReplaceTempView(name)
            return spark.sql(text)
        return run

    gaps = """SELECT *, coalesce(datediff(srch_ci, lag(srch_ci) OVER (PARTITION BY hotel_id ORDER BY srch_ci NULLS FIRST,
              id NULLS FIRST)), 0) AS idle_days FROM bookings"""
    clean = f"""WITH g AS ({gaps}) SELECT * FROM g WHERE NOT EXISTS (
               SELECT 1 FROM g bad WHERE bad.hotel_id = g.hotel_id AND bad.idle_days BETWEEN 2 AND 29)"""
    by = "SELECT i.{0}, count(*) AS n FROM ({1}) c LEFT JOIN (SELECT DISTINCT * FROM info) i ON i.id = c.hotel_id GROUP BY 1"

    def rollup(spark, sf):
        tagged = gc.tag_cells(sg.points(spark, sf), precision=5, null_as_empty=True)
        each = tagged.select("geohash", F.explode(F.array(*map(F.lit, range(1, 6)))).alias("n"))
        return each.groupBy("n", F.expr("substring(geohash, 1, n)")).count()

    def per_cell(spark, sf):
        fine = gc.tag_cells(sg.points(spark, sf).select("id", "lat", "lng"), precision=6, null_as_empty=True)
        coarse = sg.hotels(spark, sf).select(F.col("id").alias("hotel_id"), F.col("geohash").alias("cell"))
        return gc.cell_prefix_join(fine, coarse).groupBy("hotel_id").count()

    return {
        "temp_range_topk": lambda spark, sf: temperature_range_topk(rg.enriched(spark, sf)),
        "weather_trend": lambda spark, sf: weather_trend(sg.trend_bookings(spark, sf), rg.enriched(spark, sf)),
        "idle_days": sql(gaps, bookings=sg.bookings),
        "clean_bookings": sql(clean, bookings=sg.bookings),
        "bookings_by_country": sql(by.format("country", clean), bookings=sg.bookings, info=sg.hotel_info),
        "bookings_by_city": sql(by.format("city", clean), bookings=sg.bookings, info=sg.hotel_info),
        "cell_rollup": rollup, "readings_per_hotel_cell": per_cell}


def duckdb_seconds(names, sf_dir: str, cpus: int) -> dict[str, float]:
    """The oracle SQL of each query on DuckDB, same tables and threads."""
    import duckdb

    from staygrid.oracle import queries_sql

    con = duckdb.connect()
    con.execute(f"SET threads TO {cpus}")
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            glob = "/*.parquet" if os.path.isdir(f"{sf_dir}/{f}") else ""
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{f}{glob}')")
    out, sql = {}, queries_sql()
    for name in names:
        if name in sql:
            t0 = time.time()
            con.execute(f"CREATE OR REPLACE TEMP TABLE made AS {sql[name]}")
            out[name] = round(time.time() - t0, 3)
    return out


def timed(fn, spark, sf_dir):
    t0 = time.time()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.time() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    # Inputs here are a few MB while several jobs expand rows (cells x levels, stay days),
    # so AQE may coalesce down to a small partition size to keep every core busy.
    spark = build_session(f"local[{cpus}]", shuffle_partitions=4 * cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
                                 "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
                                 "spark.sql.files.maxPartitionBytes": "8m"})
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name, fn in registry().items():
        if only and name not in only:
            continue
        try:
            times[name] = timed(fn, spark, sf_dir)
        except Exception as e:  # a failing query is reported, the others still run
            failed[name] = str(e).splitlines()[0][:200]
    # Rewritten jobs and their direct forms, both warm: compiled code and JIT favour neither.
    warm: dict[str, float] = {}
    direct: dict[str, float] = {}
    if os.environ.get("BENCH_DIRECT", "1") == "1":
        for name, fn in direct_forms().items():
            if name in times:
                try:
                    timed(fn, spark, sf_dir)
                    direct[name] = timed(fn, spark, sf_dir)
                    warm[name] = timed(registry()[name], spark, sf_dir)
                except Exception as e:
                    failed["direct_" + name] = str(e).splitlines()[0][:200]
    duck: dict[str, float] = {}
    if os.environ.get("BENCH_DUCKDB", "0") == "1":  # the oracle SQL on DuckDB, same tables and threads
        duck = duckdb_seconds([n for n in times if n not in ("nearest_hotels", "radius_search")], sf_dir, cpus)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}
    if direct:
        out["direct_forms_warm"], out["warm"] = direct, warm
        out["speedup_vs_direct"] = {k: round(direct[k] / warm[k], 2) for k in warm if warm[k]}
    if duck:
        out["duckdb_sql"] = duck
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
