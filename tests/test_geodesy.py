import math
import random

import duckdb
from pyspark.sql import functions as F

from staygrid.functions.geodesy import A_AXIS, FLAT, vincenty_distance, vincenty_move
from staygrid.oracle import vincenty_sql

PAIRS = "lat1 double, lng1 double, lat2 double, lng2 double"


def metres_by_sql(pairs):
    """Distances from the oracle's SQL form."""
    con = duckdb.connect()
    con.execute("CREATE TABLE p (i BIGINT, lat1 DOUBLE, lng1 DOUBLE, lat2 DOUBLE, lng2 DOUBLE)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?, ?, ?)", [(i, *p) for i, p in enumerate(pairs)])
    rows = con.execute(f"WITH {vincenty_sql('p', 'i')} SELECT metres FROM geodesic ORDER BY i").fetchall()
    return [r[0] for r in rows]


def meridian_arc(lat1, lat2, n=2000):
    """Length of a meridian between two latitudes, by Simpson's rule over its radius of curvature."""
    e2 = FLAT * (2 - FLAT)
    lo, hi = math.radians(lat1), math.radians(lat2)
    radius = lambda x: A_AXIS * (1 - e2) / (1 - e2 * math.sin(x) ** 2) ** 1.5
    h = (hi - lo) / n
    return h / 3 * sum((1 if i in (0, n) else 4 if i % 2 else 2) * radius(lo + i * h) for i in range(n + 1))


def measured(spark, pairs):
    df = spark.createDataFrame(list(enumerate(pairs)), f"i int, p struct<{PAIRS.replace(' double', ':double')}>")
    out = df.select("i", vincenty_distance(*[F.col(f"p.{c}") for c in ("lat1", "lng1", "lat2", "lng2")]).alias("d"))
    return [r.d for r in sorted(out.collect(), key=lambda r: r.i)]


def test_known_arcs(spark):
    d = measured(spark, [(0.0, 0.0, 0.0, 1.0), (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.5, 179.7), (None, 0.0, 0.0, 0.0),
                         (-30.0, 5.0, 60.0, 5.0)])
    assert abs(d[0] - A_AXIS * math.radians(1)) < 1e-6      # along the equator
    assert d[1] == 0.0                                       # coincident points
    assert math.isnan(d[2])                                  # nearly antipodal: no convergence
    assert d[3] is None
    assert abs(d[4] - meridian_arc(-30.0, 60.0)) < 1e-3


def test_equals_sql_form(spark):
    rng = random.Random(3)
    pairs = [(rng.uniform(-89, 89), rng.uniform(-180, 180), rng.uniform(-89, 89), rng.uniform(-180, 180)) for _ in range(800)]
    pairs = [p for p in pairs if abs(p[0] + p[2]) > 5]       # the SQL has no convergence test
    assert max(abs(a - b) for a, b in zip(measured(spark, pairs), metres_by_sql(pairs))) < 1e-5


def test_move_then_measure(spark):
    rows = [(45.0, 7.0, 90.0, 100_000.0), (-30.0, 179.9, 90.0, 50_000.0), (0.0, 0.0, 45.0, 0.0)]
    df = spark.createDataFrame(rows, "lat double, lng double, bearing double, metres double")
    moved = df.withColumn("to", vincenty_move(*[F.col(c) for c in df.columns]))
    out = moved.withColumn("back", vincenty_distance(F.col("lat"), F.col("lng"), F.col("to.lat"), F.col("to.lng"))).collect()
    assert all(abs(r.back - r.metres) < 1e-4 for r in out)
    assert -180 <= out[1].to.lng < 0                          # wrapped across 180 deg
    assert (out[2].to.lat, out[2].to.lng) == (0.0, 0.0)


def test_runs_from_any_folder_without_python_in_tasks(spark):
    plan = spark.range(1).select(vincenty_distance(F.lit(0.0), F.lit(0.0), F.col("id"), F.lit(1.0)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
