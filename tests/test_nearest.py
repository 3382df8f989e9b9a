"""Nearest k by the pyramid: bounds of boxes, brute force, and how few candidates are left."""

import math
import random

import pytest
from pyspark.sql import functions as F

from staygrid.operators import packed
from staygrid.operators.nearest import first_of_each_place, kept_leaves, nearest_k
from staygrid.operators.packed import packed_points, pyramid, with_box_distances
from test_geodesy import metres_by_sql

POINT = "id long, lat double, lng double"
SITE = "site_id long, lat double, lng double"


def brute(points, sites, k):
    out = set()
    for s in sites:
        d = metres_by_sql([(p[1], p[2], s[1], s[2]) for p in points])
        out |= {(s[0], rank, p[0]) for rank, (_, p) in enumerate(sorted(zip(d, points), key=lambda x: (x[0], x[1][0]))[:k], 1)}
    return out


def vector(lat, lng):
    y, x = math.radians(lat), math.radians(lng)
    return math.cos(y) * math.cos(x), math.cos(y) * math.sin(x), math.sin(y)


def found(spark, points, sites, k):
    out = nearest_k(spark.createDataFrame(points, POINT), spark.createDataFrame(sites, SITE), k=k)
    return {(r.site_id, r["rank"], r.id) for r in out.collect()}


def test_boxes_are_bounded(spark):
    rnd = random.Random(2)
    rows = []
    for _ in range(150):
        s, w = rnd.uniform(-90, 80), rnd.uniform(-180, 170)
        box = (s, min(90.0, s + rnd.choice([0, 0.01, 5, 60])), w, min(180.0, w + rnd.choice([0, 0.01, 20, 200, 360])))
        lat, lng = rnd.choice([-90.0, 0.0, 90.0, rnd.uniform(-90, 90)]), rnd.choice([-180.0, 0.0, 180.0, rnd.uniform(-180, 180)])
        rows += [(len(rows), lat, lng, *box, rnd.uniform(box[0], box[1]), rnd.uniform(box[2], box[3])) for _ in range(6)]
        rows += [(len(rows), lat, lng, *box, a, b) for a in box[:2] for b in box[2:]]
    df = spark.createDataFrame(rows, "i int, lat double, lng double, s double, n double, w double, e double, y double, x double")
    got = with_box_distances(df, "lat", "lng", "s", "n", "w", "e").select("i", "_least", "_most").orderBy("i").collect()
    true = metres_by_sql([(r[1], r[2], r[7], r[8]) for r in rows])
    # the solver does not converge for nearly opposite points
    assert all(g["_least"] <= d <= g["_most"] or d != d for g, d in zip(got, true))
    # and a small far box's bounds lie close together
    tight = spark.range(1).selectExpr("0D lat", "0D lng", "40D south", "40.01D north", "50D west", "50.01D east")
    bounds = with_box_distances(tight, "lat", "lng").first()
    assert bounds["_most"] / bounds["_least"] < 1.03


@pytest.mark.parametrize("leaf, fan", [(32, 16), (2, 2)])
def test_brute_force_anywhere(spark, monkeypatch, leaf, fan):
    monkeypatch.setattr(packed, "LEAF", leaf)
    monkeypatch.setattr(packed, "FAN", fan)
    rnd = random.Random(7)
    points = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(150)]
    points += [(200 + i, 48.85 + rnd.uniform(-0.01, 0.01), 2.35 + rnd.uniform(-0.01, 0.01)) for i in range(150)]
    points += [(400 + i, 10.0, 180.0) for i in range(5)] + [(500, 10.0, -180.0), (501, 90.0, 3.0), (502, -90.0, 0.0)]
    sites = [(0, 48.85, 2.35), (1, 10.0, 179.9), (2, -88.0, 100.0), (3, 89.9, -50.0), (4, 0.0, -140.0), (5, 48.9, 2.9), (6, 10.0, -179.999)]
    assert found(spark, points, sites, 4) == brute(points, sites, 4)


def test_a_dense_city_and_an_empty_ocean(spark):
    """Each site, in the city, by it and an ocean away, meets a bounded number of points, in one pass."""
    rnd = random.Random(4)
    city = [(i, 40.7 + rnd.gauss(0, 0.02), -74.0 + rnd.gauss(0, 0.02)) for i in range(20_000)]
    spot = [(30_000 + i, 40.75, -74.1) for i in range(3000)]   # one address
    points = city + spot + [(40_000 + i, rnd.uniform(-60, 60), rnd.uniform(0, 100)) for i in range(500)]
    sites = [(0, 40.7, -74.0), (1, 40.75, -74.1), (2, 41.5, -72.0), (3, 0.0, -150.0), (4, -50.0, -20.0), (5, 40.0, -40.0)]
    sites += [(10 + i, 40.7 + rnd.gauss(0, 0.02), -74.0 + rnd.gauss(0, 0.02)) for i in range(30)]
    k = 5
    rows = packed_points(first_of_each_place(spark.createDataFrame(points, POINT), k, "id", "lat", "lng"))
    levels = pyramid(rows, {"south": F.col("lat"), "north": F.col("lat"), "west": F.col("lng"), "east": F.col("lng")})
    named = spark.createDataFrame(sites, "_site long, _slat double, _slng double")
    kept = {r["_site"]: r["count"] for r in kept_leaves(named, levels, k).groupBy("_site").count().collect()}
    assert set(kept) == {s[0] for s in sites} and max(kept.values()) <= 40      # of 645 leaves
    assert sum(kept.values()) / len(kept) <= 25
    assert levels[0].count() * packed.LEAF >= 20_505 and [lv.count() for lv in levels][-1] <= packed.FAN
    want = set()
    for s in sites[:8]:
        # the sphere tells which 200 points are worth the ellipsoid
        near = sorted(points, key=lambda p: math.acos(max(-1.0, min(1.0, sum(a * b for a, b in zip(vector(*s[1:]), vector(*p[1:])))))))
        want |= brute([p for p in near if p[0] < 30_000 or p[0] >= 40_000 or p[0] < 30_000 + k][:200], [s], k)
    assert found(spark, points, sites[:8], k) == want


def test_fewer_points_repeats_and_nulls(spark):
    points = [(1, 0.0, 0.0), (2, 0.0, 1.0), (3, None, 1.0), (4, float("nan"), 1.0), (5, 91.0, 0.0), (6, 0.0, None)]
    sites = [(0, 0.0, 0.1), (0, 0.0, 0.9), (1, None, 1.0), (2, 0.0, 200.0), (None, 0.0, 0.0), (3, 0.0, 0.0), (3, 0.0, 0.0)]
    out = nearest_k(spark.createDataFrame(points, POINT), spark.createDataFrame(sites, SITE), k=3).collect()
    got = sorted((str(r.site_id), r["rank"], r.id) for r in out)
    assert got == sorted([("0", 1, 1), ("0", 2, 2), ("0", 1, 2), ("0", 2, 1), ("None", 1, 1), ("None", 2, 2)] + [("3", 1, 1), ("3", 2, 2)] * 2)
    none = spark.createDataFrame([], POINT)
    assert nearest_k(none, spark.createDataFrame(sites, SITE)).count() == 0
    assert nearest_k(spark.createDataFrame(points, POINT), spark.createDataFrame([], SITE)).count() == 0


def rows_joined(df):
    """Rows that the joins of ``df`` put out, once it has run."""
    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        below, metric = node.children(), node.metrics().get("numOutputRows")
        own = metric.get().value() if kind.endswith("JoinExec") and metric.isDefined() else 0
        return own + sum(walk(below.apply(i)) for i in range(below.size()))

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_a_site_meets_few_boxes_and_points(spark):
    """boxes beyond the k-th distance are dropped where they are met, before the rows are sorted by site,
    and a site's bound comes from points and not from a box's far end."""
    rnd = random.Random(11)
    points = [(i, rnd.uniform(-60, 60), rnd.uniform(-179, 179)) for i in range(4000)]
    sites = [(i, rnd.uniform(-60, 60), rnd.uniform(-179, 179)) for i in range(300)]
    sites += [(300, 90.0, 0.0), (301, -90.0, 10.0), (302, 1.0, 180.0), (303, 1.0, -180.0)]
    out = nearest_k(spark.createDataFrame(points, POINT), spark.createDataFrame(sites, SITE), k=3)
    per_site = rows_joined(out) / len(sites)
    assert 3 <= per_site <= 140, per_site      # 289 before
    got = {(r.site_id, r["rank"], r.id) for r in out.filter("site_id < 3 or site_id >= 300").collect()}
    assert got == brute(points, sites[:3] + sites[300:], 3)
