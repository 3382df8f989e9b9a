"""Nearest k by the pyramid of packed boxes.

A box is taken as a ball about its middle, so that a site's distance to it is a chord, without
trigonometry. Each site first goes straight down the pyramid to one leaf, by the box whose points are likely
nearest; the leaf's own points bound its k-th distance from above. Then sites go down together, a level a join, and only boxes
that begin within the bound, a few a site, are sorted to draw it closer. What is left at the
bottom are a few leaves a site, whose points are measured exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staygrid.functions import geohash as G
from staygrid.functions.geodesy import vincenty_distance
from staygrid.operators.packed import EARTH_MEAN_RADIUS_M, EDGES, FAN, MARGIN, RAD, SLACK_M, packed_points, pyramid, spread, turn, with_box_distances, with_top
from staygrid.session import reliable_checkpoint

SITE = ["_site", "_slat", "_slng"]


def first_of_each_place(points: DataFrame, k: int, point_id: str, lat: str, lng: str) -> DataFrame:
    """The points that can be among any site's k nearest: of those at the same coordinates only the k of
    least id can be (all are equally far), so a crowded place is no bottomless leaf."""
    same = Window.partitionBy(lat, lng).orderBy(point_id)
    return points.withColumn("_nth", F.row_number().over(same)).filter(F.col("_nth") <= k).drop("_nth")


def vector(lat: Column, lng: Column, name: str) -> dict[str, Column]:
    """name0, name1, name2: the place on the unit sphere."""
    y, x = lat * RAD, lng * RAD
    return {f"{name}0": F.cos(y) * F.cos(x), f"{name}1": F.cos(y) * F.sin(x), f"{name}2": F.sin(y)}


def chord(a: str, b: str) -> Column:
    """Straight distance between two ``vector`` on the unit sphere."""
    d = [F.col(f"{a}{i}") - F.col(f"{b}{i}") for i in range(3)]
    return F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])


def along(straight: Column) -> Column:
    """Metres on the mean sphere over a chord of the unit sphere."""
    return F.asin(F.least(straight / 2, F.lit(1.0))) * (2 * EARTH_MEAN_RADIUS_M)


def at_most(straight: Column) -> Column:
    """Upper bound of the geodesic over a chord."""
    return along(straight) * (1 + MARGIN) + SLACK_M


def at_least(straight: Column) -> Column:
    """Lower bound of the geodesic over a chord."""
    return along(F.greatest(straight, F.lit(0.0))) * (1 - MARGIN) - SLACK_M


def reach(metres: Column) -> Column:
    """The chord no place within ``metres`` of geodesic is beyond; of NULL, more than any chord."""
    half = (metres + SLACK_M) / ((1 - MARGIN) * 2 * EARTH_MEAN_RADIUS_M)
    return F.coalesce(F.sin(F.least(half, F.lit(math.pi / 2))) * 2, F.lit(4.0))


def frame(lat: Column, straight: Column) -> dict[str, Column]:
    """_high, _wide: the degrees of latitude and of longitude that no place within the chord is beyond."""
    angle = F.asin(F.least(straight / 2, F.lit(1.0))) * 2
    high = F.degrees(angle)
    side = F.degrees(F.asin(F.least(F.sin(angle) / F.cos(lat * RAD), F.lit(1.0))))
    return {"_high": high, "_wide": F.when(F.abs(lat) + high >= 90.0, F.lit(180.0)).otherwise(side)}


def balls(level: DataFrame) -> DataFrame:
    """The level's boxes, also as balls: _up, _child, n, edges, the middle (_my, _mx and vector _c), the greatest
    geodesic distance (_radius) and chord (_ball) from it to any point of the box."""
    y, x = (F.col("south") + F.col("north")) / 2, (F.col("west") + F.col("east")) / 2
    met = with_box_distances(level.withColumns({"_my": y, "_mx": x}), "_my", "_mx").withColumns(vector(F.col("_my"), F.col("_mx"), "_c"))
    angle = F.least(F.col("_most") / EARTH_MEAN_RADIUS_M, F.lit(math.pi))
    return met.select(F.col("parent").alias("_up"), F.col("node").alias("_child"), "n", *EDGES, "_my", "_mx", "_c0", "_c1", "_c2",
                      F.col("_most").alias("_radius"), (F.sin(angle / 2) * 2).alias("_ball"))


def with_children(at: DataFrame, boxes: DataFrame, top: bool) -> DataFrame:
    """Sites at a node paired with the boxes in it and the chord (``_apart``) to their middles."""
    placed = at.withColumns({**vector(F.col("_slat"), F.col("_slng"), "_s"), "_reach": reach(F.col("_bound"))})
    paired = with_top(placed, boxes) if top else placed.join(boxes, F.col("node") == F.col("_up"))
    return paired.withColumn("_apart", chord("_s", "_c"))


def aside() -> Column:
    """Degrees of longitude from a paired site to the box."""
    x, west, east = F.col("_slng"), F.col("west"), F.col("east")
    return F.when((x >= west) & (x <= east), F.lit(0.0)).otherwise(F.least(turn(x - west), turn(x - east)))


def likely(k: int) -> Column:
    """About how far, in radians, a paired site's k-th point would be if it lay in the box: the way there and, of
    n points spread over it, to k. It only chooses where to look first."""
    off = F.greatest(F.col("south") - F.col("_slat"), F.col("_slat") - F.col("north"), F.lit(0.0))
    thin = F.sqrt(F.col("_s0") * F.col("_s0") + F.col("_s1") * F.col("_s1"))
    way = F.sqrt(off * off + aside() * thin * (aside() * thin)) * RAD
    return way + F.col("_ball") * F.sqrt(F.lit(float(k)) / F.col("n"))


def in_reach() -> Column:
    """A paired site's ``_reach`` meets the box's ball and, by the ``frame`` around it, the box itself."""
    return ((F.col("_apart") - F.col("_ball") <= F.col("_reach")) & (F.col("south") <= F.col("_slat") + F.col("_high"))
            & (F.col("north") >= F.col("_slat") - F.col("_high")) & (aside() <= F.col("_wide")))


def first_leaves(sites: DataFrame, down: list[DataFrame], k: int) -> DataFrame:
    """``sites`` plus one leaf (``node``) each, got by going down to the box whose points are ``likely`` nearest, and
    ``_bound``: at least the k-th distance, by the boxes seen (NULL where none holds k points)."""
    at = sites.withColumn("_bound", F.lit(None).cast("double"))
    for depth, boxes in enumerate(down):
        enough, end = F.col("n") >= k, F.col("_apart") + F.col("_ball")
        # a box of fewer than k points comes after all others
        at = with_children(at, boxes, depth == 0).groupBy("_site").agg(
            F.first("_slat").alias("_slat"), F.first("_slng").alias("_slng"),
            F.least(F.min("_bound"), at_most(F.min(F.when(enough, end)))).alias("_bound"),
            F.min_by("_child", F.when(enough, likely(k)).otherwise(likely(k) + 8.0)).alias("node"))
    return at


def bounded_by_points(at: DataFrame, packed: DataFrame, k: int, lat: str, lng: str) -> DataFrame:
    """``at`` with a closer ``_bound``: the k-th nearest of the leaf's own points."""
    held = packed.select(F.col("_leaf").alias("_up"), F.struct(*[v.alias(c) for c, v in vector(F.col(lat), F.col(lng), "p").items()]).alias("_p"))
    leaves = held.groupBy("_up").agg(F.collect_list("_p").alias("_held"))
    paired = at.withColumns(vector(F.col("_slat"), F.col("_slng"), "_s")).join(leaves, F.col("node") == F.col("_up"))
    square = lambda p: sum(((F.col(f"_s{i}") - p[f"p{i}"]) * (F.col(f"_s{i}") - p[f"p{i}"]) for i in range(1, 3)),
                           (F.col("_s0") - p["p0"]) * (F.col("_s0") - p["p0"]))
    kth = F.sqrt(F.get(F.array_sort(F.transform("_held", square)), F.lit(k - 1)))
    return paired.withColumn("_bound", F.least("_bound", at_most(kth))).select(*SITE, "_bound")


def kept_leaves(sites: DataFrame, levels: list[DataFrame], k: int, packed: DataFrame | None = None, lat: str = "lat",
                lng: str = "lng") -> DataFrame:
    """_site, _slat, _slng, _bound, node: the leaves that can hold one of the site's k nearest points;
    ``_bound`` is at least the k-th distance (NULL where there are fewer points). With the ``packed`` points it
    starts from those of a leaf near the site."""
    down = [balls(level) for level in reversed(levels)]
    at = first_leaves(spread(sites, "_site"), down, k)
    at = at.select(*SITE, "_bound") if packed is None else spread(bounded_by_points(at, packed, k, lat, lng), "_site")
    by_site = Window.partitionBy("_site")
    by_far = by_site.orderBy("_most", "_child")
    for depth, boxes in enumerate(down):
        framed = at.withColumns(frame(F.col("_slat"), reach(F.col("_bound"))))
        met = with_children(framed, boxes, depth == 0).filter(in_reach())
        met = met.withColumns({"_least": at_least(F.col("_apart") - F.col("_ball")), "_most": at_most(F.col("_apart") + F.col("_ball")),
                               "_many": F.count(F.lit(1)).over(by_site)})
        # where the sphere, whose error grows with the distance, leaves many boxes, a small far one is
        # bounded closer by the distance to its middle, give or take its radius
        middle = F.when((F.col("_many") > FAN) & (F.col("_radius") < F.col("_most") * MARGIN),
                        vincenty_distance(F.col("_slat"), F.col("_slng"), F.col("_my"), F.col("_mx")))
        met = met.withColumn("_mid", F.nanvl(middle, F.lit(None).cast("double")))
        met = met.withColumns({"_least": F.greatest("_least", F.col("_mid") - F.col("_radius")),
                               "_most": F.least("_most", F.col("_mid") + F.col("_radius"))})
        held = met.withColumn("_held", F.sum("n").over(by_far.rowsBetween(Window.unboundedPreceding, 0)))
        enough = F.min(F.when(F.col("_held") >= k, F.col("_most"))).over(by_site)
        closer = held.withColumn("_bound", F.least(F.col("_bound"), enough))
        at = closer.filter(F.col("_bound").isNull() | (F.col("_least") <= F.col("_bound"))).select(
            *SITE, F.col("_child").alias("node"), "_bound")
    return at


def nearest_k(points: DataFrame, sites: DataFrame, k: int = 1, point_id: str = "id", lat: str = "lat",
              lng: str = "lng", id_col: str = "site_id") -> DataFrame:
    """id_col, point columns, rank, distance_m: the ``k`` points nearest to each site (id, lat, lng) by
    the ellipsoidal distance, ties to the smaller point id; fewer where there are fewer usable points.
    Sites and points without a usable location take no part; a repeated site row is a site of its own."""
    usable = sites.filter(G.valid_point(F.col("lat"), F.col("lng")))
    named = reliable_checkpoint(usable.select(F.col(id_col).alias("_sid"), F.col("lat").alias("_slat"), F.col("lng").alias("_slng"))
                                .withColumn("_site", F.monotonically_increasing_id()))
    packed = packed_points(first_of_each_place(points, k, point_id, lat, lng), lat, lng)
    levels = pyramid(packed, {"south": F.col(lat), "north": F.col(lat), "west": F.col(lng), "east": F.col(lng)})
    leaves = kept_leaves(named.drop("_sid"), levels, k, packed, lat, lng)
    met = leaves.withColumns({**vector(F.col("_slat"), F.col("_slng"), "_s"), "_reach": reach(F.col("_bound"))}).hint("merge").join(
        packed.withColumns(vector(F.col(lat), F.col(lng), "_p")), F.col("node") == F.col("_leaf")).withColumn("_apart", chord("_s", "_p"))
    near = met.filter(F.col("_apart") <= F.col("_reach")).select(*SITE, "_apart", *points.columns)
    # the k-th on the sphere leaves few for the ellipsoid
    by_chord = Window.partitionBy("_site").orderBy("_apart")
    kth = F.max(F.when(F.col("_nth") <= k, F.col("_apart"))).over(Window.partitionBy("_site"))
    close = spread(near, "_site").withColumn("_nth", F.row_number().over(by_chord)).withColumn("_kth", kth).filter(
        F.col("_apart") <= reach(at_most(F.col("_kth"))))
    measured = close.withColumn("distance_m", vincenty_distance(F.col(lat), F.col(lng), F.col("_slat"), F.col("_slng")))
    order = Window.partitionBy("_site").orderBy("distance_m", point_id)
    first = measured.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    out = first.join(named.select("_site", "_sid"), "_site")
    own = [c for c in points.columns if c != id_col]
    return out.select(F.col("_sid").alias(id_col), *own, "rank", "distance_m")
