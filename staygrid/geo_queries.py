"""Registered geo and profiling jobs over the driver tables (see sources.surrogates)."""

from __future__ import annotations

from pyspark.sql import functions as F

from staygrid.operators import geo_boxes as gb
from staygrid.operators import geo_cells as gc
from staygrid.operators import geo_cover as gv
from staygrid.operators import geo_search as gs
from staygrid.operators.nearest import nearest_k
from staygrid.operators.profile import column_profile
from staygrid.operators.z_order import scan_boxes, write_layout
from staygrid.registry import register, round6
from staygrid.session import shared_dir
from staygrid.sources import surrogates as sg
from staygrid.sources.readers import driver_table

QUARANTINE_LINE_NULL, QUARANTINE_LINE_NAN = 7, 6


@register("geohash_cell_counts")
def q_geohash_cell_counts(spark, sf_dir):
    return gc.cell_counts(sg.points(spark, sf_dir), precision=4)


@register("cell_rollup")
def q_cell_rollup(spark, sf_dir):
    tagged = gc.tag_cells(sg.points(spark, sf_dir), precision=5, null_as_empty=True)
    return gc.cell_rollup(tagged, "geohash", precisions=(1, 2, 3, 4, 5))


@register("cell_bounds")
def q_cell_bounds(spark, sf_dir):
    return gc.cell_bounds(sg.hotels(spark, sf_dir), "geohash")


@register("cell_neighbors")
def q_cell_neighbors(spark, sf_dir):
    return gc.cell_neighbors(sg.hotels(spark, sf_dir), "geohash")


@register("points_in_boxes")
def q_points_in_boxes(spark, sf_dir):
    pts = sg.points(spark, sf_dir).select("id", "lat", "lng")
    return gb.points_in_boxes(pts, sg.boxes(spark, sf_dir))


@register("boxes_intersect")
def q_boxes_intersect(spark, sf_dir):
    b = sg.boxes(spark, sf_dir)
    return gb.boxes_intersect(b, b).filter(F.col("a_id") < F.col("b_id"))


@register("geo_extent")
def q_geo_extent(spark, sf_dir):
    pts = sg.points(spark, sf_dir).withColumn("grp", F.col("id") % 97)
    return gb.geo_extent(pts, "grp")


@register("enclosing_cell")
def q_enclosing_cell(spark, sf_dir):
    return gc.enclosing_cell(sg.points(spark, sf_dir), "group_id")


@register("cell_steps")
def q_cell_steps(spark, sf_dir):
    out = gc.cell_steps(sg.points(spark, sf_dir), "group_id", "ts", bits=40, tie="id")
    return out.select("group_id", "ts", "id", "cell_code", "step")


@register("cell_grid")
def q_cell_grid(spark, sf_dir):
    return gv.cell_grid(sg.boxes(spark, sf_dir), precision=3).select("box_id", "geohash")


def raw_points(spark, sf_dir):
    """Readings with unusable coordinates: NULL, NaN and out-of-range values."""
    li = driver_table(spark, sf_dir, "lineitem")
    lat = F.when(F.col("l_linenumber") == QUARANTINE_LINE_NULL, F.lit(None).cast("double")).otherwise(
        (F.col("l_quantity") - F.lit(25.0)) * F.lit(4.0))
    lng = F.when(F.col("l_linenumber") == QUARANTINE_LINE_NAN, F.lit(float("nan"))).otherwise(
        F.col("l_discount") * F.lit(4000.0) - F.lit(200.0))
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                     lat.alias("lat"), lng.alias("lng"))


@register("coordinate_quarantine")
def q_coordinate_quarantine(spark, sf_dir):
    return gb.quarantine_coordinates(raw_points(spark, sf_dir)).select("id", "reason")


@register("box_metrics")
def q_box_metrics(spark, sf_dir):
    out = gb.box_metrics(sg.boxes(spark, sf_dir))
    return round6(out, "height", "width", "center_lat", "center_lng")


@register("column_profile")
def q_column_profile(spark, sf_dir):
    return round6(column_profile(sg.hotel_info(spark, sf_dir), exact=True), "avg_length")


@register("cover_cells")
def q_cover_cells(spark, sf_dir):
    return gv.cover_cells(sg.boxes(spark, sf_dir)).select("box_id", "bits", "cell_code", "geohash")


@register("radius_search")
def q_radius_search(spark, sf_dir):
    pts = sg.points(spark, sf_dir).select("id", "lat", "lng")
    return gs.radius_search(pts, sg.circles(spark, sf_dir), exact=True)


@register("pair_distance")
def q_pair_distance(spark, sf_dir):
    s = driver_table(spark, sf_dir, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    pairs = s.select(k.alias("pair_id"), sg.site_lat(k).alias("lat1"), sg.site_lng(k).alias("lng1"),
                     sg.site_lat(k + 1).alias("lat2"), sg.site_lng(k + 1).alias("lng2"))
    return gs.pair_distance(pairs).withColumn("distance_m", F.round("distance_m", 3))


@register("nearest_hotels")
def q_nearest_hotels(spark, sf_dir):
    """The three hotels nearest to each circle's centre."""
    hotels = sg.hotels(spark, sf_dir).select("id", "lat", "lng")
    sites = sg.circles(spark, sf_dir).select("circle_id", "lat", "lng")
    out = nearest_k(hotels, sites, k=3, point_id="id", id_col="circle_id")
    return out.select("circle_id", "id", "rank", F.round("distance_m", 3).alias("distance_m"))


@register("radius_cells")
def q_radius_cells(spark, sf_dir):
    """Points in the cells that cover each circle's box (a superset of the circle)."""
    pts = sg.points(spark, sf_dir).select("id", "lat", "lng")
    return gs.radius_search(pts, sg.circles(spark, sf_dir), exact=False)


@register("cover_extent")
def q_cover_extent(spark, sf_dir):
    return gv.cover_extent(gv.cover_cells(sg.boxes(spark, sf_dir)))


@register("column_profile_approx")
def q_column_profile_approx(spark, sf_dir):
    """The profile with HyperLogLog++ counts, bounded memory a column."""
    return round6(column_profile(sg.hotel_info(spark, sf_dir)), "avg_length")


@register("sample_cells")
def q_sample_cells(spark, sf_dir):
    return gv.sample_cells(sg.boxes(spark, sf_dir), precision=3, n=5, seed=42)


@register("cell_heatmap")
def q_cell_heatmap(spark, sf_dir):
    """Dense heat map: every precision-3 cell of every box with its reading count (0 if none)."""
    grid = gv.cell_grid(sg.boxes(spark, sf_dir), precision=3)
    counts = gc.cell_counts(sg.points(spark, sf_dir), precision=3)
    return gv.densify(grid, counts)


@register("readings_per_hotel_cell")
def q_readings_per_hotel_cell(spark, sf_dir):
    """Readings tagged at 6 characters, counted per cell and attached to hotel cells (4 characters)
    by prefix."""
    fine = gc.tag_cells(sg.points(spark, sf_dir).select("id", "lat", "lng"), precision=6, null_as_empty=True)
    counts = fine.groupBy("geohash").agg(F.count(F.lit(1)).alias("readings"))
    coarse = sg.hotels(spark, sf_dir).select(F.col("id").alias("hotel_id"), F.col("geohash").alias("cell"))
    joined = gc.cell_prefix_join(counts, coarse, "geohash", "cell")
    return joined.groupBy("hotel_id").agg(F.sum("readings").alias("n"))


@register("cell_layout")
def q_cell_layout(spark, sf_dir):
    """Points laid out in Z-order of their 40-bit cell (range-partitioned, sorted)."""
    pts = sg.points(spark, sf_dir).select("id", "lat", "lng")
    return gc.cluster_by_cell(pts, bits=40)


@register("box_scan")
def q_box_scan(spark, sf_dir):
    """Points stored in Z-order, and read back by all boxes through ranges of codes."""
    path = f"{shared_dir(spark, 'cell_layout')}/table"
    write_layout(sg.points(spark, sf_dir).select("id", "lat", "lng"), path)
    return scan_boxes(spark, path, sg.boxes(spark, sf_dir)).drop("cell_code")
