"""Travel-domain views derived by Spark from the driver's TPC-H-like tables.

The driver data has no hotels, weather or bookings, so each role is a deterministic
projection of a driver table (formulas fixed here and mirrored by the SQL oracle):

* bookings   <- orders     id=o_orderkey, hotel_id=o_custkey, ci=date(o_orderdate),
                           co=ci + o_orderkey % 45 days, adults=1 + o_orderkey % 3,
                           children=nullif(o_orderkey % 4, 3)
* hotel info <- customer x nation (id=c_custkey, country=n_name, city=c_mktsegment)
* hotels     <- supplier x nation, located at lat=(s*37)%120-60+0.05, lng=(s*53)%340-170+0.05
* weather    <- lineitem, one reading per line at its supplier's location moved
                l_linenumber*0.01 deg north; date=date(l_shipdate), tmpr_c=l_quantity-15
* boxes      <- customer, circles <- customer, pairs <- supplier (geo jobs)

Every coordinate is computed with DOUBLE literals so that the oracle reproduces the exact
same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid.functions.geohash import with_geohash
from staygrid.sources.readers import driver_table

# Fixed values of the surrogate layout (also used by the SQL oracle).
STAY_SPAN_DAYS = 45
LAT_MUL, LAT_MOD, LAT_OFF = 37, 120, -60
LNG_MUL, LNG_MOD, LNG_OFF = 53, 340, -170
POINT_FRACTION = 0.05
READING_STEP = 0.01
HOTEL_PRECISION = 4


def site_lat(key: Column) -> Column:
    return ((key * LAT_MUL) % LAT_MOD + LAT_OFF).cast("double") + F.lit(POINT_FRACTION)


def site_lng(key: Column) -> Column:
    return ((key * LNG_MUL) % LNG_MOD + LNG_OFF).cast("double") + F.lit(POINT_FRACTION)


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Booking rows with the columns the jobs use (dates parsed to DATE)."""
    o = driver_table(spark, sf_dir, "orders")
    ci = F.to_date("o_orderdate")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date_time"),
        (F.col("o_custkey") % 1000).cast("int").alias("user_id"),
        ci.alias("srch_ci"),
        F.date_add(ci, (k % STAY_SPAN_DAYS).cast("int")).alias("srch_co"),
        (F.lit(1) + k % 3).cast("int").alias("srch_adults_cnt"),
        F.nullif((k % 4).cast("int"), F.lit(3)).alias("srch_children_cnt"),
        F.col("o_custkey").alias("hotel_id"),
    )


def hotel_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hotel descriptions keyed by booking hotel_id (customers)."""
    c = driver_table(spark, sf_dir, "customer")
    n = driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lat, lng = site_lat(F.col("c_custkey")), site_lng(F.col("c_custkey"))
    # nation is the fixed 25-row TPC-H dimension: broadcasting it is size-bounded.
    base = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("n_name").alias("country"), F.col("c_mktsegment").alias("city"),
        F.concat(F.lit("Address "), F.col("c_custkey").cast("string")).alias("address"),
        lat.alias("lat"), lng.alias("lng"))
    return with_geohash(base, "lat", "lng", HOTEL_PRECISION, "geohash")


def hotels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Located hotels (suppliers) with their 4-character cell."""
    s = driver_table(spark, sf_dir, "supplier")
    n = driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lat, lng = site_lat(F.col("s_suppkey")), site_lng(F.col("s_suppkey"))
    base = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("n_name").alias("country"),
        F.concat(F.col("n_name"), F.lit(" "), (F.col("s_suppkey") % 7).cast("string")).alias("city"),
        F.concat(F.lit("Address "), F.col("s_suppkey").cast("string")).alias("address"),
        lat.alias("lat"), lng.alias("lng"))
    return with_geohash(base, "lat", "lng", HOTEL_PRECISION, "geohash")


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather readings (lng, lat, avg_tmpr_f, avg_tmpr_c, wthr_date)."""
    li = driver_table(spark, sf_dir, "lineitem")
    c = F.col("l_quantity") - F.lit(15.0)
    return li.select(
        site_lng(F.col("l_suppkey")).alias("lng"),
        (site_lat(F.col("l_suppkey")) + F.col("l_linenumber") * F.lit(READING_STEP)).alias("lat"),
        (c * F.lit(9.0) / F.lit(5.0) + F.lit(32.0)).alias("avg_tmpr_f"),
        c.alias("avg_tmpr_c"),
        F.to_date("l_shipdate").alias("wthr_date"),
    )


def trend_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings whose hotel_id points at a located hotel: o_custkey modulo the hotel count
    (a scalar sub-query, evaluated once by Spark)."""
    b = bookings(spark, sf_dir)
    n_hotels = driver_table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    return b.withColumn("hotel_id", F.col("hotel_id") % n_hotels)


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search boxes (customers): 0.5..5 deg tall, 1..11 deg wide, some crossing 180 deg."""
    c = driver_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    south = ((k * 29) % 160 - 80).cast("double") + F.lit(0.03)
    north = south + F.lit(0.5) + (k % 7).cast("double") * F.lit(0.75)
    west = ((k * 61) % 356 - 178).cast("double") + F.lit(0.03)
    east_raw = west + F.lit(1.0) + (k % 5).cast("double") * F.lit(2.5)
    east = F.when(east_raw > 180.0, east_raw - F.lit(360.0)).otherwise(east_raw)
    return c.select(k.alias("box_id"), south.alias("south"), north.alias("north"),
                    west.alias("west"), east.alias("east"))


def circles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Radius searches (customers): centre near a hotel site, radius 1..250 km."""
    c = driver_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    return c.select(k.alias("circle_id"), (site_lat(k % 1000) + F.lit(0.3)).alias("lat"),
                    (site_lng(k % 1000) - F.lit(0.2)).alias("lng"),
                    ((k % 250 + 1) * F.lit(1000.0)).alias("radius_m"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Located points for geo jobs: weather readings with a stable id."""
    li = driver_table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        (site_lat(F.col("l_suppkey")) + F.col("l_linenumber") * F.lit(READING_STEP)).alias("lat"),
        site_lng(F.col("l_suppkey")).alias("lng"),
        F.col("l_suppkey").alias("group_id"),
        F.col("l_shipdate").alias("ts"))
