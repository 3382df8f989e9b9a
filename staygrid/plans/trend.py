"""Weather trend over long stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staygrid.functions.calendar import day_offsets
from staygrid.session import reliable_checkpoint


def _long_stays(bookings: DataFrame, min_days: int) -> DataFrame:
    """visit_id, hotel_id, srch_ci, srch_co, copies, days_of_stay of each distinct stay longer than
    ``min_days`` days; ``copies`` counts equal bookings."""
    n = F.datediff("srch_co", "srch_ci")
    return (bookings.select(F.col("id").alias("visit_id"), "hotel_id", "srch_ci", "srch_co")
            .filter(n > min_days)
            .groupBy("visit_id", "hotel_id", "srch_ci", "srch_co").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("days_of_stay", n))


def _as_rows(per_visit: DataFrame) -> DataFrame:
    """The result's columns; equal bookings get a row each."""
    each = per_visit.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(
        "visit_id",
        F.date_format("srch_ci", "yyyy-MM-dd").alias("checkin"),
        F.date_format("srch_co", "yyyy-MM-dd").alias("checkout"),
        F.col("days_of_stay").cast("int"),
        "checkin_tmpr", "checkout_tmpr",
        (F.col("checkout_tmpr") - F.col("checkin_tmpr")).alias("weather_trend"),
        "avg_tmpr_during_stay")


def _stay_days(bookings: DataFrame, min_days: int) -> DataFrame:
    """The long stays with i and day: a row for each of their days, the check-out day included."""
    return (_long_stays(bookings, min_days).withColumn("i", F.explode(day_offsets(F.col("days_of_stay"))))
            .withColumn("day", F.date_add("srch_ci", F.col("i"))))


def _per_visit(days: DataFrame, t: str) -> DataFrame:
    """The first, last and mean reading of each stay."""
    first, last = F.col("i") == 0, F.col("i") == F.col("days_of_stay")
    return _as_rows(days.groupBy("visit_id", "hotel_id", "srch_ci", "srch_co", "days_of_stay", "copies")
                    .agg(F.max(F.when(first, F.col(t))).alias("checkin_tmpr"),
                         F.max(F.when(last, F.col(t))).alias("checkout_tmpr"),
                         F.avg(t).alias("avg_tmpr_during_stay")))


def weather_trend(bookings: DataFrame, hotels_weather: DataFrame, min_days: int = 7) -> DataFrame:
    """visit_id, checkin, checkout, days_of_stay, checkin_tmpr, checkout_tmpr, weather_trend,
    avg_tmpr_during_stay for stays longer than ``min_days`` days.

    The check-in and check-out readings are the first and last of the stay's days, so one
    explode (check-out day included) and one left join to the readings on (hotel, day)
    replace the three separate lookups; the per-visit aggregate then reads them back.
    ``hotels_weather`` holds one reading per (id, wthr_date) - the enrichment's grain.
    """
    days = _stay_days(bookings, min_days)
    hw = hotels_weather.select(F.col("id").alias("hw_id"), F.col("wthr_date").alias("hw_day"), "avg_tmpr_c")
    return _per_visit(days.join(hw, (days.hotel_id == hw.hw_id) & (days.day == hw.hw_day), "left"), "avg_tmpr_c")


def running_readings(readings: DataFrame, wanted: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """key, day, value and, up to and including that day, the key's running ``total`` and ``n`` of finite
    values and the numbers ``nans``, ``highs`` and ``lows`` of the others; a row for each (key, day) of
    either table. ``readings`` has at most one row a (key, day).

    Days without a reading take the sums of the last day before: the as-of lookup is a row of its own in
    the sort. A key has at most a row a calendar day, however many stays ask for it."""
    both = readings.select(key, day, value).unionByName(
        wanted.select(key, day).distinct().withColumn(value, F.lit(None).cast("double")))
    points = both.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).groupBy(key, day).agg(F.max(value).alias(value))
    v, inf = F.col(value), float("inf")
    odd = {"nans": F.isnan(v), "highs": v == inf, "lows": v == -inf}
    finite = v.isNotNull() & ~(odd["nans"] | odd["highs"] | odd["lows"])
    to = Window.partitionBy(key).orderBy(day)
    sums = {"total": F.sum(F.when(finite, v)).over(to), "n": F.count(F.when(finite, 1)).over(to)}
    return points.withColumns({**sums, **{name: F.count(F.when(test, 1)).over(to) for name, test in odd.items()}})


def stay_readings(stays: DataFrame, readings: DataFrame, key: str, day: str, value: str, start: str, end: str) -> DataFrame:
    """``stays`` plus ``first_value`` and ``last_value``, the readings of the days ``start`` and ``end``, and
    ``mean_value``, the mean reading from ``start`` to ``end`` (both included; NULL readings and days
    without one are left out; NULL where none is left).

    The mean is a difference of running sums at the two ends, so its cost does not grow with the
    length of a stay. ``end`` is not before ``start``. The sums are stored: both ends read them."""
    wanted = stays.select(F.col(key), F.explode(F.array(start, end)).alias(day))
    points = reliable_checkpoint(running_readings(readings, wanted, key, day, value))
    numbers = ["total", "n", "nans", "highs", "lows"]

    def at(side: str):
        return points.select(F.col(key).alias(f"_{side}_key"), F.col(day).alias(f"_{side}_day"), F.col(value).alias(f"_{side}_value"),
                             *[F.col(c).alias(f"_{side}_{c}") for c in numbers])

    on = lambda side, c: (F.col(key) == F.col(f"_{side}_key")) & (F.col(c) == F.col(f"_{side}_day"))
    met = stays.join(at("a"), on("a", start), "left").join(at("b"), on("b", end), "left")
    first, inf = F.col("_a_value"), F.lit(float("inf"))
    own = {"total": first, "n": F.lit(1), "nans": F.lit(0), "highs": F.lit(0), "lows": F.lit(0)}
    odd = {"nans": F.isnan(first), "highs": first == inf, "lows": first == -inf}
    plain = first.isNotNull() & ~(odd["nans"] | odd["highs"] | odd["lows"])

    def between(c: str):
        """The number over the stay: up to its end, less up to its start, and the first day's own again."""
        mine = F.when(odd[c], 1).otherwise(0) if c in odd else F.when(plain, own[c]).otherwise(0)
        return F.coalesce(F.col(f"_b_{c}"), F.lit(0)) - F.coalesce(F.col(f"_a_{c}"), F.lit(0)) + mine

    mean = (F.when((between("nans") > 0) | ((between("highs") > 0) & (between("lows") > 0)), F.lit(float("nan")))
             .when(between("highs") > 0, inf).when(between("lows") > 0, -inf)
             .when(between("n") > 0, between("total") / between("n")))
    return met.select(*stays.columns, first.alias("first_value"), F.col("_b_value").alias("last_value"), mean.alias("mean_value"))


def weather_trend_by_cell(bookings: DataFrame, hotels: DataFrame, cells: DataFrame, min_days: int = 7) -> DataFrame:
    """The same from the hotels and the readings' (wthr_date, geohash) averages, without the table of all
    hotels on all dates and without a row a day of a stay. ``hotels`` has one row an id, ``cells`` one a
    date and cell; ``min_days`` is not negative."""
    if min_days < 0:
        raise ValueError("a stay must end after it begins")
    h = hotels.select(F.col("id").alias("h_id"), F.col("geohash").alias("h_cell"))
    stays = _long_stays(bookings, min_days)
    # stored, for the days that are looked up and for the stays that look
    located = reliable_checkpoint(stays.join(h, stays.hotel_id == h.h_id, "left").drop("h_id"))
    c = cells.select(F.col("wthr_date").alias("c_day"), F.col("geohash").alias("h_cell"), "avg_tmpr_c")
    met = stay_readings(located, c, "h_cell", "c_day", "avg_tmpr_c", "srch_ci", "srch_co")
    return _as_rows(met.withColumnsRenamed({"first_value": "checkin_tmpr", "last_value": "checkout_tmpr",
                                            "mean_value": "avg_tmpr_during_stay"}))
