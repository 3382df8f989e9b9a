"""Booking validation: idle days between check-ins, invalid hotels, cleansing, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

INFO_COLUMNS = ["id", "name", "country", "city", "address", "lat", "lng", "geohash"]


def _keyed(bookings: DataFrame) -> DataFrame:
    """Hotel key without NULLs: (no hotel, hotel or 0), so that the NULL hotel is a group that
    windows and equi-joins treat like any other."""
    return bookings.withColumns({"_none": F.col("hotel_id").isNull(),
                                 "_hotel": F.coalesce(F.col("hotel_id"), F.lit(0))})


def date_gaps(bookings: DataFrame) -> DataFrame:
    """_none, _hotel, srch_ci, gap: a row per hotel and check-in date with the days since the
    hotel's previous date (NULL for the first date and after a NULL date). A hotel has at most
    a row a calendar day, however many bookings it has."""
    dates = _keyed(bookings).select("_none", "_hotel", "srch_ci").distinct()
    order = Window.partitionBy("_none", "_hotel").orderBy(F.col("srch_ci").asc_nulls_first())
    return dates.withColumn("gap", F.datediff("srch_ci", F.lag("srch_ci").over(order)))


def with_idle_days(bookings: DataFrame) -> DataFrame:
    """Add ``idle_days``: days since the previous check-in of the same hotel (0 for the first
    booking, for a NULL check-in, and for a booking sharing its check-in date with an
    earlier one; among equal dates the lowest id counts as first, NULL lowest).

    Only the first booking of a date can have a gap, and the gap follows from the dates alone.
    So rows are numbered per (hotel, date) and take the gap from ``date_gaps`` over the same
    partitioning: bookings are shuffled once, and a hotel that holds most of them is as many
    groups as it has dates."""
    order = Window.partitionBy("_none", "_hotel", "srch_ci").orderBy(F.col("id").asc_nulls_first())
    rows = _keyed(bookings).withColumn("_nth", F.row_number().over(order))
    idle = F.when(F.col("_nth") == 1, F.coalesce("gap", F.lit(0))).otherwise(0).cast("int")
    return (rows.join(date_gaps(bookings), ["_none", "_hotel", "srch_ci"], "left")
            .select(*bookings.columns, idle.alias("idle_days")))


def suspicious(gap: str) -> F.Column:
    """A hotel that stood empty from 2 to 29 days between two check-ins."""
    return F.coalesce(F.col(gap).between(2, 29), F.lit(False))


def invalid_hotels(bookings: DataFrame) -> DataFrame:
    """hotel_id of every hotel with a suspicious gap (the NULL hotel is a group too), from the
    distinct dates alone."""
    bad = date_gaps(bookings).groupBy("_none", "_hotel").agg(F.bool_or(suspicious("gap")).alias("bad")).filter("bad")
    return bad.select(F.when(~F.col("_none"), F.col("_hotel")).alias("hotel_id"))


def distinct_info(hotel_info: DataFrame) -> DataFrame:
    return hotel_info.select(*INFO_COLUMNS).dropDuplicates()


def invalid_hotels_info(bookings: DataFrame, hotel_info: DataFrame) -> DataFrame:
    """Descriptions of the invalid hotels; an invalid hotel without a description gives an
    all-NULL row, one with two descriptions gives two rows."""
    bad = invalid_hotels(bookings)
    info = distinct_info(hotel_info)
    return bad.join(info, bad.hotel_id == info.id, "left").select(*[info[c] for c in INFO_COLUMNS])


def clean_bookings(bookings: DataFrame) -> DataFrame:
    """Bookings of valid hotels with their idle days (rows with NULL hotel_id never match the
    invalid set, so they stay). Invalid hotels' rows are left out before the numbering."""
    kept = bookings.join(invalid_hotels(bookings), "hotel_id", "left_anti").select(*bookings.columns)
    return with_idle_days(kept)


def booking_audit(bookings: DataFrame) -> DataFrame:
    """One row: rows before and after removing invalid hotels, rows removed, invalid hotels;
    from counts per hotel."""
    counts = _keyed(bookings).groupBy("_none", "_hotel").agg(F.count(F.lit(1)).alias("n"))
    bad = date_gaps(bookings).groupBy("_none", "_hotel").agg(F.bool_or(suspicious("gap")).alias("bad"))
    per_hotel = counts.join(bad, ["_none", "_hotel"])
    gone = F.col("bad") & ~F.col("_none")
    out = per_hotel.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
                        F.coalesce(F.sum(F.when(gone, F.col("n"))), F.lit(0)).alias("rows_removed"),
                        F.count_if("bad").alias("invalid_hotels"))
    return out.select(F.col("rows_before").cast("long"),
                      (F.col("rows_before") - F.col("rows_removed")).cast("long").alias("rows_after"),
                      F.col("rows_removed").cast("long"), F.col("invalid_hotels").cast("long"))


def booking_counts(clean: DataFrame, hotel_info: DataFrame, by: str) -> DataFrame:
    """Bookings per hotel ``by`` (country or city) after a left join to the descriptions.

    Bookings are first counted per hotel (map-side partial aggregation), so the join and the
    final shuffle carry one row per hotel instead of one per booking; a hotel with two
    descriptions still counts its bookings once per description."""
    per_hotel = clean.groupBy("hotel_id").agg(F.count(F.lit(1)).alias("n"))
    info = distinct_info(hotel_info).select("id", by)
    joined = per_hotel.join(info, per_hotel.hotel_id == info.id, "left")
    return joined.groupBy(by).agg(F.sum("n").cast("long").alias("bookings_counts"))


# ---------------------------------------------------------------- from tables bucketed by hotel

def bucketed_idle_days(stored: DataFrame) -> DataFrame:
    """Bookings of a table bucketed by ``hotel_id`` with ``idle_days``, ``_nth`` (the booking's place in its
    hotel) and ``_bad`` (the hotel has a suspicious gap): windows over the hotels of a bucket, which
    lie together already, in one sort and without an exchange."""
    order = Window.partitionBy("hotel_id").orderBy(F.col("srch_ci").asc_nulls_first(), F.col("id").asc_nulls_first())
    gap = F.coalesce(F.datediff("srch_ci", F.lag("srch_ci").over(order)), F.lit(0)).cast("int")
    rows = stored.withColumns({"idle_days": gap, "_nth": F.row_number().over(order)})
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn("_bad", F.max(suspicious("idle_days")).over(whole))


def clean_bucketed(stored: DataFrame) -> DataFrame:
    """``clean_bookings`` of a table bucketed by ``hotel_id``. A hotel is one bucket's: where one hotel holds
    most of the rows, ``clean_bookings`` is the form that splits it."""
    kept = bucketed_idle_days(stored).filter(~F.col("_bad") | F.col("hotel_id").isNull())
    return kept.select(*stored.columns, "idle_days")


def invalid_hotels_bucketed(stored: DataFrame, info: DataFrame) -> DataFrame:
    """``invalid_hotels_info`` of two tables with like buckets, bookings by ``hotel_id`` and descriptions by
    ``id``: both sides are merged bucket by bucket."""
    bad = bucketed_idle_days(stored).filter(F.col("_bad") & (F.col("_nth") == 1)).select("hotel_id")
    info = info.select(*INFO_COLUMNS).dropDuplicates().hint("merge")
    return bad.join(info, bad.hotel_id == info.id, "left").select(*[info[c] for c in INFO_COLUMNS])


def write_cleaned(stored: DataFrame, path: str) -> dict[str, int]:
    """Write the cleaned bookings of a bucketed table as Parquet and return the audit's counts, observed
    while the rows pass: one scan, no count job before or after. (Spark may count a task's rows again where
    its stage is run again after a loss; ``booking_audit`` counts stored rows.)"""
    before, after = Observation("before"), Observation("after")
    gone = F.col("_bad") & F.col("hotel_id").isNotNull()
    flagged = bucketed_idle_days(stored).observe(
        before, F.count(F.lit(1)).alias("rows_before"), F.count_if(gone).alias("rows_removed"),
        F.count_if(F.col("_bad") & (F.col("_nth") == 1)).alias("invalid_hotels"))
    kept = flagged.filter(~gone).select(*stored.columns, "idle_days").observe(after, F.count(F.lit(1)).alias("rows_after"))
    kept.write.mode("overwrite").parquet(path)
    return {**before.get, **after.get}
