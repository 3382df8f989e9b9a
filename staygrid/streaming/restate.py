"""Streams whose late or disordered rows correct what was already written.

Each micro-batch is merged into a stored copy (``sources.incremental``) under the batch's own name, so a
batch that Spark runs again after a failure changes nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from staygrid.functions.geohash import valid_point, with_geohash
from staygrid.session import reliable_checkpoint
from staygrid.sources.incremental import IncrementalCopy

DAY_KEY = "hotel_day"


def _name(batch_id: int) -> str:
    return f"batch-{batch_id:09d}"


# ---------------------------------------------------------------- daily averages that late readings restate

def daily_totals(readings: DataFrame, hotels: DataFrame, ts: str, value: str, precision: int = 4) -> DataFrame:
    """hotel_day, hotel_id, day, total, n_values, n, newest: the sums of a batch's readings by hotel and UTC day."""
    usable = readings.filter(valid_point(F.col("lat"), F.col("lng")) & F.col(ts).isNotNull())
    tagged = with_geohash(usable, "lat", "lng", precision, "geohash", null_as_empty=True)
    met = tagged.join(hotels.select(F.col("id").alias("hotel_id"), "geohash"), "geohash").withColumn("day", F.to_date(ts))
    sums = met.groupBy("hotel_id", "day").agg(F.sum(value).alias("total"), F.count(value).alias("n_values"),
                                              F.count(F.lit(1)).alias("n"), F.max(ts).alias("newest"))
    return sums.select(F.concat_ws(":", F.coalesce(F.col("hotel_id").cast("string"), F.lit("")), F.col("day").cast("string")).alias(DAY_KEY), "*")


def restate_days(readings: DataFrame, hotels: DataFrame, copy: IncrementalCopy, late_path: str, checkpoint: str, ts: str,
                 value: str, delay: str = "1 hour") -> StreamingQuery:
    """Run the stream of ``readings`` to its end, keeping each hotel and day's sums in ``copy``, however late
    a reading comes: its day's sums are read back, added to and written again, other days stay as
    they are. A reading older than the newest one of earlier batches less ``delay`` is counted like any
    other, and is also kept under ``late_path`` by batch."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        name = _name(batch_id)
        if copy.applied(name):
            return
        held = reliable_checkpoint(batch)
        new = reliable_checkpoint(daily_totals(held, hotels, ts, value))
        if copy.started():
            days = new.agg(F.min("day"), F.max("day")).first()
            newest = copy.read().agg(F.max("newest")).first()[0]
            if newest is not None:
                late = held.filter(F.col(ts) < F.lit(newest) - F.expr(f"INTERVAL {delay}"))
                late.write.mode("overwrite").parquet(f"{late_path}/batch={batch_id}")
            # only the files of the batch's days
            old = copy.read().filter(F.col("day").between(days[0], days[1])) if days[0] else copy.read().limit(0)
            sums = ["total", "n_values", "n"]
            both = new.unionByName(old.join(new.select(DAY_KEY), DAY_KEY, "left_semi").select(*new.columns))
            new = both.groupBy(DAY_KEY, "hotel_id", "day").agg(*[F.sum(c).alias(c) for c in sums], F.max("newest").alias("newest"))
        copy.apply(new, name)

    return (readings.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def daily_copy(spark: SparkSession, path: str, unit: str = "day") -> IncrementalCopy:
    return IncrementalCopy(spark, path, key=DAY_KEY, date="day", unit=unit)


def late_readings(spark: SparkSession, late_path: str, schema: T.StructType) -> DataFrame:
    """The late readings of all batches, with the batch that brought them."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(late_path)


# ---------------------------------------------------------------- idle days that bookings in between correct

IDLE = "id long, hotel long, day int, idle_days int"
STATE = "hotels array<bigint>, days array<int>, firsts array<bigint>"
#: Groups of hotels that share a state. A stream keeps its number for its checkpoint's life.
HOTEL_GROUPS = 2048
#: Group of the bookings without a hotel, day of those without a date, id of those without an id (which sort first).
NO_HOTEL, NO_DAY, NO_ID = -1, -(2 ** 31), -(2 ** 63)


def idle_rows(held, came):
    """(rows, kept): what a batch of one group changes, and its state after it. ``held`` are arrays of hotel,
    day and first booking, a row a hotel and day in their order; ``came`` those of the batch's bookings.

    Days of both are laid in order, so that a day's first booking is the least of both, and its idle
    days reach back to the hotel's day before it."""
    import numpy as np
    import pandas as pd

    rows = pd.DataFrame(dict(zip(("hotel", "day", "id"), came)))
    new = rows[rows["day"] != NO_DAY].groupby(["hotel", "day"], as_index=False)["id"].min()
    hotel, day, first = (np.concatenate([np.asarray(h, np.int64), new[c].to_numpy(np.int64)]) for h, c in zip(held, ("hotel", "day", "id")))
    if not len(hotel):
        return rows.assign(idle_days=0).drop_duplicates(["hotel", "id"])[["id", "hotel", "day", "idle_days"]], (hotel, day, first)
    old = np.arange(len(hotel)) < len(held[0])
    order = np.lexsort((first, day, hotel))
    hotel, day, first, old = hotel[order], day[order], first[order], old[order]
    # a day is there twice at most: as it was held and as it came
    head = np.ones(len(hotel), bool)
    head[1:] = (hotel[1:] != hotel[:-1]) | (day[1:] != day[:-1])
    twin = np.append(~head[1:], False)[head]
    second = np.append(first[1:], 0)[head]
    leads = old[head]
    hotel, day, first = hotel[head], day[head], first[head]
    known, displaced = leads | twin, twin & ~leads & (second != first)
    same = np.append(False, hotel[1:] == hotel[:-1])
    idle = np.where(same, day - np.append(0, day[:-1]), 0)
    # a day's idle days change with its first booking, and when the day before it is new
    changed = ~known | displaced | (same & np.append(False, ~known[:-1]))
    days = pd.DataFrame({"hotel": hotel, "day": day, "first": first, "idle_days": idle})
    own = rows.merge(days, on=["hotel", "day"], how="left")
    own["idle_days"] = np.where(own["first"] == own["id"], own["idle_days"], 0)
    lost = days[displaced].assign(id=second[displaced], idle_days=0)
    out = pd.concat([x[["id", "hotel", "day", "idle_days"]] for x in (days[changed].assign(id=first[changed]), lost, own)])
    return out.drop_duplicates(["hotel", "id"]), (hotel, day, first)


def idle_changes(bookings: DataFrame) -> DataFrame:
    """Stream of (id, hotel_id, srch_ci, idle_days): of every booking that comes, and again of a booking
    whose idle days a later arrival changes: the next date's first booking when a date comes between, or
    the former first booking of a date when one of lower id comes.

    The state of a hotel is its dates and their first bookings: a row a calendar day at most, however many
    bookings it has. Hotels share the states of ``HOTEL_GROUPS`` groups, so that a batch is worked
    through in as many calls, and not in one a hotel. A booking without a date has 0 idle days and changes
    none; a NULL hotel is a hotel; bookings have ids, each its own."""
    def update(key, frames, state):
        import pandas as pd

        rows = pd.concat(list(frames))
        held = state.get if state.exists else ([], [], [])
        out, kept = idle_rows(held, [rows[c].to_numpy() for c in ("hotel", "day", "id")])
        state.update(tuple(x.tolist() for x in kept))
        yield out.astype({"day": "int32", "idle_days": "int32"}).assign(none=key[0] == NO_HOTEL)[["none", *out.columns]]

    hotel = F.col("hotel_id").cast("long")
    group = F.when(hotel.isNull(), NO_HOTEL).otherwise(F.pmod(F.xxhash64(hotel), F.lit(HOTEL_GROUPS)).cast("int"))
    # no NULLs go to the calls: pandas would make floats of the whole numbers
    keyed = bookings.select(F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.unix_date("srch_ci"), F.lit(NO_DAY)).alias("day"),
                            F.coalesce(hotel, F.lit(0)).alias("hotel"), group.alias("_group"))
    changes = keyed.groupBy("_group").applyInPandasWithState(update, f"none boolean, {IDLE}", STATE, "update", GroupStateTimeout.NoTimeout)
    return changes.select(F.nullif("id", F.lit(NO_ID)).alias("id"), F.when(~F.col("none"), F.col("hotel")).alias("hotel_id"),
                          F.when(F.col("day") != NO_DAY, F.date_from_unix_date("day")).alias("srch_ci"), "idle_days")


def keep_idle_days(bookings: DataFrame, copy: IncrementalCopy, checkpoint: str) -> StreamingQuery:
    """Run the stream of bookings to its end; ``copy`` (keyed by booking id) holds the idle days as they
    stand after each batch."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        copy.apply(batch, _name(batch_id))

    return (idle_changes(bookings).writeStream.outputMode("update").foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def idle_copy(spark: SparkSession, path: str, unit: str = "month") -> IncrementalCopy:
    return IncrementalCopy(spark, path, key="id", date="srch_ci", unit=unit)
