"""Column profile: the per-column statistics a warehouse gathers after a write, as a job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def column_profile(df: DataFrame, columns: list[str] | None = None, exact: bool = False) -> DataFrame:
    """One row per column: column_name, null_count, distinct_count, min_value, max_value
    (numeric columns, as DOUBLE), avg_length, max_length (string columns).

    The statistics come from a single aggregate over the table (partial aggregates per
    partition); ``exact=False`` counts distinct values with HyperLogLog++, which needs
    bounded memory per column whatever the table size. ``exact=True`` counts them by an aggregate of
    its own for each column: its rows hold one value and nothing else, and no row is
    expanded once a column with the buffers of all the others."""
    cols = columns or df.columns
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    aggs, rows = [], []
    for i, c in enumerate(cols):
        col = F.col(c)
        aggs.append(F.count_if(col.isNull()).alias(f"n{i}"))
        aggs.append((F.lit(None).cast("long") if exact else F.approx_count_distinct(col)).alias(f"d{i}"))
        num = isinstance(types[c], _NUMERIC)
        text = isinstance(types[c], T.StringType)
        aggs.append((F.min(col).cast("double") if num else F.lit(None).cast("double")).alias(f"lo{i}"))
        aggs.append((F.max(col).cast("double") if num else F.lit(None).cast("double")).alias(f"hi{i}"))
        aggs.append((F.avg(F.length(col)) if text else F.lit(None).cast("double")).alias(f"al{i}"))
        aggs.append((F.max(F.length(col)).cast("long") if text else F.lit(None).cast("long")).alias(f"ml{i}"))
        rows.append(F.struct(F.lit(i).alias("_i"), F.lit(c).alias("column_name"),
                             F.col(f"n{i}").cast("long").alias("null_count"),
                             F.col(f"d{i}").cast("long").alias("distinct_count"),
                             F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
                             F.col(f"al{i}").alias("avg_length"), F.col(f"ml{i}").alias("max_length")))
    out = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if not exact:
        return out.drop("_i")
    counts = reduce(DataFrame.unionByName, [
        df.agg(F.count_distinct(F.col(c)).alias("_n")).select(F.lit(i).alias("_i"), "_n") for i, c in enumerate(cols)])
    # a number a column
    held = counts.agg(F.map_from_entries(F.collect_list(F.struct("_i", "_n"))).alias("held")).scalar()
    return out.withColumn("distinct_count", held[F.col("_i")]).drop("_i")
