"""Top-k per group / overall as window + filter.

Spark plans ``rank``/``row_number`` followed by ``<= k`` as a ``WindowGroupLimit``: a
partial limit runs before the exchange, so only about k rows per key and input partition
are shuffled, even for a global (single partition) ranking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order_by) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def topk_rows(df: DataFrame, partition_by: list[str], order_by: list, k: int,
              rank_col: str = "rank") -> DataFrame:
    """First k rows per group by ``row_number``; ties broken by the trailing sort keys."""
    w = Window.partitionBy(*partition_by).orderBy(*_order(order_by))
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).filter(F.col(rank_col) <= k)


def topk_ties(df: DataFrame, order_by: list, k: int, partition_by: list[str] | None = None,
              rank_col: str = "rank") -> DataFrame:
    """Rows whose ``rank`` is <= k: ties at the boundary are all kept."""
    w = Window.orderBy(*_order(order_by))
    if partition_by:
        w = Window.partitionBy(*partition_by).orderBy(*_order(order_by))
    return df.withColumn(rank_col, F.rank().over(w).cast("long")).filter(F.col(rank_col) <= k)


def topk_ties_global(df: DataFrame, value: str, k: int, rank_col: str = "rank") -> DataFrame:
    """Rows whose ``rank`` by ``value`` descending (NULL last) is <= k over the whole table, ties kept.

    The rank of a value is one more than the rows above it, so it follows from the counts of
    the k greatest distinct values (k rows at most, hence the broadcast); rows are then matched
    to those values where they lie. A tie at the cut, however large, stays spread."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.desc_nulls_last(value)).limit(k)
    above = F.sum("_n").over(Window.orderBy(F.desc_nulls_last(value)).rowsBetween(Window.unboundedPreceding, -1))
    ranks = top.select(F.col(value).alias("_v"), (F.coalesce(above, F.lit(0)) + 1).alias(rank_col)) \
        .filter(F.col(rank_col) <= k)
    return df.join(F.broadcast(ranks), df[value].eqNullSafe(F.col("_v"))).drop("_v")
