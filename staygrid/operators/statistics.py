"""Column statistics that merge: sketches kept per partition of a table, so that a new or changed
partition is read by itself and the table's statistics follow from the stored rows.

A row holds, for a partition and a column: counts, least and greatest value, text lengths, a
HyperLogLog sketch of the distinct values and, for numbers, a quantile sketch (KLL). All of these merge,
so the statistics of the parts are those of the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: 2^LG_K registers: a standard error of 0.8 %.
LG_K = 14
#: Quantile sketch size: a rank error of about 0.5 %.
KLL_K = 500
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def partition_statistics(df: DataFrame, part: str, columns: list[str] | None = None) -> DataFrame:
    """part, column_name, rows, nulls, low, high, total_length, max_length, distinct, quantiles: one pass over
    ``df``, a row for each value of ``part`` (as text; NULL is '') and column."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = columns or [c for c in df.columns if c != part]
    aggs, rows = [], []
    for i, c in enumerate(names):
        col = F.col(c)
        number, text = isinstance(kinds[c], NUMERIC), isinstance(kinds[c], T.StringType)
        value, none = col.cast("double"), F.lit(None)
        made = {"nulls": F.count_if(col.isNull()),
                "low": F.min(value) if number else F.max(none.cast("double")),
                "high": F.max(value) if number else F.max(none.cast("double")),
                "total_length": F.sum(F.length(col)) if text else F.max(none.cast("long")),
                "max_length": F.max(F.length(col)).cast("long") if text else F.max(none.cast("long")),
                "distinct": F.hll_sketch_agg(col.cast("string"), F.lit(LG_K)),
                "quantiles": F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(KLL_K)) if number else F.max(none.cast("binary"))}
        aggs += [v.alias(f"{k}_{i}") for k, v in made.items()]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col("rows"), *[F.col(f"{k}_{i}").alias(k) for k in made]))
    one = df.groupBy(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")).agg(F.count(F.lit(1)).alias("rows"), *aggs)
    return one.select("part", F.inline(F.array(*rows)))


def update_statistics(df: DataFrame, part: str, path: str, columns: list[str] | None = None) -> None:
    """Store the statistics of the partitions that ``df`` holds in place of their former ones; the rows of
    other partitions stay. ``df`` has all rows of its partitions."""
    stats = partition_statistics(df, part, columns).withColumn("_part", F.concat(F.lit("p"), F.col("part")))
    (stats.write.mode("overwrite").partitionBy("_part").option("partitionOverwriteMode", "dynamic").parquet(path))


def stored_statistics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("_part")


def merged_statistics(stats: DataFrame, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """column_name, null_count, distinct_count, min_value, max_value, avg_length, max_length and, by rank, the
    quantiles (q50 for 0.5) of the whole table; an all-NULL column has no quantiles."""
    whole = stats.groupBy("column_name").agg(
        F.sum("nulls").alias("null_count"), F.sum("rows").alias("rows"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_count"),
        F.min("low").alias("min_value"), F.max("high").alias("max_value"),
        (F.sum("total_length") / F.sum(F.when(F.col("total_length").isNotNull(), F.col("rows") - F.col("nulls")))).alias("avg_length"),
        F.max("max_length").alias("max_length"), F.kll_merge_agg_double("quantiles").alias("sketch"))
    some = F.col("sketch").isNotNull() & (F.kll_sketch_get_n_double("sketch") > 0)
    at = [F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(q))).alias(f"q{round(q * 100)}") for q in quantiles]
    return whole.select("column_name", "null_count", "distinct_count", "min_value", "max_value", "avg_length", "max_length", *at)
