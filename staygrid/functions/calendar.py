"""Calendar ranges as generators.

The original scripts build integer ranges with ``SPLIT(SPACE(n), ' ')``: that yields n+1
elements for n >= 0, exactly one element for a negative n, and no row for a NULL n.
``sequence(0, greatest(n, 0))`` reproduces this once NULL n is filtered (``greatest``
skips NULLs, so it must not see one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_offsets(n: Column) -> Column:
    """Array 0..max(n, 0) (n+1 elements for n >= 0, [0] for n < 0)."""
    return F.sequence(F.lit(0), F.greatest(n.cast("int"), F.lit(0)))


def months_spanned(end: Column, start: Column) -> Column:
    """Whole months between two dates, truncated toward zero (31-day fraction dropped)."""
    return F.months_between(end, start).cast("int")


def explode_offsets(df: DataFrame, n: Column, name: str = "i") -> DataFrame:
    """One row per offset 0..n; rows with NULL n produce nothing (non-outer generator)."""
    return (df.filter(n.isNotNull())
              .withColumn(name, F.explode(day_offsets(n))))


def explode_stay_days(df: DataFrame, ci: str, co: str, name: str = "visit_date") -> DataFrame:
    """Every day from check-in to check-out, both included."""
    out = explode_offsets(df, F.datediff(F.col(co), F.col(ci)), "_day_i")
    return out.withColumn(name, F.date_add(F.col(ci), F.col("_day_i")))


def explode_stay_months(df: DataFrame, ci: str, co: str, name: str = "month_date") -> DataFrame:
    """One row per calendar month a stay touches, counted as in the original month walk:
    ``add_months(ci, i)`` for i in 0..months_between(co, ci)."""
    out = explode_offsets(df, months_spanned(F.col(co), F.col(ci)), "_mon_i")
    return out.withColumn(name, F.add_months(F.col(ci), F.col("_mon_i")))
