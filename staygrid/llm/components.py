"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import stored


def _print_of(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b); the label is the least node reached.

    Large star: each node points its greater neighbours at the least node it knows; small star: it
    does so with the lesser ones. Both are a grouped minimum and a join; they end when every link
    points at its component's least node, after a number of rounds that grows as the logarithm of
    the longest path."""
    links = stored(links.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    before = _print_of(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.min("a")).alias("low"))
        large = both.where("b > a").join(low, both["a"] == low["n"]).select(F.col("low").alias("a"), "b")
        low = large.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("low"))
        small = large.join(low, large["b"] == low["n"])
        links = stored(small.select(F.explode(F.array(
            F.struct(F.col("low").alias("x"), F.col("a").alias("y")),
            F.struct(F.col("low").alias("x"), F.col("b").alias("y")))).alias("l")).select(
                F.col("l.x").alias("a"), F.col("l.y").alias("b")).where("a <> b").distinct(), "links")
        after = _print_of(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    return links.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(roots)
