"""Stored column statistics: merged rows equal one pass, sketches within their error, one partition read."""

import random

import pytest
from pyspark.sql import functions as F

from staygrid.operators import statistics as st
from staygrid.operators.profile import column_profile
from staygrid.session import shared_dir

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r.column_name: r for r in df.collect()}


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(1)
    data = [(i, rnd.choice(["a", "bb", None]), None if i % 7 == 0 else rnd.gauss(0, 10), f"t{i % 4321}", rnd.choice([1, 2, 3, None]), None)
            for i in range(20_000)]
    return spark.createDataFrame(data, "id long, s string, v double, t string, part int, nothing double")


def test_merged_equals_one_pass(spark, table):
    path = f"{shared_dir(spark, 't_stats')}/stats"
    st.update_statistics(table, "part", path)
    got, exact = rows(st.merged_statistics(st.stored_statistics(spark, path), (0.1, 0.5, 0.9))), rows(column_profile(table.drop("part"), exact=True))
    assert set(got) == set(exact)
    for c, e in exact.items():
        g = got[c]
        assert (g.null_count, g.min_value, g.max_value, g.max_length) == (e.null_count, e.min_value, e.max_value, e.max_length)
        assert g.avg_length == pytest.approx(e.avg_length) if e.avg_length is not None else g.avg_length is None
        assert abs(g.distinct_count - e.distinct_count) <= max(1, 0.03 * e.distinct_count)
    values = sorted(r.v for r in table.select("v").collect() if r.v is not None)
    for q in ("q10", "q50", "q90"):
        rank = sum(v <= got["v"][q] for v in values) / len(values)
        assert abs(rank - int(q[1:]) / 100) < 0.02
    assert got["nothing"].q50 is None and got["s"].q50 is None and got["nothing"].distinct_count == 0


def test_one_partition_is_read_for_an_update(spark, table):
    path = f"{shared_dir(spark, 't_stats')}/stats"
    source = f"{shared_dir(spark, 't_source')}/t"
    table.write.partitionBy("part").parquet(source)
    st.update_statistics(spark.read.parquet(source), "part", path)
    before = {(r.part, r.column_name): tuple(r) for r in st.stored_statistics(spark, path).collect()}
    extra = spark.createDataFrame([(90_000, "zzz", 1e6, "new", 2, None)], table.schema)
    extra.write.mode("append").partitionBy("part").parquet(source)
    changed = spark.read.parquet(source).filter("part = 2")
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "PushedFilters: []" in plan
    st.update_statistics(changed, "part", path)
    after = {(r.part, r.column_name): tuple(r) for r in st.stored_statistics(spark, path).collect()}
    assert set(after) == set(before)
    assert all(after[k] == v for k, v in before.items() if k[0] != "2")
    assert after[("2", "v")] != before[("2", "v")]
    got = rows(st.merged_statistics(st.stored_statistics(spark, path)))
    assert got["v"].max_value == 1e6 and got["s"].max_length == 3


@pytest.mark.parametrize("name", ["customer", "orders", "lineitem", "documents", "events"])
def test_counts_are_close_on_the_tables(spark, name):
    df = spark.read.parquet(f"{SF}/{name}.parquet")
    cols = df.columns
    df = df.withColumn("_p", F.pmod(F.xxhash64(cols[0]), F.lit(3)))
    got = rows(st.merged_statistics(st.partition_statistics(df, "_p")))
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).first()
    for c in cols:
        assert abs(got[c].distinct_count - exact[c]) <= max(1, 0.03 * exact[c])


def test_empty_table(spark, table):
    assert st.merged_statistics(st.partition_statistics(table.where("false"), "part")).count() == 0
