import datetime as dt
import json
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from staygrid.operators.ordered import bucketed_lag
from staygrid.operators.profile import column_profile
from staygrid.session import shared_dir
from staygrid.sources.readers import parse_dates, read_topic
from staygrid.sources.schemas import WEATHER
from staygrid.sources.writers import create_table_if_absent, topic_records, write_by_year
from staygrid.streaming import jobs


def test_topic_records_shape(spark):
    df = spark.createDataFrame([(1.5, 2.5, 50.0, 10.0, "2020-01-02")], WEATHER)
    r = topic_records(df).first()
    assert r.key is None and r.partition is None and r.offset == -1 and r.timestamp is None
    assert json.loads(r.value) == {"lng": 1.5, "lat": 2.5, "avg_tmpr_f": 50.0, "avg_tmpr_c": 10.0,
                                   "wthr_date": "2020-01-02"}


def test_topic_round_trip_and_date_parsing(spark):
    root = shared_dir(spark, "t_topic")
    df = spark.createDataFrame([(1.5, 2.5, 50.0, 10.0, "2020-01-02"), (0.0, 0.0, 1.0, 1.0, "bad")], WEATHER)
    topic_records(df).select("value").write.text(f"{root}/topic")
    back = parse_dates(read_topic(spark, WEATHER, fmt="text", path=f"{root}/topic"))
    got = sorted((r.lng, r.wthr_date) for r in back.collect())
    assert got == [(0.0, None), (1.5, dt.date(2020, 1, 2))]   # malformed text -> NULL, no failure


def test_year_partitions_and_default_partition(spark):
    root = shared_dir(spark, "t_year")
    df = spark.createDataFrame([(1, dt.date(2019, 5, 1)), (2, dt.date(2020, 1, 1)), (3, None)],
                               "id long, srch_ci date")
    write_by_year(df, f"{root}/t")
    back = {r.id: r.year for r in spark.read.parquet(f"{root}/t").collect()}
    assert back == {1: 2019, 2: 2020, 3: None}


def test_create_table_if_absent_is_idempotent(spark):
    root = shared_dir(spark, "t_ddl")
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    name = "t_ddl_" + root.rsplit("-", 1)[-1]
    create_table_if_absent(spark, name, df, fmt="parquet", path=f"{root}/t")
    create_table_if_absent(spark, name, df, fmt="parquet", path=f"{root}/t")
    assert spark.table(name).columns == ["id", "v"] and spark.table(name).count() == 0


def test_profile_exact_and_approx(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (2, "abcd")], "n long, s string")
    rows = {r.column_name: r for r in column_profile(df, exact=True).collect()}
    assert (rows["n"].null_count, rows["n"].distinct_count, rows["n"].min_value, rows["n"].max_value) == (0, 2, 1.0, 2.0)
    assert (rows["s"].null_count, rows["s"].distinct_count, rows["s"].avg_length, rows["s"].max_length) == (1, 2, 3.0, 4)
    approx = {r.column_name: r.distinct_count for r in column_profile(df).collect()}
    assert approx == {"n": 2, "s": 2}


def test_exact_profile_expands_no_rows(spark):
    """A distinct count's rows hold its own column only, so a task's memory does not grow with the others."""
    df = spark.createDataFrame([(i % 7, f"v{i % 5}" if i % 4 else None, float(i)) for i in range(200)], "n long, s string, d double")
    out = column_profile(df, exact=True)
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.columns == column_profile(df).columns
    assert {r.column_name: r.distinct_count for r in out.collect()} == {"n": 7, "s": 5, "d": 200}
    none = {r.column_name: (r.null_count, r.distinct_count) for r in column_profile(df.where("false"), exact=True).collect()}
    assert none == {"n": (0, 0), "s": (0, 0), "d": (0, 0)}


def test_bucketed_lag_equals_window(spark):
    rng = random.Random(8)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), base + dt.timedelta(hours=rng.randrange(200)), float(i))
            for i in range(500)]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, v double")
    got = {r.id: r.prev for r in bucketed_lag(df, "k", "ts", "v", tie="id").collect()}
    w = Window.partitionBy("k").orderBy("ts", "id")
    ref = {r.id: r.prev for r in df.withColumn("prev", F.lag("v").over(w)).collect()}
    assert got == ref


def test_stream_dedup_keeps_one_copy(spark):
    root = shared_dir(spark, "t_stream")
    src = f"{root}/src"
    rows = [(i, dt.datetime(2024, 1, 1, 0, i)) for i in range(20)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz").write.parquet(src)
    schema = spark.read.parquet(src).schema
    both = jobs.file_stream(spark, src, schema).unionByName(jobs.file_stream(spark, src, schema))
    dedup = jobs.dedup_within_watermark(jobs.event_time(both, "ts"), ["event_id"], "event_ts", "1 hour")
    q = jobs.ingest(dedup.drop("event_ts").withColumn("d", F.to_date("ts")), f"{root}/out", f"{root}/ckpt", ["d"])
    q.awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 20


def test_dates_with_a_time_part_and_malformed_payloads(spark, tmp_path):
    from pyspark.sql import types as T

    from staygrid.sources.readers import parse_dates, read_topic, rejected_records
    df = spark.createDataFrame([("2020-01-01 00:00:00",), ("2020-02-03",), ("no date",), (None,)], "srch_ci string")
    assert [str(r[0]) for r in parse_dates(df).collect()] == ["2020-01-01", "2020-02-03", "None", "None"]
    spark.createDataFrame([('{"a": 1}',), ("not json",), ('{"a": null}',)], "value string").coalesce(1).write.text(f"{tmp_path}/t")
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert sorted((r.a for r in read_topic(spark, schema, fmt="text", path=f"{tmp_path}/t").collect()), key=str) == [1, None]
    assert [r.value for r in rejected_records(spark, schema, fmt="text", path=f"{tmp_path}/t").collect()] == ["not json"]


def test_global_ties_are_kept_and_nulls_last(spark):
    from staygrid.operators.topk import topk_ties, topk_ties_global
    rows = [(i, float(v) if v is not None else None) for i, v in enumerate([9, 9, 7, 7, 7, 3, None, None])]
    df = spark.createDataFrame(rows, "i int, v double")
    for k in (1, 2, 3, 5, 6, 7, 9):
        want = topk_ties(df, [F.desc_nulls_last("v")], k)
        assert sorted(map(str, topk_ties_global(df, "v", k).collect())) == sorted(map(str, want.collect()))


def test_checkpoint_folder_is_demanded_on_a_cluster():
    import pytest

    from staygrid.session import checkpoint_root

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        checkpoint_root(Session())
