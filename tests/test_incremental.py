"""Incremental copy: batches, replays, corrections, untouched files and interrupted runs."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Row

from staygrid.session import shared_dir
from staygrid.sources import incremental
from staygrid.sources.incremental import IncrementalCopy

SCHEMA = "id long, day date, v string, seq int"


def day(n):
    return None if n is None else dt.date(2020, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame([(i, day(d), v, s) for i, d, v, s in rows], SCHEMA)


def held(copy):
    return sorted(copy.read().collect(), key=str)


def rows(items):
    return sorted((Row(id=i, day=day(d), v=v, seq=s) for i, d, v, s in items), key=str)


def files(copy):
    """{partition: its file names}."""
    top = f"{copy.path}/table".removeprefix("file:")
    return {p: sorted(f for f in os.listdir(f"{top}/{p}") if f.endswith(".parquet"))
            for p in os.listdir(top) if p.startswith("_part=")}


@pytest.fixture
def copy(spark):
    return IncrementalCopy(spark, shared_dir(spark, "t_copy"), key="id", date="day", version="seq")


def test_only_touched_days_change(spark, copy):
    copy.apply(frame(spark, [(i, i % 5, "a", 1) for i in range(50)]), "one")
    before = files(copy)
    # one new row on day 1, one correction that moves from day 2 to day 7, known rows of all days
    batch = [(100, 1, "new", 1), (2, 7, "moved", 2)] + [(i, i % 5, "a", 1) for i in range(20) if i != 2]
    entry = copy.apply(frame(spark, batch), "two")
    assert (entry.inserted, entry.updated, entry.unchanged, entry.partitions) == (1, 1, 19, 3)
    after = files(copy)
    changed = {p for p in after if after[p] != before.get(p)}
    assert changed == {"_part=d2020-01-02", "_part=d2020-01-03", "_part=d2020-01-08"}
    want = {i: (i, i % 5, "a", 1) for i in range(50)} | {100: batch[0], 2: batch[1]}
    assert held(copy) == rows(want.values())
    # a replay reads and writes nothing, whatever comes under the name
    assert copy.apply(frame(spark, [(9, 9, "x", 9)]), "two") == entry and files(copy) == after
    # known rows under a new name change no file
    again = copy.apply(frame(spark, batch), "three")
    assert (again.inserted, again.updated, again.partitions) == (0, 0, 0) and files(copy) == after
    assert copy.ledger().count() == 3


def test_emptied_day_and_return(spark, copy):
    copy.apply(frame(spark, [(1, 0, "a", 1), (2, 1, "b", 1)]), "one")
    copy.apply(frame(spark, [(1, 1, "a", 2)]), "two")
    assert held(copy) == rows([(1, 1, "a", 2), (2, 1, "b", 1)])
    copy.apply(frame(spark, [(1, 0, "a", 3)]), "three")
    copy.apply(frame(spark, [(3, 0, "c", 1), (1, None, "a", 4)]), "four")
    assert held(copy) == rows([(1, None, "a", 4), (2, 1, "b", 1), (3, 0, "c", 1)])
    assert copy.read().columns == ["id", "day", "v", "seq"]


def test_nulls_repeats_and_versions(spark, copy):
    batch = [(1, 0, "old", 1), (1, 3, "new", 2), (1, 1, "none", None), (None, 0, "x", 1), (None, 0, "x", 1),
             (None, None, None, None), (2, None, "undated", 1), (3, 0, None, 1)]
    entry = copy.apply(frame(spark, batch), "one")
    want = [batch[1], batch[3], batch[5], batch[6], batch[7]]
    assert held(copy) == rows(want) and (entry.inserted, entry.superseded) == (5, 3)
    # a value that moves to another column, NULL taking its place, is a change
    entry = copy.apply(frame(spark, [batch[3], batch[5], (3, None, None, 1)]), "two")
    assert (entry.inserted, entry.updated, entry.unchanged) == (0, 1, 2)
    assert held(copy) == rows([*want[:4], (3, None, None, 1)])


def test_empty_batches(spark, copy):
    assert copy.apply(frame(spark, []), "none").partitions == 0
    assert held(copy) == [] and copy.read().columns == ["id", "day", "v", "seq"]
    copy.apply(frame(spark, [(1, 0, "a", 1)]), "one")
    copy.apply(frame(spark, []), "none again")
    assert held(copy) == rows([(1, 0, "a", 1)])
    with pytest.raises(ValueError):
        copy.apply(frame(spark, []).withColumnRenamed("v", "_hash"), "clash")


@pytest.mark.parametrize("step", ["_commit", "_finish", "_path"])
def test_interrupted_runs_are_finished(spark, copy, monkeypatch, step):
    """Stopped before the entry, before the overwrite, and when the ledger has the batch already but its
    pending folder stays."""
    copy.apply(frame(spark, [(i, i % 3, "a", 1) for i in range(9)]), "one")
    batch = frame(spark, [(1, 2, "b", 2), (20, 0, "c", 1)])

    def stop(*_):
        raise RuntimeError("stopped")

    if step == "_path":
        finish = IncrementalCopy._finish

        def half(self, name):
            monkeypatch.setattr(incremental, "_path", stop)
            finish(self, name)

        monkeypatch.setattr(IncrementalCopy, "_finish", half)
    else:
        monkeypatch.setattr(IncrementalCopy, step, stop)
    with pytest.raises(RuntimeError):
        copy.apply(batch, "two")
    monkeypatch.undo()
    entry = copy.apply(batch, "two")
    want = {i: (i, i % 3, "a", 1) for i in range(9)} | {1: (1, 2, "b", 2), 20: (20, 0, "c", 1)}
    assert held(copy) == rows(want.values()) and (entry.inserted, entry.updated) == (1, 1)
    assert sorted(r.batch for r in copy.ledger().collect()) == ["one", "two"]


@pytest.mark.parametrize("unit", ["day", "month", "year"])
def test_random_batches_equal_a_rebuild(spark, unit):
    copy, rnd, want = IncrementalCopy(spark, shared_dir(spark, "t_copy"), key="id", date="day", unit=unit, version="seq"), random.Random(5), {}
    for seq in range(4):
        batch = [(i, rnd.choice([None, *range(0, 500, 45)]), rnd.choice("abc"), seq) for i in rnd.sample(range(60), 25)]
        want |= {r[0]: r for r in batch}
        copy.apply(frame(spark, batch), f"b{seq}")
    assert held(copy) == rows(want.values())
