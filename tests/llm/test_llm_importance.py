"""Importance resampling against brute force, and its edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from staygrid.llm import importance
from staygrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall((text or "").translate(LOW))
    runs = [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(docs, target):
    """{doc_id: (n_features, weight, score, rank)} by the definition, ids unique."""
    made = {i: features(t) for i, t in docs}
    s = Counter(b for _, f in made.values() for b in f)
    t = Counter(b for x in target for b in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (S + 10000.0) / ((s[b] + 1.0) * (T + 10000.0)))) for b in range(10000)]
    out = {}
    for i, (n, f) in made.items():
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out[i] = [len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    fit = sorted((i for i, (n, _) in made.items() if n >= 20), key=lambda i: (-out[i][2], i))
    for rank, i in enumerate(fit[:5 * len(fit) // 100], 1):
        out[i][3] = rank
    return {i: tuple(v) for i, v in out.items()}


def result(df):
    return {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    rows = lambda n: spark.read.parquet(f"{SF}/{n}.parquet").collect()
    want = brute([(r.doc_id, r.text) for r in rows("documents")], [r.text for r in rows("benchmark")])
    assert result(QUERIES["op11_importance"](spark, SF)) == want
    assert sum(v[3] is not None for v in want.values()) >= 5


def test_words_are_bytes_of_the_pattern():
    text = "Ünï-Code STRASSE\x00tab\tx_9 漢字　é\u0085z q İK {a}~DEL\x7f'tis 12.5"
    assert [w.decode() for w in importance.words_of(text)] == WORD.findall(text.translate(LOW))
    assert importance.words_of(None) == importance.words_of("") == importance.words_of(" .,\n") == []


@pytest.mark.parametrize("words", [0, 1, 2, 3, 4, 50])
def test_chained_crcs(words):
    text = " ".join(f"w{i}é" for i in range(words))
    assert sorted(importance.feature_buckets(importance.words_of(text)).tolist()) == sorted(features(text)[1])


def test_draw_prefers_the_target(spark):
    plain, wanted = "one two three four five " * 5, "alpha beta gamma delta " * 6
    docs = spark.createDataFrame([(i, wanted if i % 20 == 0 else plain) for i in range(400)], "doc_id long, text string")
    target = spark.createDataFrame([(wanted,)], "text string")
    drawn = importance.resample(docs, target).collect()
    assert len(drawn) == 20 and all(r.doc_id % 20 == 0 for r in drawn)


def test_edges(spark):
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    twice = "a repeated text of some twenty words " * 4
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, long), (None, twice), (None, twice), (4, twice), (4, twice), (5, "short one")]
    rows += [(i, f"{twice} {i}") for i in range(6, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clash = docs.select("*", *[F.lit(1).alias(c) for c in ("rank", "score", "weight", "n_features", "bucket", "n", "_imp_rank", "_imp_row")])
    target = spark.createDataFrame([(None,), ("",), ("a repeated text",)], "text string")
    out = importance.draw_report(clash, target).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((d is None, d or 0) for d, _ in rows)
    for r in out:
        if r.doc_id in (0, 1, 2):
            assert (r.n_features, r.weight, r["rank"]) == (0, 0, None)
        if r.doc_id == 5:
            assert r.n_features == 3 and r["rank"] is None
    assert next(r for r in out if r.doc_id == 3).n_features == 3 * 60_000 - 3
    drawn = sorted(r["rank"] for r in out if r["rank"])
    assert drawn == list(range(1, 5 * 59 // 100 + 1))
    ranked = sorted((r for r in out if r["rank"]), key=lambda r: r["rank"])
    assert [r.score for r in ranked] == sorted((r.score for r in ranked), reverse=True)
    kept = importance.resample(clash, target)
    assert kept.columns == [c for c in clash.columns if not c.startswith("_imp_")] and kept.count() == len(drawn)
    none = docs.where("false")
    assert importance.draw_report(none, target).count() == importance.resample(none, target).count() == 0
    assert importance.draw_report(docs, target.where("false")).count() == len(rows)
