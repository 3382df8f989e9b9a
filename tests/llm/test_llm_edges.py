"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import math
import os
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from staygrid.llm.bpe_codec import decode, encode, round_trip
from staygrid.llm.disclosure import sanitise, span_report
from staygrid.llm.hidden_markov import score_documents
from staygrid.llm.mixing import mix_report, repeat_documents
from staygrid.llm.multiprobe import nearest
from staygrid.llm.probminhash import class_report, one_of_each
from staygrid.llm.simhash import fingerprint_report
from staygrid.llm.token_counts import count_tokens
from staygrid.llm.token_files import read_token_files, write_token_files
from staygrid.llm.toxicity import reject_toxic, score_report

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"word{i % 977} +1 (555) 010-{i:04d}" if i % 500 == 0 else f"word{i % 977}" for i in range(30_000))
ROWS = [
    (0, "the quick brown fox jumps over the lazy dog", "a"), (1, None, "a"), (2, "", "b"), (3, " \t\n\x0b ", None),
    (4, LONG, "a"), (None, "a text without an id", "b"), (5, "said twice", "b"), (5, "said twice", "b"),
    (6, "The quick  brown fox jumps over the lazy dog", "c"), (7, "é😀 漢字 ½ mail me: a.b@c.example.org", "c"),
    (None, None, None), (8, "x" * 5000, "c")]
CLASH = ["size", "ids", "part", "rows", "key", "node", "band", "bands", "bucket", "label", "score", "block", "term",
         "base", "near", "edit", "text_key", "margin", "hi", "lo", "n", "low", "copies", "target", "words", "toxic",
         "train", "_row", "classes", "n_chars", "next_id", "want", "head", "f", "z", "_pos", "decoded", "vec", "dim"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.select("doc_id", "text", F.lit("en").alias("lang"), "source", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 0, 0), (7, 1, 1), (None, 1, 1), (4, None, None), (6, 1, 0), (6, 1, 0)],
                                 "doc_id long, quality int, toxic int")


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x or 0))


ALL = ids([{"doc_id": r[0]} for r in ROWS])


def test_codec(docs, empty):
    out = round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert ids(out) == ALL and all(r.round_trip for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (1, 2)} == {0}
    assert round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    both = decode(encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert set(docs.columns) <= set(both.columns)


def test_token_files(spark, docs, empty, tmp_path):
    out = read_token_files(spark, write_token_files(docs, str(tmp_path / "t"), JSON, public_tokenizers.PATTERN, 2)).collect()
    assert ids(out) == ALL
    out.sort(key=lambda r: r.start)
    assert [r.doc_id for r in out[:2]] == [None, None]
    assert all(b.start == a.start + a.n_tokens for a, b in zip(out, out[1:]))
    end = zlib.crc32((2).to_bytes(4, "little"))
    assert {(r.n_tokens, r.ids_crc32) for r in out if r.doc_id in (1, 2)} == {(1, end)}
    manifest = write_token_files(empty, str(tmp_path / "e"), JSON, public_tokenizers.PATTERN, 2)
    assert read_token_files(spark, manifest).count() == 0


def test_token_counts(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    out = count_tokens(docs, path).collect()
    assert ids(out) == ALL
    assert {(r.n_words, r.n_tokens) for r in out if r.doc_id in (1, 2, 3)} == {(0, 0)}
    assert count_tokens(empty, path).count() == 0


def test_mixing(docs, empty):
    out = mix_report(docs).collect()
    assert ids(out) == ALL
    assert all(r.taken <= 3 * r["size"] for r in out)
    assert {r["size"] for r in out if r.doc_id in (1, 2, 3)} == {0}
    twice = [r for r in out if r.doc_id == 5]
    assert twice[0].copies == twice[1].copies
    again = mix_report(docs.repartition(3)).collect()
    key = lambda rows: sorted((str(r.doc_id), r["size"], r.taken) for r in rows)
    assert key(out) == key(again)
    assert mix_report(empty).count() == 0
    repeated = repeat_documents(docs)
    assert repeated.columns == docs.columns
    assert repeated.count() == sum(r.copies for r in out)
    assert repeat_documents(empty).count() == 0


def test_simhash(docs, empty):
    out = fingerprint_report(docs).collect()
    assert ids(out) == ALL
    assert len({r.fingerprint for r in out if r.doc_id in (1, 2, 3)}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert fingerprint_report(empty).count() == 0


def test_personal_data(docs, empty):
    out = span_report(docs).collect()
    assert ids(out) == ALL
    assert sum(r.n_email for r in out) == 1
    assert next(r for r in out if r.doc_id == 4).n_phone == 60
    clean = sanitise(docs)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect() if r.doc_id is not None}
    assert texts[7].endswith("mail me: [EMAIL]") and texts[1] is None and texts[2] == "" and texts[0] == ROWS[0][1]
    assert span_report(empty).count() == 0 and sanitise(empty).count() == 0


def test_near_duplicates(docs, empty):
    out = class_report(docs).collect()
    assert ids(out) == ALL
    of = {r.doc_id: r.class_id for r in out if r.doc_id is not None}
    assert of[6] == 0 and of[0] == 0           # same words
    assert of[1] == of[2] == of[3] == 1        # empty texts are copies
    assert of[5] == 5 and of[7] == 7 and of[4] == 4
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert ids(kept.collect()) == [0, 1, 4, 5, 7, 8, None]
    assert class_report(empty).count() == 0 and one_of_each(empty).count() == 0


def test_language_model(docs, empty):
    out = score_documents(docs).collect()
    assert ids(out) == ALL
    assert {r.n_tokens for r in out if r.doc_id in (1, 2, 3)} == {1}
    assert all(math.isfinite(r.score) and r.score < 0 and math.isfinite(r.base_score) for r in out)
    assert score_documents(empty).count() == 0
    # no training text at all
    only = docs.where(F.col("doc_id") == next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2))
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in score_documents(only).collect())


def test_toxicity(docs, empty, labels):
    out = score_report(docs, labels).collect()
    assert ids(out) == ALL
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert score_report(empty, labels).count() == 0
    assert {r.score for r in score_report(docs, labels.where("false")).collect()} == {0.0}
    assert reject_toxic(docs, labels).columns == docs.columns


def test_toxic_rows_go_and_clean_rows_stay(spark, docs):
    insults, plain = ["idiot", "moron", "trash"], ["river", "garden", "window", "paper", "morning", "idea", "motor"]
    rows, marks = [], []
    for i in range(400):
        words = [plain[(i * 7 + k * k) % 7] for k in range(12)]
        toxic = int(i % 4 == 0)
        if toxic:
            words[5] = insults[i // 4 % 3]
        rows.append((1000 + i, " ".join(words), "s"))
        marks.append((1000 + i, 1, toxic))
    rows += [(5000, "you i.d.i.o.t of a river", "s"), (5001, "m o r o n in the garden", "s"), (5002, "a mor*on!", "s"),
             (5003, "the garden by the river", "s"), (5004, None, "s"), (5005, "", "s")]
    extra = [F.lit(i).alias(c) for i, c in enumerate(CLASH)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string") \
        .select("doc_id", "text", F.lit("en").alias("lang"), "source", *extra).unionByName(docs)
    kept = reject_toxic(df, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert kept.columns == df.columns
    left = [r.doc_id for r in kept.collect()]
    assert all((i in left) == (not t) for i, _, t in marks)
    assert not {5000, 5001, 5002} & set(left) and {5003, 5004, 5005} <= set(left)
    assert ids([{"doc_id": i} for i in left if i is None or i < 1000]) == ALL


def test_neighbours(spark):
    rows = [(i, [math.cos(i), math.sin(i)], i) for i in range(50)]
    rows += [(50, None, 0), (51, [0.0, 0.0], 0), (52, [float("nan"), 1.0], 0), (53, [None, 1.0], 0),
             (None, [1.0, 0.0], 0), (54, [float("inf"), 0.0], 0), (55, [2.0], 0), (56, [], 0), (40, rows[40][1], 1),
             (57, rows[20][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int") \
        .withColumn("rank", F.lit(1)).withColumn("block", F.lit(2)).withColumn("norm", F.lit(0))
    out = nearest(df, F.col("vec_id") % 20 == 0, k=5).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by) == {0, 20, 40}
    live = {i: v for i, v, _ in rows if i is not None and i < 50 or i == 57}
    for q, got in by.items():
        want = sorted(((-sum(a * b for a, b in zip(v, live[q])), i) for i, v in live.items() if i != q))[:5]
        assert [i for i, _ in got] == [i for _, i in want]
        assert all(math.isclose(s, -w, rel_tol=1e-12) for (_, s), (w, _) in zip(got, want))
    assert nearest(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(df.where("vec_id = 55"), F.col("vec_id") >= 0).count() == 0


def test_pipeline_columns(spark, docs, labels, tmp_path):
    import corpus_pipeline

    d = str(tmp_path)
    docs.write.parquet(os.path.join(d, "documents.parquet"))
    labels.write.parquet(os.path.join(d, "labels.parquet"))
    made = spark.read.parquet(os.path.join(d, "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, made, d)
        assert made.columns == docs.columns, name
    assert corpus_pipeline.run(spark, d).where("NOT round_trip").count() == 0
