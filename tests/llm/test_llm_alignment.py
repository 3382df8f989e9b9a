"""Cross-tokenizer alignment against a plain interval overlap of the libraries' own tokens."""

from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from staygrid.llm import alignment
from staygrid.llm.common import BYTE_TABLE
from staygrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN
JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """Whole-text encodings by both libraries; links by comparing byte ranges."""

    def __init__(self):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(JSON)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=MODEL)
        back = {c: b for b, c in BYTE_TABLE.items()}
        self.a_bytes = {i: bytes(back[c] for c in s) for s, i in self.a.get_vocab(with_added_tokens=False).items()}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    @staticmethod
    def spans(tokens):
        out, at = [], 0
        for t in tokens:
            out.append((at, at + len(t)))
            at += len(t)
        return out

    def __call__(self, text):
        """None, or ids of A, ids of B, linked positions, groups."""
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        ta, tb = [self.a_bytes[i] for i in a], [self.b_bytes(i) for i in b]
        if not text or b"".join(ta) != (" " + text).encode() or b"".join(tb) != (" " + text).encode():
            return None
        sa, sb, links, first = self.spans(ta), self.spans(tb), [], 0
        for i, (start, end) in enumerate(sa):
            while sb[first][1] <= start:
                first += 1
            j = first
            while j < len(sb) and sb[j][0] < end:
                links.append((i, j))
                j += 1
        groups, at = [], [0, 0]
        for cut in sorted({e for _, e in sa} & {e for _, e in sb}):
            side = []
            for k, (ids, spans) in enumerate(((a, sa), (b, sb))):
                to = at[k]
                while to < len(spans) and spans[to][1] <= cut:
                    to += 1
                side.append(",".join(map(str, ids[at[k]:to])))
                at[k] = to
            groups.append("|".join(side))
        return a, b, links, groups


def brute(rows):
    plain = Plain()
    made = [(i, plain(t or "")) for i, t in rows]
    count = Counter((m[0][i], m[1][j]) for _, m in made if m for i, j in m[2])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for i, m in made:
        if m is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = m
        n = [count[a[x], b[y]] for x, y in links]
        best = sum(c == top[b[y]] for c, (_, y) in zip(n, links))
        out.append((i, len(a), len(b), len(groups), len(links), best, sum(n), sha256(";".join(groups).encode()).hexdigest()))
    return out, count


TEXTS = ["plain words", "", None, "  a  b ", "\t", "tab\tnew\nline\r\n\r\n  x", "U+2581 ▁ inside", "▁", "漢字かな 😀é ñ", "ﬁ ½ Ⅷ \x00 \x85",
         "end<|endoftext|>next <s></s><unk> <0x41>", "x" * 3000, "it's 12.5% of 1,000", "said twice", "said twice", " ", "áé"]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_query_equals_brute_force(spark):
    want, _ = brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    assert order(tuple(r) for r in QUERIES["op12_alignment"](spark, SF).collect()) == order(want)


@pytest.mark.parametrize("small, pattern", [(False, None), (False, PATTERN), (True, PATTERN), (True, None)])
def test_edges(spark, monkeypatch, small, pattern):
    """Odd texts; with ``small`` also many parts, several rounds of both trees and slices of a text each."""
    if small:
        for name, value in (("FAN", 2), ("HELD", 20), ("SLICE", 1), ("ROOM", 3), ("TOGETHER", 2)):
            monkeypatch.setattr(alignment, name, value)
    rows = [(i if i != 8 else None, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.select("*", *[F.lit(1).alias(c) for c in ("n_a", "bucket", "part", "keys", "counts", "g", "groups", "n")])
    want, count = brute(rows)
    got = alignment.alignment_report(docs.repartition(7), JSON, MODEL, pattern).collect()
    assert order(tuple(r) for r in got) == order(want)
    files = alignment.pair_counts(docs.repartition(7), JSON, MODEL, pattern)
    table = {(r.a, r.b): r.n for r in alignment.count_table(files, 32000).collect()}
    assert table == dict(count)
    none = docs.where("false")
    assert alignment.alignment_report(none, JSON, MODEL).count() == 0
    assert alignment.alignment_report(docs.where("text is null"), JSON, MODEL).collect()[0][1:] == (0,) * 6 + ("",)


def test_counts_of_another_corpus(spark):
    """Pairs that the counted corpus lacks count zero."""
    one = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    other = spark.createDataFrame([(2, "zebra quartz"), (3, "some words here")], "doc_id long, text string")
    files = alignment.pair_counts(one, JSON, MODEL)
    got = {r.doc_id: r for r in alignment.align(other, files, JSON, MODEL).collect()}
    assert got[2].count_sum == 0 and got[2].n_links > 0
    assert got[3].count_sum == got[3].n_links == got[3].n_best


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 200_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 62, n).astype(np.uint64))
    made = alignment.PerfectHash.build(keys)
    assert sorted(made(keys).tolist()) == list(range(len(keys)))
    assert len(made.bits) * 8 <= 5 * len(keys) + 640
    other = np.arange(500, dtype=np.uint64) + np.uint64(1 << 63)
    assert made(other).max(initial=-1) < max(len(keys), 1)


def test_bucket_cache_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"word {i} and {i * 7}") for i in range(200)], "doc_id long, text string")
    files = {r.bucket: r.file for r in alignment.pair_counts(docs, JSON, MODEL).collect()}
    wide, narrow = alignment.PairCounts(files), alignment.PairCounts(files, room=100)
    keys = np.concatenate([wide.bucket(i)[1] for i in files])
    assert (wide(keys) == narrow(keys)).all() and wide(keys).min() >= 1
    assert len(narrow.held) < len(wide.held) == len(files)


def test_ranks_are_used_only_where_they_make_the_same_tokens():
    import json

    with open(JSON, encoding="utf-8") as f:
        spec = json.load(f)
    assert alignment.same_by_rank(json.dumps(spec))
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        assert not alignment.same_by_rank(json.dumps(spec | change))
    # two merges in the other order, and a merge of other parts
    merges = spec["model"]["merges"]
    swapped = [merges[1], merges[0], *merges[2:]]
    assert not alignment.same_by_rank(json.dumps(spec | {"model": spec["model"] | {"merges": swapped}}))
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        assert not alignment.same_by_rank(f.read())


def test_both_engines_of_a_agree():
    import random

    with open(JSON, encoding="utf-8") as f, open(MODEL, "rb") as g:
        spec, pieces = f.read(), g.read()
    plain, ranked = alignment.Aligner(spec, pieces), alignment.Aligner(spec, pieces, PATTERN)
    rnd = random.Random(6)
    alphabet = "aaabcdeetthhe  \n\t\r'sßéñ½²Ⅷ一二😀漢字\x1c\x85_-.,!12345\u3000\u200b"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60))) for _ in range(4000)]
    assert plain.a_ids(texts).tolist() == ranked.a_ids(texts).tolist()
