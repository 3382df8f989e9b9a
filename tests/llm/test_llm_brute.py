"""Operators against brute force, other libraries, round trips or held-out accuracy."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from staygrid.llm import bpe_codec, components, disclosure, hidden_markov, mixing, probminhash, simhash, token_counts, toxicity
from staygrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def result(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SF).collect()}


# ---------------------------------------------------------------- 8, 3, 6: tokens

def test_codec_equals_tiktoken(spark, texts):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe_codec.Codec(bpe_codec.model_spec(ranks), public_tokenizers.PATTERN)
    rnd = random.Random(4)
    alphabet = "aaabcdee  \n\t\r'ßéñ½²Ⅷ一二😀漢字\x1c\x85_-.,!12345"
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        packed = codec.encode(text)
        assert codec.ids(packed) == other.encode_ordinary(text)
        assert codec.decode(packed) == text.encode()
    out = result(spark, "op8_byte_bpe")
    for i, text in texts.items():
        ids = np.array(other.encode_ordinary(text), dtype="<u4")
        assert (out[i].n_tokens, out[i].ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert out[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert codec.offsets("é😀a", codec.encode("é😀a")) == [(0, 1), (1, 2), (1, 2), (2, 3)]


def test_files_equal_whole_text_encoding(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    out, at = result(spark, "op3_token_files"), 0
    for i in sorted(texts):
        ids = np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 2], dtype="<u4")
        r = out[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_files_hold_added_tokens(spark, tmp_path):
    """The library's encode under its own settings: added tokens in a text are single ids."""
    from tokenizers import Tokenizer

    from staygrid.llm.token_files import TextEncoder, read_token_files, write_token_files

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    tokenizer = Tokenizer.from_str(raw)
    texts = ["end of one.<|endoftext|>Start", "<|endoftext|>", "a <|endoftext|>\n <|endoftext|><|endoftext|> é😀", "<|endoftext|",
             "plain  text", "", "漢字<|endoftext|> it's 12"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [437, 286, 530, 13, 50256, 10434]
    encoder = TextEncoder(raw, public_tokenizers.PATTERN, "<u4")
    assert [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in texts] == want
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = write_token_files(df, str(tmp_path / "x"), path, public_tokenizers.PATTERN, end_id=2)
    rows, at = {r.doc_id: r for r in read_token_files(spark, made).collect()}, 0
    for i, w in enumerate(want):
        ids = np.array([*w, 2], dtype="<u4")
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_sequences_and_masks(spark, tmp_path):
    from staygrid.llm.token_files import TokenFile, write_token_files

    df = spark.createDataFrame([(i, "some words here " * (40 * i)) for i in range(20)], "doc_id long, text string")
    rows = write_token_files(df.coalesce(1), str(tmp_path / "x"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.PATTERN, 2, seq_len=16).collect()
    for r in rows:
        f = TokenFile(r.file + ".arrow")
        stream = f.span(0, r.n_tokens)
        n = -(-r.n_tokens // 16)
        ids, masks = zip(*(f.sequence(i) for i in range(n)))
        assert all(len(x) == 16 for x in ids)
        assert (np.concatenate(ids)[np.concatenate(masks)] == stream).all()
        assert sum(m.sum() for m in masks) == r.n_tokens and all(m.all() for m in masks[:-1])


def test_trie_counts_equal_unigram_model():
    from tokenizers import Tokenizer, models

    pieces = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    trie = token_counts.PrefixTrie(pieces)
    other = Tokenizer(models.Unigram([*pieces, ("\0", -1e9)], len(pieces), False))
    known = {c for p, _ in pieces if len(p) == 1 for c in p}
    rnd = random.Random(8)
    words = {"▁" + "".join(rnd.choice("theanigorsx,.") for _ in range(rnd.randint(1, 14))) for _ in range(2000)}
    words = [w for w in words if set(w) <= known]
    for word, n in trie.counts(words).items():
        assert n == len(other.encode(word).ids), word
    # a character outside the vocabulary counts its bytes
    assert trie.counts(["▁\U0001F9FF"])["▁\U0001F9FF"] == 1 + 4


# ---------------------------------------------------------------- 4: personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(text):
    ok = {"email": lambda v, d: True, "ip": lambda v, d: all(int(p) <= 255 for p in v.split(".")),
          "card": lambda v, d: 16 <= len(d) <= 19 and luhn(d), "phone": lambda v, d: 8 <= len(d) <= 15}
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text)
            if ok[k](m.group(), re.sub("[^0-9]", "", m.group()))]


def test_base_spans(spark, texts):
    rnd = random.Random(2)
    parts = ["a@b.c", "_x@y.z.w", "@", ".", "4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "256.1.1.1", "0255.1.1.09",
             "+1 (555) 010-9999", "+12", " ", "-", "é😀", "5", "12 34", "00000000000000000000000", "\n"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(1500)]
    made += ["1 " * 20_000, "a" * 50_000, "a@" + "b." * 20_000 + "c", "9" * 30_000, "1.2.3.4." * 2000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "i int, text string")
    for r in df.select("i", disclosure.base_spans(F.col("text")).alias("s")).collect():
        assert [(s.kind, s.start, s.end) for s in r.s] == plain_spans(made[r.i]), made[r.i][:200]
    out = result(spark, "op4_disclosure")
    for i, t in texts.items():
        spans = plain_spans(t)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert out[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [out[i][f"n_{k}"] for k in BASE] == [sum(s[0] == k for s in spans) for k in BASE]
        assert out[i].spans.startswith(listed)


def test_disclosing_terms(spark):
    # "zorblax" stands by one address only, "common" is everywhere
    rows = [(i, f"common words {i} here") for i in range(300)]
    rows += [(1000 + i, f"tho {'abcdefghij'[i]} common zorblax person.a@x.org common end{'abcdefghij'[i]}") for i in range(4)]
    rows += [(2000, "zorblax alone is said here, too, without any address")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {(r.entity, r.term): r.disclosure for r in disclosure.disclosing_terms(df, disclosure.found_spans(df)).collect()}
    n, nc, nt, nct = len(rows), 4, 5, 4
    assert set(terms) == {("person.a@x.org", "zorblax")}
    assert math.isclose(terms["person.a@x.org", "zorblax"], math.log(nct * n / (nc * nt)) / math.log(n / nc))
    clean = {r.doc_id: r.text for r in disclosure.sanitise(df).collect()}
    assert clean[1000] == "tho a common [TERM] [EMAIL] common enda"
    assert all(clean[i] == t for i, t in rows if i not in range(1000, 1004))


def test_disclosing_terms_stand_anywhere(spark):
    """A term discloses an entity of its text wherever it stands: many words away, behind long padding, in a
    text of many words; the entity's own words do not, another email's do."""
    far = {"ahead": "zorblax " + "common " * 30 + "{m}", "behind": "{m} " + "- " * 300 + "zorblax", "long": "{m} " + "common " * 3000 + "zorblax and zorblax"}
    rows = [(i, f"common words and {i} here") for i in range(300)]
    rows += [(1000 + i, t.format(m="person.a@x.org")) for i, t in enumerate(far.values())]
    rows += [(2000 + i, f"see {i} quillfeather.b@y.org or +1 555 010 999{i % 1}") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = disclosure.found_spans(df)
    terms = {(r.entity, r.term) for r in disclosure.disclosing_terms(df, found).collect()}
    assert terms == {("person.a@x.org", "zorblax"), ("15550109990", "quillfeather")}
    report = {r.doc_id: r for r in disclosure.span_report(df).collect()}
    for i, t in rows[300:303]:
        places = [(m.start(), m.end()) for m in re.finditer("zorblax", t)]
        assert report[i].spans.split(",")[1:] == [f"hidden:{a}:{b}" for a, b in places]
    clean = {r.doc_id: r.text for r in disclosure.sanitise(df).collect()}
    assert not any("zorblax" in t or "quill" in t for t in clean.values())
    assert all(clean[i] == t for i, t in rows[:300])


# ---------------------------------------------------------------- 7: fingerprints

def test_edited_texts_and_likeness(spark, texts):
    out, order = result(spark, "op7_simhash"), sorted(texts, reverse=True)
    for i, nxt in zip(order, order[1:] + order[:1]):
        text, n = texts[i], len(texts[i])
        edited = text[:n - n // 3] + texts[nxt][:n // 3]
        assert (out[i].n_chars, out[i].edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = (int(x, 16) for x in (out[i].fingerprint, out[i].edited_fingerprint, out[nxt].fingerprint))
        assert out[i].near_edited == 1 - (a ^ b).bit_count() / 128
        assert out[i].near_next == 1 - (a ^ c).bit_count() / 128
    assert np.mean([r.near_edited > r.near_next for r in out.values()]) > 0.95


def test_votes(spark):
    df = spark.createDataFrame([(1, "a b c d a b c"), (2, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in simhash.fingerprints(df, ["doc_id"]).collect()}
    hashes = df.where("doc_id = 1").select(F.explode(simhash.term_hashes(F.col("text"), 7)).alias("h")).collect()
    for c, remix in (("hi", False), ("lo", True)):
        hs = [r.h for r in hashes]
        if remix:
            hs = [r[0] for r in spark.createDataFrame([(h,) for h in hs], "h long").select(F.xxhash64(F.lit(11), "h")).collect()]
        votes = [sum(1 if h >> i & 1 else -1 for h in hs) for i in range(64)]
        want = sum(1 << i for i, v in enumerate(votes) if v > 0)
        assert rows[1][c] & (2 ** 64 - 1) == want
    assert rows[2].hi == rows[2].lo == 0


def test_hamming_search(spark):
    rnd = random.Random(6)
    base = [rnd.getrandbits(128) for _ in range(40)]
    prints = list({b ^ sum(1 << k for k in rnd.sample(range(128), rnd.randint(0, 5))) for b in base for _ in range(8)})
    signed = lambda x: x - 2 ** 64 if x >= 2 ** 63 else x
    rows = [(signed(p >> 64), signed(p & (2 ** 64 - 1)), 1 + i % 3) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "hi long, lo long, rows int")
    for radius in (0, 2, 3):
        got = {(r.hi, r.lo): r.n_near for r in simhash.within_radius(df, df, radius).collect()}
        for p, (hi, lo, _) in zip(prints, rows):
            assert got[hi, lo] == sum(r[2] for q, r in zip(prints, rows) if (p ^ q).bit_count() <= radius)


# ---------------------------------------------------------------- 1: near-duplicates

def shingle_set(text):
    w = text.encode().lower().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def brute_classes(texts):
    sets, up = {i: shingle_set(t) for i, t in texts.items()}, {i: i for i in texts}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    order = sorted(sets)
    for n, i in enumerate(order):
        for j in order[:n]:
            a, b = sets[i], sets[j]
            if a == b or len(a & b) >= 0.8 * len(a | b):
                up[max(top(i), top(j))] = min(top(i), top(j))
    return {i: top(i) for i in texts}


def test_near_classes_brute(spark, texts):
    out = result(spark, "op1_probminhash")
    assert {i: r.class_id for i, r in out.items()} == brute_classes(texts)


def test_large_groups(spark, monkeypatch):
    """One group far over the small-bucket and block sizes, with borderline members."""
    monkeypatch.setattr(probminhash, "BLOCK", 24)
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(120)]
    texts = {}
    for i in range(220):
        w = list(base)
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        texts[i] = " ".join(w)
    for i in range(220, 260):
        texts[i] = " ".join(rnd.choice(words) for _ in range(60))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r.doc_id: r.class_id for r in probminhash.class_report(df).collect()}
    assert out == brute_classes(texts)


def test_large_groups_of_unlike_counts(spark):
    """Equal shingle sets under very unlike occurrences, and borderline sets among them, in buckets over SMALL."""
    rnd = random.Random(7)
    x, y = [f"x{i}" for i in range(50)], [f"y{i}" for i in range(50)]
    texts = {}
    for i in range(20):
        texts[i] = " ".join(x * 2 + y * (300 + i))
        texts[100 + i] = " ".join(x * (300 + i) + y * 2)
    for i in range(200, 230):
        w = x * 2 + y * 2
        for _ in range(rnd.randint(1, 4)):
            w[rnd.randrange(len(w))] = f"z{rnd.randrange(50)}"
        texts[i] = " ".join(w + y * rnd.choice([0, 40, 200]))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r.doc_id: r.class_id for r in probminhash.class_report(df).collect()}
    assert out == brute_classes(texts)


def test_signature_estimates_probability_jaccard():
    rnd = np.random.default_rng(1)
    elements = rnd.integers(0, 2 ** 63, 300, dtype=np.uint64)
    wa, wb = rnd.uniform(0.5, 4, 300), rnd.uniform(0.5, 4, 300)
    wa[:60], wb[240:] = 0, 0
    both = (wa > 0) & (wb > 0)
    exact = sum(1 / np.maximum(wa / wa[d], wb / wb[d]).sum() for d in np.flatnonzero(both))
    a, b = (probminhash.signatures(elements[w > 0], w[w > 0], np.zeros((w > 0).sum(), np.int64), 1, 4000) for w in (wa, wb))
    assert abs((a == b).mean() - exact) < 0.04


def test_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    up = {x: x for l in links for x in l}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(top(a), top(b))] = min(top(a), top(b))
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: top(x) for x in linked}


# ---------------------------------------------------------------- 9: language model

def test_base_scores(spark, texts):
    out, counts, tokens = result(spark, "op9_hidden_markov"), Counter(), {}
    for i, t in texts.items():
        tokens[i] = [*WORD.findall(t.translate(LOW)), None]
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = out[i]
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
    held = [r for r in out.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_forward_and_counts_against_enumeration():
    from itertools import product

    rng = np.random.default_rng(2)
    start, move, emit = rng.dirichlet([1] * 3), rng.dirichlet([1] * 3, 3), rng.dirichlet([1] * 5, 3)
    seqs = [np.array(s, dtype="<u2") for s in ([0, 3, 4, 1], [2], [1, 1, 0])]
    model = (start, move, emit)
    total, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for s, log in zip(seqs, hidden_markov.forward(seqs, model)):
        paths = {p: start[p[0]] * np.prod([move[a, b] for a, b in zip(p, p[1:])]) * np.prod([emit[q, x] for q, x in zip(p, s)])
                 for p in product(range(3), repeat=len(s))}
        whole = sum(paths.values())
        assert math.isclose(10 ** log, whole, rel_tol=1e-9)
        for p, x in paths.items():
            total[p[0]] += x / whole
            for a, b in zip(p, p[1:]):
                moves[a, b] += x / whole
            for q, y in zip(p, s):
                emits[q, y] += x / whole
    flat = np.zeros((3, 4), dtype=np.int64)
    for i, s in enumerate(seqs):
        flat[i, :len(s)] = s
    got = hidden_markov.expected(flat, np.array([len(s) for s in seqs]), *model)
    for a, b in zip(got, (total, moves, emits)):
        assert np.allclose(a, b, rtol=1e-4, atol=1e-5)


def test_counts_over_whole_texts(spark):
    """One round over texts longer than any chunk equals the plain recursions over whole texts."""
    rng = np.random.default_rng(3)
    model = hidden_markov.first_model([5.0] * hidden_markov.CLASSES, states=3)
    start, move, emit = model
    seqs = [np.append(rng.integers(0, 20, n), hidden_markov.END).astype("<u2") for n in (700, 0, 300, 5, 129)]
    total, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros(emit.shape)
    for s in seqs:
        ahead, back = np.zeros((len(s), 3)), np.ones((len(s), 3))
        for t, x in enumerate(s):
            ahead[t] = (ahead[t - 1] @ move if t else start) * emit[:, x]
            ahead[t] /= ahead[t].sum()
        for t in range(len(s) - 2, -1, -1):
            back[t] = move @ (emit[:, s[t + 1]] * back[t + 1])
            back[t] /= back[t].sum()
            pair = ahead[t][:, None] * move * (emit[:, s[t + 1]] * back[t + 1])[None]
            moves += pair / pair.sum()
        both = ahead * back
        both /= both.sum(1, keepdims=True)
        total += both[0]
        np.add.at(emits.T, s, both)
    rows = spark.createDataFrame([(True, bytearray(s.tobytes())) for s in seqs], "train boolean, classes binary")
    for got, n, add in zip(hidden_markov.train(rows, model, rounds=1), (total, moves, emits), (0.1, 0.1, 0.01)):
        assert np.allclose(got, (n + add) / (n + add).sum(-1, keepdims=True), rtol=1e-3, atol=1e-6)
    # the same counts where forward states are kept for a part of the time only
    flat = np.full((len(seqs), 701), hidden_markov.END, dtype=np.int64)
    for i, s in enumerate(seqs):
        flat[i, :len(s)] = s
    for got, n in zip(hidden_markov.expected(flat, np.array([len(s) for s in seqs]), *model, cells=160), (total, moves, emits)):
        assert np.allclose(got, n, rtol=1e-3, atol=1e-3)


# ---------------------------------------------------------------- 10, 2, 5

def test_mix_near_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix_documents(docs).collect()
    sums, size, goal, top = Counter(), Counter(), {}, Counter()
    for r in rows:
        sums[r.source] += r.copies * r.words
        size[r.source] += r.words
        goal[r.source] = r.target
        top[r.source] = max(top[r.source], r.words)
        assert 0 <= r.copies <= 3
    want = mixing.targets(list(size.items()))
    for s in size:
        assert math.isclose(goal[s], want[s], rel_tol=1e-9)
        assert abs(sums[s] - goal[s]) <= top[s]


def test_targets_reshare_excess():
    assert mixing.targets([("a", 10), ("b", 10), (None, 80)]) == {"a": 100 / 6, "b": 30, None: 100 - 100 / 6 - 30} \
        or math.isclose(sum(mixing.targets([("a", 10), ("b", 10), (None, 80)]).values()), 100)
    t = mixing.targets([("a", 1), ("b", 1), ("c", 98)])
    assert t["a"] == 3 and t["b"] == 3 and math.isclose(t["c"], 94)
    assert mixing.targets([("a", 0)]) == {"a": 0}


def test_trades_keep_words_and_chances():
    rnd, sizes, parts = random.Random(1), [3, 5, 8, 13, 21, 34], [0.2, 0.9, 0.5, 0.3, 0.7, 0.4]
    taken = np.zeros(6)
    for _ in range(20_000):
        out, held = mixing.trade(sizes, parts, lambda _: rnd.random())
        assert math.isclose(sum(s * p for s, p in zip(sizes, out)), sum(s * p for s, p in zip(sizes, parts)))
        assert sum(0 < p < 1 for p in out) <= 1
        taken += out
    assert np.abs(taken / 20_000 - parts).max() < 0.02


def test_kernel_against_definition():
    from itertools import combinations

    def plain(s, t):
        total = 0.0
        for i in combinations(range(len(s)), 3):
            for j in combinations(range(len(t)), 3):
                if all(s[a] == t[b] for a, b in zip(i, j)):
                    total += toxicity.DECAY ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
        return total

    words = ["idiot", "idxiot", "ixdxixoxt", "thing", "ab", "aaaa", "éèéèé"]
    got = toxicity.kernel(words, ["idiot", "aaaa", "thing"])
    for i, w in enumerate(words):
        for j, z in enumerate(["idiot", "aaaa", "thing"]):
            own = plain(w, w) * plain(z, z)
            assert math.isclose(got[i, j], plain(w, z) / math.sqrt(own) if own else 0.0, rel_tol=1e-4, abs_tol=1e-6)
    assert got[0, 0] > got[1, 0] > got[2, 0] > got[3, 0]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op2_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    hits = Counter((labels[r.doc_id], r.predicted) for r in rows)
    assert hits[1, 1] / (hits[1, 0] + hits[1, 1]) > 0.65
    assert hits[0, 1] / (hits[0, 0] + hits[0, 1]) < 0.04


def test_marks_between_letters():
    units = toxicity.Tokens().of("you i.d.i.o.t and m o r o n, id*iot!")
    assert {"idiot", "you", "and"} <= units and any(u.startswith("moro") for u in units)


def test_neighbour_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([e for _, e in rows], float)
    got = {}
    for r in QUERIES["op5_multiprobe"](spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        hit += len(got[ids[q]] & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
        total += 20
    assert hit / total >= 0.9


@pytest.mark.parametrize("wide", [False, True])
def test_expansion_equals_kernel_machine(wide):
    marks = ["idiot", "moron", "scumbag"] + ["".join(chr(0x4E00 + 3 * i + k) for k in range(3)) for i in range(80 * wide)]
    alpha = np.linspace(1, -1, len(marks)).astype(np.float32)
    machine = toxicity.Expansion({"landmarks": marks, "alpha": alpha, "bias": -0.5})
    assert (machine.table is None) == wide
    words = ["idiot", "idxiot", "moronic", "xyz", "scum", "ab", "", "一丁丂", "aaaaaaaaaaaaaaaaaaaaaaaa"]
    want = toxicity.kernel(words, marks) @ alpha - 0.5
    assert np.allclose(machine.margins(words), want, atol=1e-4)


def test_frequent_words_of_equal_counts(spark):
    """Where a step of counts does not fit, part of it is taken, never none of it."""
    equal = spark.range(6000).select(F.concat(F.lit("w"), F.col("id")).alias("word"), F.lit(3).cast("long").alias("c"))
    got = hidden_markov.most_frequent(equal, 1000)
    assert 900 <= len(got) <= 1100 and len({w for w, _ in got}) == len(got)
    mixed = equal.unionByName(spark.createDataFrame([(f"top{i}", 100 + i) for i in range(50)], "word string, c long"))
    got = hidden_markov.most_frequent(mixed, 1000)
    assert [w for w, _ in got[:50]] == [f"top{i}" for i in reversed(range(50))] and 900 <= len(got) <= 1100
    assert len(hidden_markov.most_frequent(mixed, 10_000)) == 6050
    assert hidden_markov.most_frequent(mixed.where("false"), 10) == []
