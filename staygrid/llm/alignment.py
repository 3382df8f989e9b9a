"""Cross-tokenizer alignment by minimal perfect hashing (operator 12).

Tokenizer A is a byte-level BPE (``tokenizers``), B a piece model with byte fallback
(``sentencepiece``). Both cut the bytes of blank + text; a link is a pair of an A and a B token whose
byte ranges overlap, and a group lies between two offsets where tokens of both end.

1. Tasks align their documents and pre-aggregate the linked id pairs; each writes, for each of
   ``BUCKETS`` key buckets, its sorted distinct pairs with their numbers. Texts are aligned chunk by
   chunk: before a blank that follows no white space tokens of both sides end, so a word with the
   blank before it is aligned once a task and its links count as often as it comes.
2. A bucket's distinct pairs are united by a tree of groups, and a minimal perfect hash is built over
   them: levels of bits, a pair's place being the rank of the first bit that it alone has set.
3. Parts become dense count vectors indexed by that hash, each made of so many parts that it is no
   larger than they are; the vectors are summed by a tree.
4. A second pass aligns the documents anew and looks up each link's count. The stored key at the
   hash's place must be the pair itself, else it counts as unseen.

A bucket never holds more than (ids of A) x (ids of B) / BUCKETS pairs, a bound that both fixed
vocabularies set. Buckets are Arrow files in the shared folder; a task maps those it needs and keeps
at most ``CACHE_BYTES`` of them. Only each B id's highest count goes through the driver.

A null or empty text, or one that the joined tokens of A or B do not give back byte by byte, has
no tokens: zeros and an empty digest. Special tokens' strings in texts are plain text. A text of
any length is aligned whole; short ones share arrays of ``SLICE`` characters, and a task forgets its
chunks when it holds ``ROOM`` of them or ``ROOM_CHARS`` characters. Repeated ids and rows
are rows of their own and count each time; null ids stay null. An empty table gives no rows. Extra
columns may have any names: only doc_id and text are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.bpe_codec import merge_of
from staygrid.llm.common import BYTE_TABLE, stored, text_of
from staygrid.llm.probminhash import mix64
from staygrid.llm.token_files import store_of
from staygrid.session import shared_dir

BUCKETS = 256
#: Characters aligned in one set of arrays.
SLICE = 1_000_000
#: Chunks, and their characters, that a task remembers.
ROOM, ROOM_CHARS = 400_000, 8_000_000
#: New chunks that A encodes as one text.
TOGETHER = 400
#: Distinct pairs a task gathers before it hands them on.
HELD = 3_000_000
CACHE_BYTES = 256_000_000
#: Parts or vectors that one group of a tree takes in.
FAN = 32
PAIRS = "bucket int, part long, n long, keys binary, counts binary"
LINKS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# ---------------------------------------------------------------- minimal perfect hash

class PerfectHash:
    """Maps n keys onto 0..n-1. Level by level, keys that are alone at their bit set it and are done;
    the others go on to the next, smaller level. A key's value is the rank of its bit."""

    def __init__(self, sizes, bits):
        import numpy as np

        self.np, self.sizes, self.bits = np, sizes, bits
        self.ones = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
        self.before = np.concatenate([[0], np.cumsum(self.ones[bits])])

    @staticmethod
    def place(keys, level: int, size: int):
        import numpy as np

        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        return (mix64(mix64(keys + seed) ^ seed) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys):
        """``keys``: distinct unsigned 64-bit integers."""
        import numpy as np

        sizes, bits = [], []
        while len(keys):
            size = -(-max(64, 2 * len(keys)) // 8) * 8
            at = cls.place(keys, len(sizes), size)
            count = np.bincount(at, minlength=size)
            sizes.append(size)
            bits.append(np.packbits(count == 1, bitorder="little"))
            keys = keys[count[at] > 1]
        return cls(sizes, np.concatenate(bits) if bits else np.zeros(0, np.uint8))

    def __call__(self, keys):
        """Each key's value; -1 for a key that meets no set bit. A key outside the set may get any
        value, so callers compare the key stored there."""
        np = self.np
        out, left, first = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = first + self.place(keys[left], level, size)
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            hit = (self.bits[byte] >> bit) & 1 == 1
            lower = self.bits[byte[hit]] & ((np.uint8(1) << bit[hit]) - np.uint8(1))
            out[left[hit]] = self.before[byte[hit]] + self.ones[lower]
            left, first = left[~hit], first + size
        return out


def bucket_of(keys):
    import numpy as np

    return (mix64(keys) >> np.uint64(56)).astype(np.int64) % BUCKETS


# ---------------------------------------------------------------- aligning, in tasks

def same_by_rank(spec: str) -> bool:
    """Whether merging by the tokens' ranks makes the tokens of a tokenizer file: it is a plain byte-level BPE, and
    the merge that makes each token is the last one that lower ranks alone arrive at. Merges then come in
    the order of ranks on both sides, and at a token's rank its bytes are split as they are when alone."""
    made = json.loads(spec)
    model, before = made["model"], made["pre_tokenizer"] or {}
    plain = (made["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
             and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                                         "byte_fallback", "ignore_merges")))
    if not plain:
        return False
    back = {c: b for b, c in BYTE_TABLE.items()}
    as_bytes = lambda token: bytes(back[c] for c in token)
    added = {t["id"] for t in made["added_tokens"]}
    ranks = {as_bytes(t): i for t, i in model["vocab"].items() if i not in added}
    merges = [tuple(map(as_bytes, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    longer = sorted((i, t) for t, i in ranks.items() if len(t) > 1)
    return all(bytes([b]) in ranks for b in range(256)) and merges == [merge_of(t, ranks) for _, t in longer]


class Aligner:
    """Both tokenizers, and the links of a list of chunks."""

    def __init__(self, spec: str, pieces: bytes, pattern: str | None = None):
        import os

        # a task has one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.np = np
        whole = self.a = Tokenizer.from_str(spec)
        whole.encode_special_tokens = True
        back = {c: b for b, c in BYTE_TABLE.items()}
        self.a_bytes = [b""] * whole.get_vocab_size()
        for token, i in whole.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(back[c] for c in token)
        self.b = SentencePieceProcessor(model_proto=pieces)
        shown = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(shown)]
        self.a_len, self.b_len = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        self.n_a, self.n_b = len(self.a_bytes), len(self.b_bytes)
        #: The engine of ranks, where it makes the same tokens (``same_by_rank``).
        self.by_rank = None
        if pattern:
            from tiktoken import Encoding

            ranks = {x: i for i, x in enumerate(self.a_bytes) if x}
            self.by_rank = Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        #: No piece of B runs from another character into a blank, so none crosses a chunk's border.
        self.by_chunk = not any("▁" in p.lstrip("▁") for p in shown)

    def a_ids(self, texts: list[str]):
        """A's ids of the texts, laid end to end."""
        if self.by_rank:
            made = map(self.by_rank.encode_ordinary, texts)
        else:
            made = (e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False))
        return self.np.fromiter(chain.from_iterable(made), dtype=self.np.int64)

    def a_side(self, chunks: list[str], sizes):
        """A's ids of blank + chunk, laid end to end, and their number by chunk. Chunks that end in white
        space go one by one; the others are encoded some together, as if they followed each other."""
        np = self.np
        closed = np.array([bool(c) and not c[-1].isspace() for c in chunks], dtype=bool)
        lone = [self.a_ids([" " + chunks[i]]) for i in np.flatnonzero(~closed)]
        follow = [" " + c for c, ok in zip(chunks, closed) if ok]
        together = self.a_ids(["".join(follow[i:i + TOGETHER]) for i in range(0, len(follow), TOGETHER)])
        n = np.zeros(len(chunks), np.int64)
        n[~closed] = [len(x) for x in lone]
        # a token belongs to the chunk in whose bytes it ends
        to = np.searchsorted(np.cumsum(self.a_len[together]), np.cumsum(sizes[closed]), "right")
        n[closed] = np.diff(to, prepend=0)
        own = np.repeat(closed, n)
        out = np.zeros(len(own), np.int64)
        out[own] = together[:to[-1]] if len(to) else together
        out[~own] = np.concatenate(lone) if lone else together[:0]
        return out, n

    def encode(self, chunks: list[str]):
        """Ids of A and of B for blank + chunk, each laid end to end, the numbers of ids of each chunk, and
        which chunks are given back by both sides; the others have no ids."""
        np = self.np
        raws = [(" " + c).encode("utf-8", "surrogatepass") for c in chunks]
        sizes = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        lists = self.b.encode(chunks, num_threads=1)
        sides = [self.a_side(chunks, sizes), (np.fromiter(chain.from_iterable(lists), dtype=np.int64),
                                              np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)))]
        same, whole = np.ones(len(chunks), bool), b"".join(raws)
        for (ids, n), shown, length in zip(sides, (self.a_bytes, self.b_bytes), (self.a_len, self.b_len)):
            given = b"".join(map(shown.__getitem__, ids.tolist()))
            made = np.diff(np.concatenate([[0], np.cumsum(length[ids])])[np.cumsum(n)], prepend=0)
            same &= made == sizes
            if given != whole:
                # which chunks differ, by their bytes
                to = np.cumsum(made).tolist()
                same &= np.array([given[i:j] == raw for i, j, raw in zip([0, *to], to, raws)], dtype=bool)
        out = []
        for ids, n in sides:
            out += [ids[np.repeat(same, n)], np.where(same, n, 0)]
        return *out, same

    def links(self, a, b):
        """Ends of A's tokens, of B's, of the links and of the groups, and each link's A and B token, for ids
        laid end to end. Between two neighbouring ends of either side lies one link; no token is empty,
        so an end that comes twice is one of both sides."""
        np = self.np
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        both = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        twice = both[1:] == both[:-1]
        ends, cuts = both[np.concatenate([[True], ~twice])] if len(both) else both, both[1:][twice]
        return a_end, b_end, ends, cuts, np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)

    def keys(self, a, b):
        return a.astype(self.np.uint64) * self.np.uint64(self.n_b) + b.astype(self.np.uint64)


class Chunks(dict):
    """Chunk -> row of the arrays that ``learn`` fills; a new chunk takes the next row and is learnt with
    the others of its slice.

    ``numbers`` holds, by row: tokens of A, tokens of B, groups, links, and what ``score`` adds (two
    numbers). ``keys`` are the pairs of all links in order of rows; ``shown`` the groups' text."""

    def __init__(self, aligner: Aligner, score=None, show: bool = False):
        super().__init__()
        self.np, self.aligner, self.score = aligner.np, aligner, score
        self.marks = [f"{i}{end}" for n, ends in ((aligner.n_a, ",|"), (aligner.n_b, ",;")) for end in ends
                      for i in range(n)] if show else None
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.size, self.chars, self.new, self.shown, self.keys = 0, 0, [], [], []
        self.numbers = self.np.zeros((1024, 6), self.np.int64)
        self.same, self.joins = self.np.zeros(1024, bool), self.np.zeros(1024, bool)

    def full(self) -> bool:
        return self.size > ROOM or self.chars > ROOM_CHARS

    def __missing__(self, chunk: str) -> int:
        row = self[chunk] = self.fresh(chunk)
        return row

    def fresh(self, chunk: str) -> int:
        self.new.append(chunk)
        self.size += 1
        return self.size - 1

    def learn(self) -> None:
        np, new, first = self.np, self.new, self.size - len(self.new)
        if not new:
            return
        self.new = []
        self.chars += sum(map(len, new))
        if self.size > len(self.same):
            more = max(self.size, 2 * len(self.same)) - len(self.same)
            self.numbers = np.concatenate([self.numbers, np.zeros((more, 6), np.int64)])
            self.same, self.joins = (np.concatenate([x, np.zeros(more, bool)]) for x in (self.same, self.joins))
        a, n_a, b, n_b, same = self.aligner.encode(new)
        a_end, b_end, ends, cuts, at_a, at_b = self.aligner.links(a, b)
        # where each chunk's bytes, links and groups end
        to_a = np.cumsum(n_a)
        end = np.concatenate([[0], a_end])[to_a]
        link_to, group_to = np.searchsorted(ends, end, "right"), np.searchsorted(cuts, end, "right")
        keys = self.aligner.keys(a[at_a], b[at_b])
        self.keys.append(keys)
        each = [n_a, n_b, np.diff(group_to, prepend=0), np.diff(link_to, prepend=0)]
        if self.score:
            each += [np.diff(np.concatenate([[0], np.cumsum(x)])[link_to], prepend=0) for x in self.score(keys, b[at_b])]
        rows = slice(first, self.size)
        for i, numbers in enumerate(each):
            self.numbers[rows, i] = numbers
        self.same[rows] = same
        # its text does not end where the next blank begins a chunk
        self.joins[rows] = [not c or c[-1].isspace() for c in new]
        if self.marks:
            self.shown += self.texts(a, b, a_end, b_end, cuts, to_a + np.cumsum(n_b))

    def texts(self, a, b, a_end, b_end, cuts, to) -> list[str]:
        """The groups of each chunk as text: tokens in the order of groups, A's before B's, each with the
        mark that follows it."""
        np, n_a, n_b = self.np, self.aligner.n_a, self.aligner.n_b
        place = np.concatenate([np.searchsorted(cuts, a_end) * 2, np.searchsorted(cuts, b_end) * 2 + 1])
        marked = np.concatenate([a + n_a * np.isin(a_end, cuts), 2 * n_a + b + n_b * np.isin(b_end, cuts)])
        words = list(map(self.marks.__getitem__, marked[np.argsort(place, kind="stable")].tolist()))
        to = to.tolist()
        return ["".join(words[i:j]) for i, j in zip([0, *to], to)]

    def place(self, texts: list[str]) -> list[list[int] | None]:
        """Rows of each text's chunks; None for a text without tokens."""
        row, split = self.__getitem__, self.aligner.by_chunk
        placed = [(list(map(row, t.split(" "))) if split else [self.fresh(t)]) if t else None for t in texts]
        self.learn()
        # blanks after white space begin no chunk
        for i in self.having(placed, self.joins):
            joined = [""]
            for k, part in enumerate(texts[i].split(" ")):
                if k and joined[-1] and part and not joined[-1][-1].isspace():
                    joined.append(part)
                else:
                    joined[-1] += " " * (k > 0) + part
            placed[i] = list(map(row, joined))
        self.learn()
        # a text of which a chunk is not given back is tried as a whole
        odd = self.having(placed, ~self.same)
        for i in odd:
            placed[i] = [self.fresh(texts[i])]
        self.learn()
        for i in odd:
            if not self.same[placed[i][0]]:
                placed[i] = None
        return placed

    def having(self, placed: list, flag) -> list[int]:
        """Texts with a row whose flag is set."""
        np = self.np
        if not flag[:self.size].any():
            return []
        marked = set(np.flatnonzero(flag[:self.size]).tolist())
        return [i for i, rows in enumerate(placed) if rows and not marked.isdisjoint(rows)]


def slices(texts):
    """Texts in lists of about SLICE characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def merged(keys: list, counts: list):
    """Sorted distinct keys with their summed counts."""
    import numpy as np

    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _models(df: DataFrame, tokenizer_path: str, pieces_path: str, pattern: str | None):
    """An Aligner's arguments as a broadcast: both tokenizer files, of fixed size, and the pattern of A's pre-tokens
    where A may go by ranks."""
    with open(tokenizer_path, encoding="utf-8") as f, open(pieces_path, "rb") as g:
        spec, pieces = f.read(), g.read()
    return df.sparkSession.sparkContext.broadcast((spec, pieces, pattern if pattern and same_by_rank(spec) else None))


def _docs(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


# ---------------------------------------------------------------- counts

def pair_parts(docs: DataFrame, models) -> DataFrame:
    """Per task and key bucket: sorted distinct pairs and how often the task's links hold each."""

    def run(batches: Iterator):
        import gc

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        chunks, keys, counts = None, [], []
        # nothing here forms cycles, and the chunks held are many to look through
        gc.disable()
        part = TaskContext.get().partitionId() << 20

        def rows():
            found, number = merged(keys, counts)
            bucket = bucket_of(found)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            groups = [g for g in np.split(order, cuts) if len(g)]
            return pa.RecordBatch.from_arrays(
                [pa.array([int(bucket[g[0]]) for g in groups], pa.int32()), pa.array([part] * len(groups), pa.int64()),
                 pa.array([len(g) for g in groups], pa.int64()), pa.array([found[g].tobytes() for g in groups], pa.binary()),
                 pa.array([number[g].astype("<i8").tobytes() for g in groups], pa.binary())],
                names=["bucket", "part", "n", "keys", "counts"])

        def gather():
            """The links of the chunks seen, each as often as its chunk came."""
            found, order = np.unique(np.concatenate(chunks.keys), return_inverse=True)
            often = np.repeat(seen[:chunks.size], chunks.numbers[:chunks.size, 3])
            total = np.zeros(len(found), np.int64)
            np.add.at(total, order, often)
            keys.append(found[total > 0])
            counts.append(total[total > 0])

        for batch in batches:
            if chunks is None:
                chunks, seen = Chunks(Aligner(*models.value)), np.zeros(0, np.int64)
            for texts in slices(batch.column(1).to_pylist()):
                placed = chain.from_iterable(rows_of for rows_of in chunks.place(texts) if rows_of)
                more = np.bincount(np.fromiter(placed, dtype=np.int64), minlength=chunks.size)
                more[:len(seen)] += seen
                seen = more
                if not chunks.full():
                    continue
                gather()
                chunks.forget()
                seen = np.zeros(0, np.int64)
                if sum(map(len, keys)) > HELD:
                    yield rows()
                    keys, counts, part = [], [], part + 1
        if chunks is not None and chunks.size:
            gather()
        if sum(map(len, keys)):
            yield rows()
        gc.enable()

    return stored(docs.mapInArrow(run, PAIRS), "pair_parts")


def key_functions(parts: DataFrame) -> DataFrame:
    """bucket, n, sizes, bits, keys (in hash order): the perfect hash of each bucket's distinct pairs.
    A group unites FAN parts or so; rounds go on until a bucket is one group."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        bucket = table["bucket"][0].as_py()
        found = np.unique(np.concatenate([np.frombuffer(k.as_buffer(), "<u8") for k in table["keys"]]))
        made = PerfectHash.build(found)
        ordered = np.empty_like(found)
        ordered[made(found)] = found
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "part": pa.array([table["g"][0].as_py()], pa.int64()),
                         "n": pa.array([len(found)], pa.int64()), "sizes": pa.array([made.sizes], pa.list_(pa.int64())),
                         "bits": pa.array([made.bits.tobytes()], pa.binary()), "keys": pa.array([ordered.tobytes()], pa.binary())})

    rows = parts.select("bucket", "part", "keys")
    most = rows.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
    while True:
        groups = -(-most // FAN)
        dealt = rows.withColumn("g", F.pmod(F.xxhash64("part"), F.lit(max(groups, 1))))
        rows = stored(dealt.groupBy("bucket", "g").applyInArrow(
            run, "bucket int, part long, n long, sizes array<bigint>, bits binary, keys binary"), "pair_functions")
        if groups <= 1:
            return rows.drop("part")
        rows, most = rows.select("bucket", "part", "keys"), groups


def count_vectors(parts: DataFrame, functions: DataFrame) -> DataFrame:
    """bucket, part, counts: dense vectors in hash order, summed by a tree until each bucket has one."""

    def spread(part_rows, function_rows):
        import numpy as np
        import pyarrow as pa

        f = function_rows.to_pylist()[0]
        place, keys = PerfectHash(f["sizes"], np.frombuffer(f["bits"], np.uint8)), np.frombuffer(f["keys"], "<u8")
        total = np.zeros(f["n"], np.int64)
        for k, n in zip(part_rows["keys"], part_rows["counts"]):
            k = np.frombuffer(k.as_buffer(), "<u8")
            at = place(k)
            if not (keys[at] == k).all():
                raise ValueError("a counted pair is not in its bucket's function")
            # the pairs of a part are distinct
            total[at] += np.frombuffer(n.as_buffer(), "<i8")
        return pa.table({"bucket": pa.array([f["bucket"]], pa.int32()), "part": pa.array([f["g"]], pa.int64()),
                         "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    def add(table):
        import numpy as np
        import pyarrow as pa

        total = sum(np.frombuffer(c.as_buffer(), "<i8") for c in table["counts"])
        return pa.table({"bucket": table["bucket"].slice(0, 1), "part": pa.array([table["g"][0].as_py()], pa.int64()),
                         "counts": pa.array([total.tobytes()], pa.binary())})

    # so few vectors a bucket that they hold no more numbers than the parts they are made of
    sizes = parts.groupBy("bucket").agg(F.sum("n").alias("all")).join(functions.select("bucket", "n"), "bucket").select(
        "bucket", F.greatest(F.lit(1), F.floor(F.col("all") / F.col("n"))).cast("long").alias("groups"))
    most = sizes.agg(F.max("groups")).first()[0] or 0
    # a number a bucket
    named = F.broadcast(sizes.select(F.col("bucket").alias("of"), F.col("groups").alias("into")))
    dealt = parts.join(named, F.col("bucket") == F.col("of")).select(
        "bucket", "keys", "counts", F.pmod(F.xxhash64("part"), F.col("into")).alias("g"))
    spread_out = functions.join(F.broadcast(sizes), "bucket").withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    out = "bucket int, part long, counts binary"
    rows = stored(dealt.groupBy("bucket", "g").cogroup(spread_out.groupBy("bucket", "g")).applyInArrow(spread_or_none(spread), out), "pair_vectors")
    while most > 1:
        most = -(-most // FAN)
        rows = stored(rows.withColumn("g", F.pmod("part", F.lit(most))).groupBy("bucket", "g").applyInArrow(add, out), "pair_vectors")
    return rows


def spread_or_none(spread):
    """A group of a function without parts of its own gives no vector."""

    def run(part_rows, function_rows):
        import pyarrow as pa

        if part_rows.num_rows == 0:
            return pa.table({"bucket": pa.array([], pa.int32()), "part": pa.array([], pa.int64()),
                             "counts": pa.array([], pa.binary())})
        return spread(part_rows, function_rows)

    return run


def write_buckets(functions: DataFrame, vectors: DataFrame, out_dir: str, n_b: int) -> DataFrame:
    """One Arrow file a bucket (sizes, bits, keys, counts), and a stored row a file with the highest
    count of each B id in it."""
    import pyarrow as pa

    kinds = pa.schema([("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator):
        import numpy as np
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        store, base = store_of(out_dir)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for r in batch.to_pylist():
                name = f"bucket-{r['bucket']:03d}.arrow"
                draft = f"{base}/_draft-{attempt}-{name}"
                with store.open_output_stream(draft) as sink, pa.ipc.new_file(sink, kinds) as w:
                    w.write_table(pa.Table.from_pylist([{c: r[c] for c in kinds.names}], schema=kinds))
                store.move(draft, f"{base}/{name}")
                keys, counts = np.frombuffer(r["keys"], "<u8"), np.frombuffer(r["counts"], "<i8")
                b = (keys % np.uint64(n_b)).astype(np.int64)
                ids, at = np.unique(b, return_inverse=True)
                best = np.zeros(len(ids), np.int64)
                np.maximum.at(best, at, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["bucket"]], pa.int32()), pa.array([f"{out_dir}/{name}"]), pa.array([len(keys)], pa.int64()),
                     pa.array([ids.tolist()], pa.list_(pa.int32())), pa.array([best.tolist()], pa.list_(pa.int64()))],
                    names=["bucket", "file", "n", "ids", "best"])

    both = functions.join(vectors.select("bucket", "counts"), "bucket").select("bucket", *kinds.names)
    return stored(both.mapInArrow(run, "bucket int, file string, n long, ids array<int>, best array<bigint>"), "pair_files")


class PairCounts:
    """Counts of pairs from the bucket files; the least recently used are dropped beyond CACHE_BYTES."""

    def __init__(self, files: dict[int, str], room: int = CACHE_BYTES):
        from collections import OrderedDict

        self.files, self.room, self.held, self.used = files, room, OrderedDict(), 0

    def bucket(self, i: int):
        import numpy as np
        import pyarrow as pa

        if i in self.held:
            self.held.move_to_end(i)
            return self.held[i]
        store, path = store_of(self.files[i])
        with store.open_input_file(path) as f:
            r = pa.ipc.open_file(f).read_all().to_pylist()[0]
        made = (PerfectHash(r["sizes"], np.frombuffer(r["bits"], np.uint8)),
                np.frombuffer(r["keys"], "<u8"), np.frombuffer(r["counts"], "<i8"))
        self.held[i] = made
        self.used += made[1].nbytes * 2
        while self.used > self.room and len(self.held) > 1:
            self.used -= self.held.popitem(last=False)[1][1].nbytes * 2
        return made

    def __call__(self, keys):
        """Count of each of the distinct keys; 0 where the key at the hash's place is another one."""
        import numpy as np

        out, bucket = np.zeros(len(keys), np.int64), bucket_of(keys)
        order = np.argsort(bucket, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if not len(group) or int(bucket[group[0]]) not in self.files:
                continue
            place, known, counts = self.bucket(int(bucket[group[0]]))
            at = place(keys[group])
            same = (at >= 0) & (known[at] == keys[group])
            out[group[same]] = counts[at[same]]
        return out


def pair_counts(df: DataFrame, tokenizer_path: str, pieces_path: str, pattern: str | None = None) -> DataFrame:
    """Counts every linked pair of the corpus; the stored row a bucket that ``align`` reads."""
    from sentencepiece import SentencePieceProcessor

    parts = pair_parts(_docs(df), _models(df, tokenizer_path, pieces_path, pattern))
    functions = key_functions(parts)
    n_b = SentencePieceProcessor(model_file=pieces_path).get_piece_size()
    return write_buckets(functions, count_vectors(parts, functions), shared_dir(df.sparkSession, "pair_buckets"), n_b)


def count_table(files: DataFrame, n_b: int) -> DataFrame:
    """(a, b, n) of every pair, from the bucket files."""

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, keys, counts = PairCounts({i: file}).bucket(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((keys // np.uint64(n_b)).astype(np.int64)), pa.array((keys % np.uint64(n_b)).astype(np.int64)),
                     pa.array(counts)], names=["a", "b", "n"])

    return files.select("bucket", "file").mapInArrow(run, "a long, b long, n long")


def align(df: DataFrame, files: DataFrame, tokenizer_path: str, pieces_path: str, pattern: str | None = None) -> DataFrame:
    """Second pass: each document's tokens, groups and links, with the counts of ``files``."""
    sc = df.sparkSession.sparkContext
    models = _models(df, tokenizer_path, pieces_path, pattern)
    # one short row a bucket, one number an id of B
    paths = {r.bucket: r.file for r in files.select("bucket", "file").collect()}
    tops = files.select(F.explode(F.arrays_zip("ids", "best")).alias("p")).groupBy(F.col("p.ids").alias("b")).agg(
        F.max("p.best").alias("top")).collect()
    known = sc.broadcast({r.b: r.top for r in tops})

    def run(batches: Iterator):
        import gc
        from hashlib import sha256

        import numpy as np
        import pyarrow as pa

        chunks = None
        gc.disable()
        for batch in batches:
            if chunks is None:
                aligner, counts = Aligner(*models.value), PairCounts(paths)
                top = np.zeros(aligner.n_b, np.int64)
                for i, n in known.value.items():
                    top[i] = n

                def score(keys, b):
                    """Of each link: whether its count is its B id's highest, and the count."""
                    found, back = np.unique(keys, return_inverse=True)
                    number = counts(found)[back]
                    return (number == top[b]) & (number > 0), number

                chunks = Chunks(aligner, score, show=True)
            out = []
            for texts in slices(batch.column(1).to_pylist()):
                placed = chunks.place(texts)
                held = [rows for rows in placed if rows]
                starts = np.cumsum([0] + [len(rows) for rows in held])[:-1]
                flat = np.fromiter(chain.from_iterable(held), dtype=np.int64)
                sums = iter(np.add.reduceat(chunks.numbers[flat], starts).tolist() if held else ())
                for rows in placed:
                    if rows is None:
                        out.append((0, 0, 0, 0, 0, 0, ""))
                        continue
                    groups = "".join(map(chunks.shown.__getitem__, rows))[:-1]
                    out.append((*next(sums), sha256(groups.encode()).hexdigest()))
                if chunks.full():
                    chunks.forget()
            cols = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.string())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
        gc.enable()

    return _docs(df).mapInArrow(run, LINKS)


def alignment_report(df: DataFrame, tokenizer_path: str, pieces_path: str, pattern: str | None = None) -> DataFrame:
    """Counts the pairs of ``df`` and aligns it with them. ``pattern`` is that of A's pre-tokens; with it, A runs
    on the faster engine of ranks if that provably makes the same tokens."""
    return align(df, pair_counts(df, tokenizer_path, pieces_path, pattern), tokenizer_path, pieces_path, pattern)
