"""Byte-level BPE encoding and decoding (operator 8).

A ``tokenizers`` BPE model is built from a file of ranks (one base64 token and its rank a line).
Texts are encoded in Arrow batches: each pre-token is mapped to byte characters, run through the
model once per task (a bounded memo holds the ids of pre-tokens met before) and the ids of a
text are the joined ids of its pre-tokens. Decoding goes from ids to byte characters' bytes by
the reversed table; characters split over tokens come together when the bytes are joined.

Null text is read as empty and gives no ids. Extra columns are carried along unchanged.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staygrid.llm.common import BYTE_TABLE, Memo, PreTokens, to_byte_chars


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The last pair that merges into ``token`` when only lower ranks are used."""
    limit, parts = ranks[token], [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best, at = min((ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1))
        if best >= limit:
            raise ValueError(f"token {token!r} cannot be reached by merges")
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


def model_spec(ranks: dict[bytes, int]) -> str:
    """JSON of vocabulary and merges in byte characters, made once on the driver."""
    chars = lambda b: b.decode("latin-1").translate(BYTE_TABLE)
    vocab = {chars(t): r for t, r in ranks.items()}
    merges = [[chars(x) for x in merge_of(t, ranks)]
              for t, r in sorted(ranks.items(), key=lambda x: x[1]) if len(t) > 1]
    return json.dumps({"vocab": vocab, "merges": merges})


class Codec:
    """Task-side encoder and decoder over one model specification."""

    def __init__(self, spec: str, pattern: str):
        import numpy as np
        from tokenizers import models

        made = json.loads(spec)
        self.np = np
        self.model = models.BPE(vocab=made["vocab"], merges=[tuple(m) for m in made["merges"]], cache_capacity=0)
        self.find = PreTokens(pattern)
        back = {c: b for b, c in BYTE_TABLE.items()}
        self.byte_of = {i: bytes(back[c] for c in t) for t, i in made["vocab"].items()}
        self.memo = Memo(self.piece)

    def piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(to_byte_chars(piece))]
        return self.np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.find(text)))

    def ids(self, packed: bytes) -> list[int]:
        return self.np.frombuffer(packed, dtype="<u4").tolist()

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.byte_of.__getitem__, self.ids(packed)))

    def offsets(self, text: str, packed: bytes) -> list[tuple[int, int]]:
        """Character span of each token; a token inside a character spans that character."""
        chars = [i for i, c in enumerate(text) for _ in c.encode("utf-8", "surrogatepass")]
        out, at = [], 0
        for i in self.ids(packed):
            end = at + len(self.byte_of[i])
            out.append((chars[at], chars[end - 1] + 1))
            at = end
        return out


def _spec(spark: SparkSession, ranks_path: str):
    return spark.sparkContext.broadcast(model_spec(read_ranks(ranks_path)))


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids",
           offsets: str | None = None) -> DataFrame:
    """``df`` plus ``out`` (binary, 4 bytes an id) and, where named, ``offsets``
    (array of [start, end) characters). The vocabulary is a fixed file of about 1 MB."""
    spec = _spec(df.sparkSession, ranks_path)
    schema = T.StructType([f for f in df.schema.fields if f.name not in (out, offsets)])
    kept = [f.name for f in schema.fields]
    schema = schema.add(out, "binary")
    if offsets:
        schema = schema.add(offsets, "array<struct<start:int,end:int>>")

    def run(batches: Iterator):
        import pyarrow as pa

        codec = Codec(spec.value, pattern)
        for b in batches:
            texts = [t or "" for t in b.column(text).to_pylist()]
            packed = [codec.encode(t) for t in texts]
            cols = [b.column(c) for c in kept] + [pa.array(packed, pa.binary())]
            if offsets:
                spans = [[{"start": s, "end": e} for s, e in codec.offsets(t, p)] for t, p in zip(texts, packed)]
                cols.append(pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
            yield pa.RecordBatch.from_arrays(cols, names=kept + [out] + [offsets] * bool(offsets))

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` plus ``out``: the bytes of the ids (binary). Null ids decode to no bytes."""
    spec = _spec(df.sparkSession, ranks_path)
    schema = T.StructType([f for f in df.schema.fields if f.name != out])
    kept = [f.name for f in schema.fields]
    schema = schema.add(out, "binary")

    def run(batches: Iterator):
        import pyarrow as pa

        codec = Codec(spec.value, pattern)
        for b in batches:
            made = [codec.decode(x or b"") for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(made, pa.binary())],
                                             names=kept + [out])

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip (the bytes came back whole): each text
    encoded and its ids decoded in one pass, so a task keeps one codec."""
    spec = _spec(df.sparkSession, ranks_path)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator):
        from hashlib import sha256

        import pyarrow as pa

        codec = Codec(spec.value, pattern)
        for b in batches:
            out = []
            for text in b.column("text"):
                text = text.as_py()
                packed = codec.encode(text)
                plain = codec.decode(packed)
                out.append((len(packed) // 4, sha256(packed).hexdigest(), sha256(plain).hexdigest(),
                            plain == text.encode("utf-8", "surrogatepass")))
            cols = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean")
