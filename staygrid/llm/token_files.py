"""Token-ID output as Arrow files of equal-length sequences (operator 3).

Documents are range-partitioned by doc_id and sorted; each partition is tokenised with the
``tokenizers`` library and written as one Arrow IPC file whose record batches hold
``ids: fixed_size_list<uint16|uint32>[seq_len]`` and ``mask: fixed_size_list<bool>[seq_len]``
(true on real tokens, false on the padding of a file's last sequence), uncompressed, so a
memory-mapped file gives any sequence without a copy. A second small IPC file lists
(doc_id, start, n_tokens) of the documents in the file. Files are written under a temporary name
and moved into place, so a repeated task replaces its own file and nothing else.

Null text counts as empty (the end id alone); rows with a null doc_id come first; repeated ids
keep all their rows, in order of their texts' hash. An empty table gives no files and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid.llm.common import Memo, PreTokens, stored, text_of, to_byte_chars

MANIFEST = "file string, part int, n_docs long, n_tokens long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Sequences in a record batch; fixed, so a sequence's batch is found by division.
BATCH_ROWS = 64
#: Characters that a file holds, about. Larger files meet fewer new pre-tokens in each task and give
#: fewer, longer runs of sequences; a task holds this much text while it sorts.
CHARS_PER_FILE = 32_000_000


def store_of(uri: str):
    """(file system, path) of a URI or a plain path."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class TextEncoder:
    """Pre-tokens are found by the byte-level pattern and each new one goes through the model
    once; a bounded memo keeps the packed ids of the others. A text that holds an added token of
    the tokenizer goes through the library's encode as a whole."""

    def __init__(self, spec: str, pattern: str, id_type: str):
        import struct

        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(spec)
        self.model, self.pack = self.whole.model, struct.pack
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.code = {"<u2": "H", "<u4": "I"}[id_type]
        self.find = PreTokens(pattern)
        self.memo = Memo(self.piece, 600_000)

    def packed(self, ids: list[int]) -> bytes:
        return self.pack(f"<{len(ids)}{self.code}", *ids)

    def piece(self, piece: str) -> bytes:
        return self.packed([t.id for t in self.model.tokenize(to_byte_chars(piece))])

    def encode(self, text: str) -> bytes:
        for token in self.added:
            if token in text:
                return self.packed(self.whole.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.memo.__getitem__, self.find(text)))


class SequenceFile:
    """Packs a stream of ids into fixed-size-list batches of one Arrow file."""

    def __init__(self, sink, id_type: str, seq_len: int):
        import numpy as np
        import pyarrow as pa

        self.np, self.pa, self.n = np, pa, seq_len
        kind = pa.uint16() if id_type == "<u2" else pa.uint32()
        self.kind, self.id_type = kind, id_type
        self.schema = pa.schema([("ids", pa.list_(kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.out = pa.ipc.new_file(sink, self.schema)
        self.held, self.size, self.full = [], 0, BATCH_ROWS * seq_len

    def add(self, packed: bytes) -> None:
        ids = self.np.frombuffer(packed, dtype=self.id_type)
        while len(ids):
            take = ids[: self.full - self.size]
            self.held.append(take)
            self.size += len(take)
            ids = ids[len(take):]
            if self.size == self.full:
                self.flush()

    def flush(self) -> None:
        if not self.size:
            return
        pa, np = self.pa, self.np
        rows = -(-self.size // self.n)
        flat = np.zeros(rows * self.n, dtype=self.id_type)
        flat[: self.size] = np.concatenate(self.held)
        mask = np.arange(rows * self.n) < self.size
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x, type=t), self.n)
                 for x, t in ((flat, self.kind), (mask, pa.bool_()))]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.out.close()


class TokenFile:
    """Random access to a written file; views of the mapped batches, no copy within a batch."""

    def __init__(self, uri: str):
        import numpy as np
        import pyarrow as pa
        from pyarrow import fs

        self.np = np
        store, path = store_of(uri)
        local = isinstance(store, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else store.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.n = self.reader.schema.field("ids").type.list_size
        self.batches = self.reader.num_record_batches
        self.last = {}

    def _flat(self, batch: int, column: int):
        """All values of a column of a batch; the last batch of each column stays open."""
        at, flat = self.last.get(column, (-1, None))
        if at != batch:
            flat = self.reader.get_batch(batch).column(column).flatten().to_numpy(zero_copy_only=column == 0)
            self.last[column] = (batch, flat)
        return flat

    def sequence(self, i: int):
        """(ids, mask) of the i-th equal-length sequence."""
        batch, row = divmod(i, BATCH_ROWS)
        part = slice(row * self.n, (row + 1) * self.n)
        return self._flat(batch, 0)[part], self._flat(batch, 1)[part]

    def span(self, start: int, count: int):
        """``count`` ids from position ``start`` of the file's stream."""
        size, parts = BATCH_ROWS * self.n, []
        while count > 0:
            batch, at = divmod(start, size)
            part = self._flat(batch, 0)[at: at + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else self.np.concatenate(parts or [self.np.zeros(0, "<u2")])


def write_token_files(df: DataFrame, out_dir: str, tokenizer_path: str, pattern: str, end_id: int,
                      seq_len: int = 2048, chars_per_file: int = CHARS_PER_FILE) -> DataFrame:
    """Write all documents; returns the stored manifest (one row a file)."""
    import json
    import math

    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        raw = f.read()
    made = json.loads(raw)
    top = max([end_id, *made["model"]["vocab"].values(), *(t["id"] for t in made["added_tokens"])])
    id_type = "<u2" if top < 65536 else "<u4"
    spec = spark.sparkContext.broadcast(raw)
    out_dir = out_dir.rstrip("/")

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        store, base = store_of(out_dir)
        name, draft = f"{base}/part-{part:06d}", f"{base}/_draft-{part:06d}-{attempt}"
        encoder, end = None, np.array([end_id], dtype=id_type).tobytes()
        ids, starts, counts, at = [], [], [], 0
        for b in batches:
            if encoder is None:
                store.create_dir(base, recursive=True)
                encoder = TextEncoder(spec.value, pattern, id_type)
                sink = store.open_output_stream(f"{draft}.arrow")
                file = SequenceFile(sink, id_type, seq_len)
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                packed = encoder.encode(text) + end
                file.add(packed)
                n = len(packed) // int(id_type[-1])
                ids.append(doc_id)
                starts.append(at)
                counts.append(n)
                at += n
        if encoder is None:
            return
        file.close()
        sink.close()
        index = pa.table({"doc_id": pa.array(ids, pa.int64()), "start": pa.array(starts, pa.int64()),
                          "n_tokens": pa.array(counts, pa.int64())})
        with store.open_output_stream(f"{draft}.index") as s, pa.ipc.new_file(s, index.schema) as w:
            w.write_table(index)
        for kind in ("arrow", "index"):
            store.move(f"{draft}.{kind}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict(
            {"file": [f"{out_dir}/part-{part:06d}"], "part": pa.array([part], pa.int32()),
             "n_docs": [len(ids)], "n_tokens": [at]})

    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    files = max(1, math.ceil(chars / chars_per_file))
    # rows of one id (or of none) are told apart by their texts' hash, so that they can be split
    place = ["doc_id", F.xxhash64("text")]
    dealt = docs.repartitionByRange(files, *place).sortWithinPartitions(*place)
    return stored(dealt.mapInArrow(run, MANIFEST), "token_manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (over all files in order), n_tokens and the
    crc32 of its ids as little-endian unsigned 32-bit integers. The manifest has a row a file, so
    the files' first positions are summed on the driver."""
    files, at = [], 0
    for r in manifest.orderBy("part").select("file", "n_tokens").collect():
        files.append((r.file, at))
        at += r.n_tokens
    if not files:
        return spark.createDataFrame([], DOCS)

    def run(batches: Iterator):
        import zlib

        import pyarrow as pa

        for batch in batches:
            for uri, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, path = store_of(uri + ".index")
                with store.open_input_file(path) as f:
                    index = pa.ipc.open_file(f).read_all().combine_chunks()
                tokens = TokenFile(uri + ".arrow")
                starts, counts = index["start"].to_pylist(), index["n_tokens"].to_pylist()
                crcs = [zlib.crc32(tokens.span(s, n).astype("<u4").tobytes()) for s, n in zip(starts, counts)]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": index["doc_id"].chunk(0), "start": [first + s for s in starts],
                     "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())})

    listed = spark.createDataFrame(files, "file string, first long").repartition(len(files))
    return listed.mapInArrow(run, DOCS)
