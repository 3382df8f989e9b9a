"""Near-duplicate documents by ProbMinHash (operator 1).

Texts are lower-cased (A-Z) words; shingles are windows of five words, a shorter text being one
shingle. A signature of ``REGISTERS`` registers estimates the probability Jaccard similarity of two
weighted sets, which is the Jaccard similarity where weights are equal. Links are decided by the
Jaccard similarity of shingle sets, so all weights are 1: candidates are drawn by the measure that
decides. Bands of ``ROWS`` registers name buckets; documents that share a bucket are candidates and
are verified exactly, ``THRESHOLD`` or more being a link; nothing estimated stands between. Classes
are the connected components of the links.

Equal word sequences are one node from the start, so copies cost one row each. Buckets of up to
``SMALL`` nodes give their pairs. Larger ones are taken in blocks in one task each, together with a few
leaders of the bucket, so that similar blocks meet through them; then every node outside a bucket's
largest class is compared with all others of the bucket, again in blocks, where no pair of one class
is looked at twice and only links are emitted. So no candidate pair of different classes is left out
and no group gives all its pairs.

Null text is empty; empty texts are copies of each other. Null ids take part; a class is named by its
least doc_id (null if it has none). Repeated rows are copies. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staygrid.llm.common import Memo, stored, text_of
from staygrid.llm.components import components

REGISTERS, ROWS = 120, 5
BANDS = REGISTERS // ROWS
WORDS = 5
THRESHOLD = 0.8
SMALL = 16
#: Partners from which on all sets of a block are counted in one pass.
MANY = 12
BLOCK = 512
LEADERS = 8


# ---------------------------------------------------------------- in tasks

def mix64(x):
    """Finaliser of splitmix64, for arrays of unsigned 64-bit integers."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(elements, weights, docs, n_docs: int, m: int = REGISTERS):
    """ProbMinHash signatures (n_docs x m) of weighted elements; ``docs`` is each one's document.

    Every element is a Poisson process whose rate is its weight; an arrival falls in a random
    register, which keeps the element of its earliest arrival. An element stops once its next
    arrival is later than every register of its document. Two documents agree in a register with
    the probability Jaccard similarity of their weights."""
    import numpy as np

    early = np.full(n_docs * m, np.inf)
    winner = np.zeros(n_docs * m, np.uint64)
    time = np.zeros(len(elements))
    state = mix64(elements + np.uint64(0x9E3779B97F4A7C15))
    while len(elements):
        state = mix64(state + np.uint64(0x9E3779B97F4A7C15))
        u = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        time = time - np.log(u) / weights
        late = early.reshape(n_docs, m).max(1)
        go = time < late[docs]
        elements, weights, docs, time, state = elements[go], weights[go], docs[go], time[go], state[go]
        at = docs * m + (mix64(state ^ elements) % np.uint64(m)).astype(np.int64)
        wins = np.flatnonzero(time < early[at])
        # latest first, so that the earliest arrival in a register is written last
        wins = wins[np.argsort(-time[wins], kind="stable")]
        early[at[wins]], winner[at[wins]] = time[wins], elements[wins]
    return winner.reshape(n_docs, m)


class Shingler:
    """Words and shingle hashes of texts; a bounded memo keeps the hashes of words."""

    def __init__(self):
        from xxhash import xxh3_64_intdigest

        self.memo = Memo(xxh3_64_intdigest, 300_000)

    @staticmethod
    def words(text: str) -> list[bytes]:
        return text.encode("utf-8", "surrogatepass").lower().split()

    def shingles(self, words: list[bytes]):
        """Distinct shingle hashes in order."""
        import numpy as np

        if not words:
            return np.zeros(0, np.uint64)
        w = np.fromiter(map(self.memo.__getitem__, words), dtype=np.uint64, count=len(words))
        n = max(len(w) - WORDS + 1, 1)
        h = np.zeros(n, np.uint64)
        for k in range(min(WORDS, len(w))):
            h = mix64(h * np.uint64(3) + w[k:k + n] + np.uint64(k + 1))
        return np.unique(h)

    def signed(self, texts: list[list[bytes]]):
        """Signatures of a list of texts and their shingle sets, in parts of bounded size."""
        import numpy as np

        made, out, size = [], [], 0

        def flush():
            parts = list(made)
            flat = np.concatenate(parts)
            docs = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            out.extend(zip(signatures(flat, np.ones(len(flat)), docs, len(parts)), parts))
            made.clear()

        for words in texts:
            made.append(self.shingles(words))
            size += len(made[-1]) + REGISTERS
            if size > 400_000:
                flush()
                size = 0
        if made:
            flush()
        return out


def band_hashes(signature):
    import numpy as np

    rows = signature.reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        h = mix64(h * np.uint64(3) + rows[:, k])
    return h.view(np.int64)


def common(a, b) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    import numpy as np

    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(a) else 0


def is_link(a, b) -> bool:
    both = common(a, b)
    union = len(a) + len(b) - both
    return union > 0 and both >= THRESHOLD * union


class Overlap:
    """Intersection sizes of one set with all of a list of sets, none empty, by one pass over them."""

    def __init__(self, sets):
        import numpy as np

        self.np = np
        self.known, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        self.mark = np.zeros(len(self.known), np.uint8)

    def sizes(self, one):
        np = self.np
        at = np.searchsorted(self.known, one)
        at[at == len(self.known)] = 0
        at = at[self.known[at] == one]
        self.mark[at] = 1
        out = np.add.reduceat(self.mark[self.flat], self.first, dtype=np.int64)
        self.mark[at] = 0
        return out


def linked(sets, labels, left, right, allowed=None) -> list[tuple[int, int]]:
    """Links that join different labels, comparing positions ``left`` with ``right`` until all
    pairs either carry one label or have been verified. ``allowed(i, js)`` narrows the partners;
    sets of unlike sizes cannot reach the threshold."""
    import numpy as np

    labels, found, overlap = labels.copy(), [], None
    size = np.array([len(s) for s in sets])
    for i in left:
        at = np.flatnonzero(labels[right] != labels[i])
        n = size[right[at]]
        at = at[np.minimum(n, size[i]) >= THRESHOLD * np.maximum(n, size[i])]
        if allowed is not None and len(at):
            at = at[allowed(i, right[at])]
        if len(at) >= MANY:
            overlap = overlap or Overlap([sets[j] for j in right])
            both = overlap.sizes(sets[i])[at]
            js = right[at[both >= THRESHOLD * (size[i] + size[right[at]] - both)]]
        else:
            js = right[at]
        for j in js.tolist():
            if labels[i] != labels[j] and (len(at) >= MANY or is_link(sets[i], sets[j])):
                found.append((i, j))
                labels[labels == labels[j]] = labels[i]
    return found


# ---------------------------------------------------------------- stages

def digest_rows(df: DataFrame) -> DataFrame:
    """doc_id, text_key, node (digest of the word sequence), bands; a row a document; stored."""
    text = text_of()
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))

    def run(batches: Iterator):
        import hashlib

        import pyarrow as pa

        shingler = Shingler()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                words = [shingler.words(t) for t in b.column("text").slice(at, 500).to_pylist()]
                nodes = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words]
                bands = [band_hashes(s).tolist() if len(e) else [] for s, e in shingler.signed(words)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(at, 500), b.column("text_key").slice(at, 500),
                     pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "node", "bands"])

    return stored(docs.mapInArrow(run, "doc_id long, text_key long, node binary, bands array<long>"), "near_rows")


def node_table(rows: DataFrame) -> DataFrame:
    """node, doc_id and text_key of its first row (least id), bands; stored."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "bands")).alias("f")
    return stored(rows.groupBy("node").agg(first).select(
        "node", F.col("f.doc_id").alias("doc_id"), F.col("f.text_key").alias("text_key"),
        F.col("f.bands").alias("bands")), "near_nodes")


def bucket_members(nodes: DataFrame) -> DataFrame:
    """bucket, band, size, node, of the buckets with two nodes or more; stored."""
    each = nodes.select("node", F.posexplode("bands").alias("band", "h")) \
        .select("node", "band", F.xxhash64("band", "h").alias("bucket"))
    sizes = each.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return stored(each.join(sizes, "bucket").select("bucket", "band", "size", "node"), "near_buckets")


def shingle_sets(df: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """node, shingles (sorted distinct hashes), bands, of the nodes in buckets; stored. One text of
    each node is fetched again by its id and text hash."""
    wanted = members.select("node").distinct().join(nodes, "node") \
        .select("node", "bands", F.col("doc_id").alias("w_id"), F.col("text_key").alias("w_key"))
    text = text_of()
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(F.col("w_id")) & (docs["text_key"] == F.col("w_key"))) \
        .select("node", "bands", "text")

    def run(batches: Iterator):
        import pyarrow as pa

        shingler = Shingler()
        for b in (x.slice(at, 500) for x in batches for at in range(0, x.num_rows, 500)):
            made = [shingler.shingles(shingler.words(t)).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(made, pa.binary()), b.column("bands")],
                                             names=["node", "shingles", "bands"])

    made = texts.mapInArrow(run, "node binary, shingles binary, bands array<long>")
    # a repeated row gives its node twice
    return stored(made.groupBy("node").agg(F.max(F.struct("shingles", "bands")).alias("s"))
                  .select("node", "s.*"), "near_sets")


def small_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) among the pairs of small buckets, each pair verified once."""
    few = members.where(F.col("size") <= SMALL)
    a, b = few.select("bucket", F.col("node").alias("a")), few.select("bucket", F.col("node").alias("b"))
    pairs = a.join(b, "bucket").where("a < b").select("a", "b").distinct()
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        for x in batches:
            left, right = x.column("of_a").to_pylist(), x.column("of_b").to_pylist()
            keep = [is_link(np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)) for s, t in zip(left, right)]
            yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a binary, b binary")


def _arrays(table):
    import numpy as np

    nodes = table["node"].to_pylist()
    return nodes, [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]


def _links_table(nodes, found):
    import pyarrow as pa

    return pa.table({"a": pa.array([nodes[i] for i, _ in found], pa.binary()),
                     "b": pa.array([nodes[j] for _, j in found], pa.binary())})


def block_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links within blocks of large buckets. A node goes to the largest of its buckets; every block
    of a bucket also has the bucket's leaders."""
    chosen = members.where(F.col("size") > SMALL).groupBy("node") \
        .agg(F.max(F.struct("size", "bucket")).alias("m")).select("node", F.col("m.bucket").alias("bucket"))
    blocks = chosen.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = chosen.join(blocks, "bucket")
    order = Window.partitionBy("bucket").orderBy(F.xxhash64("node"), "node")
    leaders = placed.where("blocks > 1").withColumn("r", F.row_number().over(order)).where(F.col("r") <= LEADERS) \
        .select("bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "node")
    cells = placed.select("bucket", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), "node") \
        .unionByName(leaders).distinct().join(sets.select("node", "shingles"), "node")

    def run(cell):
        import numpy as np

        nodes, sets_ = _arrays(cell)
        at = np.arange(len(nodes))
        return _links_table(nodes, linked(sets_, at, at, at))

    return cells.groupBy("bucket", "block").applyInArrow(run, "a binary, b binary")


def remaining_links(members: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between different classes in large buckets: the nodes outside a bucket's largest class
    against all its nodes. A pair is looked at in the first band it shares."""
    large = members.where(F.col("size") > SMALL).join(labels, "node", "left") \
        .select("bucket", "band", "size", "node", F.coalesce("label", "node").alias("label"))
    classes = large.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    largest = classes.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("total"))
    opened = largest.where("total > top.n").select(
        "bucket", F.col("top.label").alias("top"),
        F.ceil((F.col("total") - F.col("top.n")) / BLOCK).cast("int").alias("rests"),
        F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks"))
    here = large.join(opened, "bucket")
    deal = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = here.where("label <> top").select("bucket", "band", deal("rests", 1).alias("i"), each("blocks").alias("j"),
                                             "node", "label", F.lit(True).alias("rest"))
    rows = here.select("bucket", "band", each("rests").alias("i"), deal("blocks", 2).alias("j"),
                       "node", "label", F.lit(False).alias("rest"))
    cells = rest.unionByName(rows).join(sets, "node")

    def run(cell):
        import numpy as np

        nodes, sets_ = _arrays(cell)
        bands = np.array(cell["bands"].to_pylist(), dtype=np.int64)
        band, is_rest = cell["band"][0].as_py(), np.array(cell["rest"].to_pylist())
        _, labels_ = np.unique(np.array([x.hex() for x in cell["label"].to_pylist()]), return_inverse=True)
        first = lambda i, js: (bands[js] == bands[i]).argmax(1) == band
        return _links_table(nodes, linked(sets_, labels_.ravel(), np.flatnonzero(is_rest),
                                          np.flatnonzero(~is_rest), first))

    return cells.groupBy("bucket", "i", "j").applyInArrow(run, "a binary, b binary")


def near_classes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): the digest row of each document, and (node, label) of the linked nodes."""
    rows = digest_rows(df)
    nodes = node_table(rows)
    members = bucket_members(nodes)
    sets = shingle_sets(df, nodes, members)
    links = stored(small_links(members, sets).unionByName(block_links(members, sets)), "near_links")
    labels = stored(components(links), "near_labels")
    more = stored(remaining_links(members, sets, labels), "near_links")
    if not more.isEmpty():
        labels = stored(components(links.unionByName(more)), "near_labels")
    return rows, labels


def class_report(df: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), class_size: a row a document row."""
    rows, labels = near_classes(df)
    named = rows.groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")) \
        .join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "low", "n")
    classes = named.groupBy("label").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_size"))
    by_node = named.select("node", "label").join(classes, "label").select("node", "class_id", "class_size")
    return rows.select("doc_id", "node").join(by_node, "node").select("doc_id", "class_id", "class_size")


def one_of_each(df: DataFrame) -> DataFrame:
    """``df`` with one row of each class, the one of least doc_id (then least text hash)."""
    rows, labels = near_classes(df)
    named = rows.select("doc_id", "text_key", "node").join(labels, "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    kept = named.groupBy("label").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("f")).select(
        F.col("f.doc_id").alias("_near_id"), F.col("f.text_key").alias("_near_key"))
    keyed = df.withColumn("_near_text", F.xxhash64(text_of()))
    out = keyed.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_near_id"))
                     & (F.col("_near_text") == F.col("_near_key")), "left_semi")
    if not rows.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        order = Window.partitionBy("doc_id", "_near_text").orderBy(*[F.col(c).cast("string") for c in df.columns])
        out = out.withColumn("_near_row", F.row_number().over(order)).where("_near_row = 1")
    return out.select(*df.columns)
