"""SimHash document fingerprints and Hamming search by permuted block tables (operator 7).

Terms are the windows of ``SHINGLE`` words; each occurrence of a term votes on 128 signed bits by two
64-bit hashes of the term, so a term weighs as often as it occurs. The votes are sums in one hash
aggregation: the terms of a text are exploded and summed in the task that read the text, where each
sum holds two bits' counts in its halves. A bit is set when more votes are for than against.

Fingerprints within a Hamming radius r are found exactly: split in r + 1 blocks, two such
fingerprints agree in at least one block, so each block in turn heads a permuted table; a pair is
counted in the first table where it meets. Distinct fingerprints stand for all their copies.

Null text is empty; a text without words has the fingerprint of all zero bits. Equal texts have
equal fingerprints. Repeated rows keep their rows. A row without doc_id has no place in the order
of documents: its next document counts as an empty text. Of several texts under one doc_id the
greatest prefix is the one that the document before it takes. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staygrid.llm.common import SPACE_CHARS, SPACE_CLASS, stored, text_of

SHINGLE = 3
BITS = 128
_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF


def let(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def term_hashes(text: Column, seed: int) -> Column:
    """Hash of every window of SHINGLE words (shorter at the end; a short text has its windows too)."""
    bare = F.trim(text, F.lit(SPACE_CHARS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS + "+"))
    window = lambda ws: F.transform(ws, lambda w, i: F.xxhash64(
        F.lit(seed), w, *[F.get(ws, i + k) for k in range(1, SHINGLE)]))
    return let(words, window)


def fingerprints(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per distinct ``keys``: keys, ``rows`` (how many rows had them), ``hi`` and ``lo``
    (64 bits each). Rows with equal keys must have equal texts."""
    # The second hash is a remix of the first, so each window of words is hashed once.
    terms = rows.select(*keys, F.posexplode_outer(term_hashes(F.col(text), 7)).alias("_pos", "_a"))
    terms = terms.withColumn("_b", F.when(F.col("_a").isNotNull(), F.xxhash64(F.lit(11), "_a"))).withColumn(
        "_first", F.when(F.coalesce("_pos", F.lit(0)) == 0, 1).otherwise(0))
    lane = lambda c, i: F.shiftrightunsigned(c, i).bitwiseAND(F.lit(_LANES))
    sums = [F.sum(lane(c, i)).alias(f"{c}{i}") for c in ("_a", "_b") for i in range(32)]
    votes = terms.groupBy(*keys).agg(F.sum("_first").alias("rows"), F.count("_pos").alias("_n"), *sums)

    def packed(c: str) -> Column:
        word = F.lit(0).cast("long")
        for i in range(32):
            ones = F.coalesce(F.col(f"{c}{i}"), F.lit(0))
            for bit, count in ((i, ones.bitwiseAND(F.lit(_LOW))), (i + 32, F.shiftrightunsigned(ones, 32))):
                word = word.bitwiseOR(F.shiftleft((count * 2 > F.col("_n")).cast("long"), bit))
        return word

    return votes.select(*keys, "rows", packed("_a").alias("hi"), packed("_b").alias("lo"))


def as_text(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Share of equal bits."""
    apart = F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))
    return (F.lit(BITS) - apart) / F.lit(float(BITS))


def next_ids(docs: DataFrame) -> DataFrame:
    """doc_id -> next_id in descending order of doc_id, the last followed by the first. Ids are
    range-partitioned; only the ends of the partitions (a row each) are ordered as a whole."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    dealt = stored(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "id_order")
    inside = dealt.withColumn("next_id", F.lead("doc_id").over(Window.partitionBy("part").orderBy(F.desc("doc_id"))))
    ends = dealt.groupBy("part").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("top"))
    order = Window.orderBy(F.desc("part"))
    ends = ends.withColumn("across", F.coalesce(F.lead("top").over(order), F.first("top").over(order)))
    return inside.where("next_id IS NOT NULL").unionByName(
        ends.select("doc_id", "part", F.col("across").alias("next_id"))).select("doc_id", "next_id")


def edited_texts(docs: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(parts, order): the parts hold doc_id, text, edited, of documents with an id and of those without;
    ``order`` is doc_id -> next_id. Edited: the last third of the text replaced by as many first
    characters of the next document."""
    order = next_ids(docs)
    third = lambda c: F.floor(F.length(c) / 3).cast("int")
    wants = docs.select("doc_id", third("text").alias("want")).where("want > 0") \
        .groupBy("doc_id").agg(F.max("want").alias("want")).join(order, "doc_id") \
        .select(F.col("doc_id").alias("for_id"), F.col("next_id"), "want")
    # both joins take the same shuffled texts, so these rows are written once
    named = docs.where("doc_id IS NOT NULL")
    heads = named.join(wants, named["doc_id"] == wants["next_id"]) \
        .select("for_id", F.substring("text", F.lit(1), F.col("want")).alias("head"))
    heads = heads.groupBy("for_id").agg(F.max("head").alias("head"))
    out = named.join(heads, named["doc_id"] == heads["for_id"], "left")

    def edited(df: DataFrame, head: Column) -> DataFrame:
        kept = F.substring("text", F.lit(1), F.length("text") - third("text"))
        return df.select("doc_id", "text", F.concat(kept, F.substring(head, F.lit(1), third("text"))).alias("edited"))

    alone = docs.where("doc_id IS NULL")
    return [edited(out, F.coalesce("head", F.lit(""))), edited(alone, F.lit(""))], order


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """Per distinct query fingerprint (hi, lo): ``n_near``, the rows of ``prints`` whose
    fingerprint is within ``radius`` bits, its own included. Exact. Queries are a stated set;
    both sides hold distinct fingerprints (hi, lo) and ``prints`` their ``rows``."""
    blocks = radius + 1
    width = -(-BITS // blocks)

    def block(c: str, i: int) -> Column:
        lo, hi = i * width, min((i + 1) * width, BITS)  # bits counted from the top of hi
        parts = []
        for word, first in ((f"{c}hi", 0), (f"{c}lo", 64)):
            a, b = max(lo, first) - first, min(hi, first + 64) - first
            if a < b:
                cut = F.shiftrightunsigned(F.col(word), 64 - b)
                parts.append(cut if b - a == 64 else cut.bitwiseAND(F.lit((1 << (b - a)) - 1)))
        return F.xxhash64(*parts) if len(parts) > 1 else parts[0]

    def tables(df: DataFrame, c: str) -> DataFrame:
        keyed = F.array(*[F.struct(F.lit(i).alias("t"), block(c, i).alias("k")) for i in range(blocks)])
        return df.withColumn(f"{c}at", F.explode(keyed))

    q = tables(queries.select(F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo")).distinct(), "q_")
    p = tables(prints.select(F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"), "rows"), "p_")
    apart = F.bit_count(F.col("q_hi").bitwiseXOR(F.col("p_hi"))) + F.bit_count(F.col("q_lo").bitwiseXOR(F.col("p_lo")))
    earlier = F.lit(False)
    for i in range(blocks - 1):
        earlier = earlier | ((F.col("q_at.t") > i) & (block("q_", i) == block("p_", i)))
    met = q.join(p, (F.col("q_at") == F.col("p_at")) & (apart <= radius) & ~earlier)
    return met.groupBy(F.col("q_hi").alias("hi"), F.col("q_lo").alias("lo")).agg(F.sum("rows").alias("n_near"))


def fingerprint_report(df: DataFrame, radius: int = 3, every: int = 100) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and
    n_near for the documents whose id is divisible by ``every``: how many other documents have a
    fingerprint within ``radius`` bits."""
    # an id that is long already keeps its name: the text shuffles of both joins then are one plan
    is_long = dict(df.dtypes)["doc_id"] == "bigint"
    doc_id = F.col("doc_id") if is_long else F.col("doc_id").cast("long").alias("doc_id")
    parts, order = edited_texts(df.select(doc_id, text_of().alias("text")))
    keys = ["doc_id", "text_key", "n_chars", "edited_sha256", "edit"]

    def votes(pairs: DataFrame) -> DataFrame:
        versions = F.array(F.struct(F.lit(0).alias("edit"), F.col("text").alias("text")),
                           F.struct(F.lit(1).alias("edit"), F.col("edited").alias("text")))
        rows = pairs.select("doc_id", F.xxhash64("text").alias("text_key"), F.length("text").cast("long").alias("n_chars"),
                            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.explode(versions).alias("v"))
        return fingerprints(rows.select(*keys[:-1], F.col("v.edit").alias("edit"), F.col("v.text").alias("text")), keys)

    # documents with an id are partitioned by it already, so their votes are summed where they are
    both = votes(parts[0]).unionByName(votes(parts[1]))
    pick = lambda edit, c: F.max(F.when(F.col("edit") == edit, F.col(c))).alias(f"{c}{edit}")
    one = stored(both.groupBy(*keys[:-1]).agg(F.max("rows").alias("rows"), *[
        pick(e, c) for e in (0, 1) for c in ("hi", "lo")]), "fingerprints")

    # several texts under one id: the next document is the one of the greatest fingerprint
    heads = one.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.struct("hi0", "lo0")).alias("p"))
    after = order.join(heads.withColumnRenamed("doc_id", "next_id"), "next_id") \
        .select(F.col("doc_id").alias("of_id"), F.col("p.hi0").alias("next_hi"), F.col("p.lo0").alias("next_lo"))
    prints = one.groupBy(F.col("hi0").alias("hi"), F.col("lo0").alias("lo")).agg(F.sum("rows").alias("rows"))
    asked = one.where(F.col("doc_id") % every == 0)
    near = within_radius(prints, asked.select(F.col("hi0").alias("hi"), F.col("lo0").alias("lo")), radius) \
        .select(F.col("hi").alias("near_hi"), F.col("lo").alias("near_lo"), "n_near")
    near = asked.select(F.col("doc_id").alias("q_id"), F.col("text_key").alias("q_key"), "hi0", "lo0").distinct() \
        .join(near, (F.col("hi0") == F.col("near_hi")) & (F.col("lo0") == F.col("near_lo"))) \
        .select("q_id", "q_key", (F.col("n_near") - 1).alias("n_near"))
    out = one.join(after, one["doc_id"] == after["of_id"], "left") \
        .join(near, (one["doc_id"] == near["q_id"]) & (one["text_key"] == near["q_key"]), "left") \
        .withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    zero = F.lit(0).cast("long")
    mine, edit = (F.col("hi0"), F.col("lo0")), (F.col("hi1"), F.col("lo1"))
    following = (F.coalesce("next_hi", zero), F.coalesce("next_lo", zero))
    return out.select("doc_id", "n_chars", "edited_sha256", as_text(*mine).alias("fingerprint"),
                      as_text(*edit).alias("edited_fingerprint"), likeness(mine, edit).alias("near_edited"),
                      likeness(mine, following).alias("near_next"), "n_near")
