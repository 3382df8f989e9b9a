"""Mixing sources to target weights by pivotal dependent rounding (operator 10).

Sources in code point order (null last) get weights; each source's target is its weight's share
of all sizes, held at ``max_copies`` times the source's own size, the excess being reshared by
weight until no source is above. A source's documents then share one copy rate
``target / source_size``: each gets its whole part, and the fractional parts are rounded
dependently: two documents trade words (one gains what the other loses) until one of them is
integral, at random with the chances that keep both expectations. So a source's words keep their
sum, and one document's size at most is lost or won in the end.

The trades form a reduction tree: documents are dealt by hash into blocks of bounded size, each
block leaves one open document, and open documents are dealt again until a source has one, which
is then drawn by itself. Blocks are (source, number) pairs, so a source that holds most rows is
many blocks. Draws come from a hash of the documents, so reruns agree.

Null text has size 0. Equal rows (same id, source and text hash) are one unit with one number of
copies. Documents of size 0 carry no words; they get the whole part of their rate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import stored, text_of, word_count

BLOCK = 2000
#: Bound on the table of sources, which is brought to the driver and broadcast.
MAX_SOURCES = 200_000


def targets(sizes: list[tuple[str | None, int]], weights=(1, 2, 3), max_copies: float = 3.0) -> dict:
    """Source -> target words. ``sizes``: a row a source (names of sources, not documents)."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    total, target, open_ = float(sum(size.values())), {}, set(size)
    while open_:
        left = total - sum(target.values())
        whole = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / whole for s in open_}
        over = sorted((s for s in open_ if share[s] > max_copies * size[s]), key=lambda s: (s is None, s or ""))
        if not over:
            target.update(share)
            break
        target.update({s: max_copies * size[s] for s in over})
        open_ -= set(over)
    return target


def trade(sizes: list[int], parts: list[float], draws) -> tuple[list[float], int | None]:
    """Round the fractional ``parts`` pairwise; returns them and the position still open."""
    parts, held = list(parts), None
    for i, p in enumerate(parts):
        if p <= 0.0 or p >= 1.0:
            continue
        if held is None:
            held = i
            continue
        a, b = held, i
        while 0.0 < parts[a] < 1.0 and 0.0 < parts[b] < 1.0:
            up = min((1.0 - parts[a]) * sizes[a], parts[b] * sizes[b])      # words to a
            down = min(parts[a] * sizes[a], (1.0 - parts[b]) * sizes[b])    # words to b
            words = up if draws(b) * (up + down) < down else -down
            closed_a = words == (1.0 - parts[a]) * sizes[a] or -words == parts[a] * sizes[a]
            closed_b = words == parts[b] * sizes[b] or -words == (1.0 - parts[b]) * sizes[b]
            parts[a], parts[b] = parts[a] + words / sizes[a], parts[b] - words / sizes[b]
            if closed_a:
                parts[a] = 1.0 if words > 0 else 0.0
            if closed_b:
                parts[b] = 0.0 if words > 0 else 1.0
        held = a if 0.0 < parts[a] < 1.0 else b if 0.0 < parts[b] < 1.0 else None
    return parts, held


def round_blocks(open_: DataFrame, seed: int, last: bool) -> DataFrame:
    """One level: every (source, block) group is traded; ``last`` draws what stays open."""
    schema = open_.schema

    def run(block):
        import random

        import pyarrow as pa

        block = block.sort_by([("key", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
        keys = block.column("key").to_pylist()
        rng = random.Random(f"{seed}:{keys[0]}:{len(keys)}")
        parts, held = trade(block.column("size").to_pylist(), block.column("part").to_pylist(), lambda _: rng.random())
        if held is not None and last:
            parts[held] = 1.0 if rng.random() < parts[held] else 0.0
        return block.set_column(block.schema.get_field_index("part"), "part", pa.array(parts, pa.float64()))

    return open_.groupBy("source_no", "block").applyInArrow(run, schema)


def source_targets(docs: DataFrame, weights=(1, 2, 3), max_copies: float = 3.0) -> DataFrame:
    """source, source_size, source_no, n_open, target: a row a source (the table of sources is
    small by nature: it is what the mixing weights are set for)."""
    spark = docs.sparkSession
    if docs.select("source").distinct().limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: mixing weights are set for named collections")
    rows = docs.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("docs")).collect()
    goal = targets([(r["source"], r["n"]) for r in rows], weights, max_copies)
    made = [(r["source"], r["n"], no, r["docs"], float(goal[r["source"]])) for no, r in enumerate(
        sorted(rows, key=lambda r: (r["source"] is None, r["source"] or "")))]
    return spark.createDataFrame(made, "source string, source_size long, source_no int, n_docs long, target double")


def mix(docs: DataFrame, weights=(1, 2, 3), max_copies: float = 3.0, seed: int = 17,
        block: int = BLOCK) -> DataFrame:
    """Copies of each unit. ``docs``: doc_id, source, key (hash of the text), size, and one row a
    unit. Returns these with source_size, target and copies."""
    shares = source_targets(docs, weights, max_copies)
    joined = docs.join(F.broadcast(shares), docs["source"].eqNullSafe(shares["source"])).drop(shares["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # a rate a rounding error below a whole number is that number
    whole = F.floor(rate + 1e-9)
    units = joined.select(
        "doc_id", "source", "key", "size", "source_size", "source_no", "n_docs", "target", whole.alias("whole"),
        F.when(F.col("size") > 0, F.greatest(rate - whole, F.lit(0.0))).otherwise(0.0).alias("part"),
        F.lit(0).alias("block"))
    largest = shares.agg(F.max("n_docs")).first()[0] or 0
    level, done, blocks = units, None, float(largest)
    while True:
        blocks = blocks / block
        last = blocks <= 1
        number = F.greatest(F.ceil(F.col("n_docs") / F.lit(float(block))).cast("int"), F.lit(1))
        dealt = level.withColumn("block", F.pmod(F.xxhash64("key", "doc_id", F.lit(seed)), number).cast("int"))
        if last:
            dealt = dealt.withColumn("block", F.lit(0))
        out = stored(round_blocks(dealt, seed, last), "mix_level")
        is_open = (F.col("part") > 0) & (F.col("part") < 1)
        closed = out.where(~is_open)
        done = closed if done is None else done.unionByName(closed)
        if last:
            return done.withColumn("copies", (F.col("whole") + F.col("part")).cast("int"))
        # a block leaves one open row, so a source has at most this many now
        level = out.where(is_open).withColumn("n_docs", number.cast("long"))
        seed += 1


def sized(df: DataFrame) -> DataFrame:
    """One row a unit: doc_id, source, key, size, rows (equal rows of the table)."""
    text = text_of()
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                     F.xxhash64(text).alias("key"), word_count(text).alias("words"))
    return rows.groupBy("doc_id", "source", "key", "words").agg(F.count("*").alias("rows")) \
        .select("doc_id", "source", "key", (F.col("words") * F.col("rows")).alias("size"), "words", "rows")


def mix_documents(df: DataFrame, weights=(1, 2, 3), max_copies: float = 3.0, seed: int = 17) -> DataFrame:
    """Per document row: doc_id, source, key, words, rows, source_size, target, copies."""
    units = stored(sized(df), "mix_units")
    made = mix(units.select("doc_id", "source", "key", "size"), weights, max_copies, seed)
    on = [units[c].eqNullSafe(made[c]) for c in ("doc_id", "source", "key")]
    return units.join(made, on).select(units["doc_id"], units["source"], units["key"], "words", "rows",
                                       "source_size", "target", "copies")


def mix_report(df: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: a row a document row."""
    m = mix_documents(df)
    rows = m.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return rows.select("doc_id", F.col("words").alias("size"), "source_size", "target",
                       (F.col("copies") * F.col("words")).cast("long").alias("taken"), "copies")


def repeat_documents(df: DataFrame) -> DataFrame:
    """Each row as many times as the mix takes it; columns unchanged."""
    m = mix_documents(df).select(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"),
                                 F.col("key").alias("_mix_key"), F.col("copies").alias("_mix_copies"))
    keyed = df.withColumn("_mix_text", F.xxhash64(text_of()))
    joined = keyed.join(m.where("_mix_copies > 0"), [
        F.col("doc_id").cast("long").eqNullSafe(F.col("_mix_id")),
        F.col("source").cast("string").eqNullSafe(F.col("_mix_source")), F.col("_mix_text") == F.col("_mix_key")])
    return joined.withColumn("_mix_n", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*df.columns)
