"""Target-distribution importance resampling (operator 11).

Texts are read as UTF-8 bytes: one 256-byte table lower-cases A-Z and turns every separator into
a blank, ``bytes.split`` gives the words. Features are the runs of one to three words; a run's
bucket is its crc32 modulo ``BUCKETS``, and the crc of a longer run goes on from the crc of the
run before it. Tasks count buckets in Counters, which Spark sums: never more than ``BUCKETS`` rows
a task. A bucket's gain compares its share in the target with its share in the raw texts; a
document's weight is the sum of its features' gains, its score the weight with seeded Gumbel
noise, and the documents of the highest scores are drawn: a sample without repeats whose chances
follow the weights.

Both passes read the texts anew: reading and splitting cost less than a stored copy of all buckets.

A null or empty text has no words: no features, weight 0, a score of noise alone, and it cannot be
drawn. A null doc_id counts as the empty text in the noise and comes last among equal scores;
repeated ids and rows are rows of their own, ties between them falling to the row read first. A
text of any length is taken whole; a task holds one text's words. An empty table gives no rows, an
empty target gains that favour rare features. Extra columns may have any names; ``resample``
carries them, apart from names that start with ``_imp_``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staygrid.llm.common import stored, text_of

BUCKETS = 10_000
LONGEST = 3
#: Lower-cases A-Z, keeps 0-9, a-z and every byte of a character beyond ASCII, blanks the rest.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))
#: Stands for a null id, after all others.
LAST_ID = (1 << 63) - 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def feature_buckets(words: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS):
    """Bucket of every run of 1 to ``longest`` words, as an array, runs of one word first."""
    from zlib import crc32

    import numpy as np

    follow = [b" " + w for w in words]
    crcs, found = list(map(crc32, words)), []
    for length in range(1, longest + 1):
        found.append(np.array(crcs, dtype=np.uint32))
        # the run starting at word i takes in word i + length; the last run has none to take
        crcs = list(map(crc32, follow[length:], crcs))
    return (np.concatenate(found) % np.uint32(buckets)).astype(np.int64)


def feature_counts(df: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> list[int]:
    """How many features of all texts lie in each bucket: ``buckets`` numbers, whatever the input."""

    def run(batches: Iterator):
        from collections import Counter

        import pyarrow as pa

        total = Counter()
        for b in batches:
            for value in b.column(0):
                total.update(feature_buckets(words_of(value.as_py()), longest, buckets).tolist())
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(total.keys(), pa.int32()),
                                          "n": pa.array(total.values(), pa.int64())})

    found = df.select(text_of(text).alias("text")).mapInArrow(run, "bucket int, n long")
    counts = [0] * buckets
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.bucket] = r.n
    return counts


def gains(raw: list[int], target: list[int]) -> list[int]:
    """Per bucket: thousandths of the log of its smoothed share in the target over that in the raw texts."""
    size, s_all, t_all = len(raw), float(sum(raw) + len(raw)), float(sum(target) + len(raw))
    return [math.floor(1000 * math.log((target[i] + 1.0) * s_all / ((raw[i] + 1.0) * t_all))) for i in range(size)]


def scored(df: DataFrame, gain: list[int], keep: list[str], seed: int = 42, doc_id: str = "doc_id",
           text: str = "text", longest: int = LONGEST) -> DataFrame:
    """``keep`` columns of ``df`` and, stored in the shared folder so that later passes agree:
    ``_imp_words``, ``_imp_features``, ``_imp_weight``, ``_imp_score``, ``_imp_id`` and a unique
    ``_imp_row``. The gains are a list of fixed length, sent with the task."""
    known = df.sparkSession.sparkContext.broadcast(gain)
    made = ["_imp_words", "_imp_features", "_imp_weight", "_imp_score"]
    taken = df.select(*keep, text_of(text).alias("_imp_text"), F.col(doc_id).cast("long").alias("_imp_id"))
    schema = T.StructType([f for f in taken.schema.fields if f.name != "_imp_text"])
    kept = list(schema.names)
    for name in made:
        schema = schema.add(name, "long")

    def run(batches: Iterator):
        from hashlib import sha256

        import numpy as np
        import pyarrow as pa

        table = np.array(known.value, dtype=np.int64)
        for b in batches:
            rows = []
            for key, value in zip(b.column("_imp_id").to_pylist(), b.column("_imp_text")):
                words = words_of(value.as_py())
                found = feature_buckets(words, longest, len(table))
                weight = int(table[found].sum())
                h = int(sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
                noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
                rows.append((len(words), len(found), weight, weight + noise))
            cols = zip(*rows) if rows else [()] * len(made)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(c, pa.int64()) for c in cols],
                                             names=kept + made)

    out = taken.mapInArrow(run, schema)
    return stored(out.withColumn("_imp_id", F.coalesce("_imp_id", F.lit(LAST_ID)))
                  .withColumn("_imp_row", F.monotonically_increasing_id()), "importance")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_imp_rank``, 1 for the highest score, then the least id: rows are dealt by
    ranges of that order and numbered within each range; only the ranges' sizes meet in one place."""
    order = [F.col("_imp_score").desc(), F.col("_imp_id").asc(), F.col("_imp_row").asc()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stored(dealt.withColumn("_imp_part", F.spark_partition_id())
                   .withColumn("_imp_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "importance_order")
    sizes, first, at = dealt.groupBy("_imp_part").count().orderBy("_imp_part").collect(), [], 0
    for r in sizes:
        first.append((r[0], at))
        at += r[1]
    firsts = rows.sparkSession.createDataFrame(first, "_imp_part int, _imp_first long")
    # one row a partition
    return dealt.join(F.broadcast(firsts), "_imp_part").withColumn(
        "_imp_rank", F.col("_imp_first") + F.col("_imp_at") + 1).drop("_imp_part", "_imp_at", "_imp_first")


def to_take(rows: DataFrame, percent: int, least_words: int) -> int:
    """How many documents are drawn: ``percent`` of those with at least ``least_words`` words."""
    return percent * rows.where(F.col("_imp_words") >= least_words).count() // 100


def draw_report(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank among the drawn (null: undrawn)."""
    gain = gains(feature_counts(docs), feature_counts(target))
    rows = scored(docs, gain, ["doc_id"], seed)
    take, fit = to_take(rows, percent, least_words), F.col("_imp_words") >= least_words
    ranked = placed(rows.where(fit)).withColumn("_imp_rank", F.when(F.col("_imp_rank") <= take, F.col("_imp_rank")))
    rest = rows.where(~fit).withColumn("_imp_rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_imp_features").alias("n_features"),
        F.col("_imp_weight").alias("weight"), F.col("_imp_score").alias("score"), F.col("_imp_rank").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """The drawn documents, all columns of ``docs``. Only ids and scores are sorted; texts are
    filtered by the place of the last one drawn."""
    kept = [c for c in docs.columns if not c.startswith("_imp_")]
    rows = scored(docs, gains(feature_counts(docs), feature_counts(target)), kept, seed)
    fit = rows.where(F.col("_imp_words") >= least_words)
    take = to_take(rows, percent, least_words)
    last = placed(fit.select("_imp_score", "_imp_id", "_imp_row")).where(F.col("_imp_rank") == take).first()
    if last is None:
        return rows.where("false").select(*kept)
    place = lambda score, key, row: F.struct((-score).alias("s"), key.alias("k"), row.alias("r"))
    end = place(F.lit(last["_imp_score"]), F.lit(last["_imp_id"]), F.lit(last["_imp_row"]))
    return fit.where(place(F.col("_imp_score"), F.col("_imp_id"), F.col("_imp_row")) <= end).select(*kept)


#: The same rows in DuckDB: crc32 by its byte table, folded over the bytes of each distinct feature.
DRAW_SQL = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
words AS (
  SELECT 0 AS side, row_number() OVER () AS id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 1, row_number() OVER (), NULL,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
runs AS (
  SELECT side, id, unnest(w) AS f FROM words
  UNION ALL
  SELECT side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL
  SELECT side, id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
counted AS (SELECT side, id, f, count(*) AS n FROM runs GROUP BY ALL),
features AS (
  SELECT f, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT f, hex(encode(f)) AS x FROM counted), crc_table),
bucketed AS (SELECT side, id, bucket, sum(n)::BIGINT AS n FROM counted JOIN features USING (f) GROUP BY ALL),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
  FROM bucketed GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS g FROM totals),
weighed AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM bucketed JOIN gain USING (bucket) WHERE side = 0 GROUP BY id),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE)
                                                    / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weighed USING (id) WHERE side = 0),
placed AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) END AS place,
         5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS take FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= take THEN place END AS rank FROM placed
"""
