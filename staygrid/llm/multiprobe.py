"""Nearest neighbours by multiprobe p-stable hashing (operator 5).

Nearness is the largest inner product. Vectors are scaled into the unit ball and given one more
coordinate that puts them on the sphere, so for a query the largest product is the least Euclidean
distance, which Gaussian (2-stable) projections preserve. Each of ``TABLES`` tables hashes a vector to
the cell ``floor(a.x / WIDTH + b)`` of ``HASHES`` projections. A query visits a table's buckets
in order of estimated success: the sum over projections of the squared distance from the query's
projection to the bucket's interval, least first (its own bucket scores 0), until it has seen
the share ``VISIT`` of the rows. The tables' candidates are merged and reranked by their exact inner
products in double precision on the original vectors.

Rows are dealt by a hash of their id into blocks of about ``BLOCK_ROWS``, each indexed whole in one
task, and queries into blocks of ``QUERY_ROWS``: every query block meets every row block, so a bucket
that holds most vectors is spread over all blocks and no task holds more than two blocks. Each
block visits at least ``8 k`` rows a table, so a query always finds min(k, candidates) rows.

Vectors that are null, zero, or hold null or non-finite components, and rows without id, take no
part; vectors of different lengths never meet. Rows with one id count as one vector (the least by
component order). Ties go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staygrid.llm.common import stored

TABLES = 4
HASHES = 16
WIDTH = 1.0
VISIT = 0.17
BLOCK_ROWS = 8192
QUERY_ROWS = 4096
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """vec_id, vec (doubles), dim, norm of the vectors that take part."""
    v = F.col(vec).cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("vec_id IS NOT NULL AND vec IS NOT NULL").where(finite)
    # scaled by the largest component, so that no square overflows
    top = F.array_max(F.transform("vec", F.abs))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / F.col("top")) * (x / F.col("top")))) * F.col("top")
    return rows.withColumn("top", top).where("top > 0").select(
        "vec_id", "vec", F.size("vec").alias("dim"), norm.alias("norm"))


def first_of_each(ids, rows):
    """Positions of one row per id, the least by components, in order of id."""
    import numpy as np

    order = np.lexsort((*rows.T[::-1], ids))
    keep = np.ones(len(ids), bool)
    keep[1:] = ids[order][1:] != ids[order][:-1]
    return order[keep]


class Table:
    """One hash table over the rows of a block."""

    def __init__(self, points, seed: int):
        import numpy as np

        rng = np.random.default_rng(seed)
        self.np = np
        self.a = rng.normal(size=(points.shape[1], HASHES)) / WIDTH
        self.b = rng.uniform(size=HASHES)
        cells = np.floor(points @ self.a + self.b).astype(np.int64)
        self.buckets, where, self.counts = np.unique(cells, axis=0, return_inverse=True, return_counts=True)
        self.where = where.ravel()
        # every (projection, interval) that occurs is a column; a bucket is the sum of its columns
        self.low = self.buckets.min(0)
        spans = self.buckets.max(0) - self.low + 1
        self.first = np.concatenate([[0], np.cumsum(spans)])
        self.hot = np.zeros((self.first[-1], len(self.buckets)), np.float32)
        for j in range(HASHES):
            self.hot[self.first[j] + self.buckets[:, j] - self.low[j], np.arange(len(self.buckets))] = 1.0

    def visited(self, queries, rows: int):
        """Boolean (queries x rows of the block): rows in the buckets that each query visits."""
        np = self.np
        p = queries @ self.a + self.b
        cost = np.empty((len(p), self.first[-1]), np.float32)
        for j in range(HASHES):
            lo = self.low[j] + np.arange(self.first[j + 1] - self.first[j])
            gap = np.maximum(np.maximum(lo[None] - p[:, j, None], p[:, j, None] - lo[None] - 1), 0)
            cost[:, self.first[j]:self.first[j + 1]] = gap * gap
        score = cost @ self.hot
        out = np.zeros((len(p), len(self.where)), bool)
        m = min(rows, score.shape[1])  # a bucket has a row at least
        for i, s in enumerate(score):
            near = np.argpartition(s, m - 1)[:m] if m < len(s) else np.arange(len(s))
            near = near[np.argsort(s[near], kind="stable")]
            enough = int(np.searchsorted(np.cumsum(self.counts[near]), rows)) + 1
            mask = np.zeros(len(s), bool)
            mask[near[:enough]] = True
            out[i] = mask[self.where]
        return out


def search_block(ids, rows, query_ids, queries, largest: float, k: int, seed: int):
    """(query position, row position, score) of each query's k nearest of the visited rows."""
    import numpy as np

    scaled = rows / largest
    lift = np.sqrt(np.maximum(1.0 - (scaled * scaled).sum(1), 0.0))
    tables = [Table(np.column_stack([scaled, lift]), seed + t) for t in range(TABLES)]
    budget = max(math.ceil(VISIT * len(ids)), 8 * k)
    unit = queries / np.sqrt((queries * queries).sum(1))[:, None]
    unit = np.column_stack([unit, np.zeros(len(unit))])
    got = []
    for at in range(0, len(unit), 256):
        seen = tables[0].visited(unit[at:at + 256], budget)
        for t in tables[1:]:
            seen |= t.visited(unit[at:at + 256], budget)
        for i, row in enumerate(seen, at):
            near = np.flatnonzero(row & (ids != query_ids[i]))
            # summed row by row, so equal vectors get equal scores
            score = (rows[near] * queries[i]).sum(1)
            if len(near) > k:
                kept = score >= np.partition(score, len(score) - k)[len(score) - k]
                near, score = near[kept], score[kept]
            order = np.lexsort((ids[near], -score))[:k]
            got.append((np.full(len(order), i), near[order], score[order]))
    return [np.concatenate(x) for x in zip(*got)]


def nearest(vectors: DataFrame, is_query, k: int = 20, vec: str = "embedding", seed: int = 29) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each vector where ``is_query`` (a
    condition on vec_id) holds."""
    rows = stored(usable(vectors, vec), "ann_vectors")
    sizes = {r.dim: r for r in rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.sum(is_query.cast("int")).alias("q"), F.max("norm").alias("top")).collect()}
    if not sizes:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    listed = F.create_map(*[F.lit(x) for d, r in sizes.items() for x in (d, max(1, math.ceil(r.n / BLOCK_ROWS)))])
    asked = F.create_map(*[F.lit(x) for d, r in sizes.items() for x in (d, max(1, math.ceil((r.q or 0) / QUERY_ROWS)))])
    top = {d: r.top for d, r in sizes.items()}
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    n_rows, n_queries = listed[F.col("dim")], asked[F.col("dim")]
    dealt = F.pmod(F.xxhash64("vec_id"), n_rows).cast("int")
    base = rows.select("vec_id", "vec", "dim", dealt.alias("block"), spread(n_queries).alias("ask"))
    queries = rows.where(is_query).select(
        "vec_id", "vec", "dim", spread(n_rows).alias("block"),
        F.pmod(F.xxhash64("vec_id", F.lit(3)), n_queries).cast("int").alias("ask"))

    def run(key, left, right):
        import numpy as np
        import pyarrow as pa

        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        dim, sides = key[0].as_py(), []
        for t in (left, right):
            t = t.combine_chunks()
            ids = t["vec_id"].to_numpy()
            flat = t["vec"].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
            keep = first_of_each(ids, flat)
            sides += [ids[keep], flat[keep]]
        q, r, score = search_block(*sides, top[dim], k, seed)
        return pa.table({"query_id": sides[2][q], "vec_id": sides[0][r], "score": score})

    keys = ["dim", "block", "ask"]
    found = base.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(run, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
