"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks (operator 2).

Kernel: the gap-weighted subsequence kernel of order 3 between two tokens (every common ordered
triple of letters counts, discounted by ``DECAY`` for each letter it spans in either token),
normalised. Inserted or dropped letters only lower the weight of some triples. Tokens are lower-cased
and stripped of everything but letters and digits, so marks between letters vanish, and a run of
three or more single letters is read as one token as well. Tokens over ``WIDTH`` letters are scored
in overlapping windows, so whole texts count.

Training is multiple-instance: a toxic document is a bag of sentences of which one holds the insult, a
clean document's sentences are all clean. A sentence scores as its most toxic token does. Landmarks
are picked among the tokens that tell labelled toxic documents from clean ones; each token's kernel
values at the landmarks are whitened (Nystroem), a linear SVM is fitted on the witness tokens of the
toxic bags against the tokens of the clean ones, witnesses are picked again, and so on. A logistic
curve turns the largest margin of a document into its score.

Bounded sample: at most ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` clean labelled documents (those of
smallest hash of the id) are learnt from. Every document is scored over its whole text. Null or
empty texts score as texts without any suspicious token. Without labels of both kinds all scores
are 0. Repeated ids keep their rows; of repeated labels the largest counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import Memo, crc_bucket, stored, text_of

MAX_TOXIC = 4000
MAX_CLEAN = 8000
WIDTH = 24
DECAY = 0.6
LANDMARKS = 96
ROUNDS = 4


# ---------------------------------------------------------------- tokens

class Tokens:
    """Distinct scored units of a text."""

    def __init__(self):
        import re

        strip = re.compile(r"[\W_]+")
        self.memo = Memo(lambda t: self.cut(strip.sub("", t)), 150_000)

    @staticmethod
    def cut(token: str) -> tuple[str, ...]:
        if len(token) <= WIDTH:
            return (token,) if len(token) > 2 else ()
        step = WIDTH // 2
        return tuple(token[i:i + WIDTH] for i in range(0, len(token) - step, step))

    def of(self, text: str) -> set[str]:
        raw = text.lower().split()
        units = set()
        for t in set(raw):
            units.update(self.memo[t])
        singles = "".join([t if len(t) == 1 else " " for t in raw])
        for run in singles.split():
            if len(run) > 2:
                units.update(self.memo[run])
        return units


# ---------------------------------------------------------------- kernel

def coded(tokens: list[str], width: int):
    """Code points as an array (tokens x width), 0 past the end."""
    import numpy as np

    flat = np.zeros((len(tokens), width), dtype=np.uint32)
    for i, t in enumerate(tokens):
        flat[i, :len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return flat


def subsequences(a, b):
    """Gap-weighted kernel of order 3 by dynamic programming, for every pair of rows of ``a`` and
    ``b`` that the shapes broadcast to: (x, len) against (y, len) gives (x, y)."""
    import numpy as np

    d, dd = np.float32(DECAY), np.float32(DECAY * DECAY)
    shape = (a.shape[0], b.shape[0])
    n = b.shape[1]
    total = np.zeros(shape, np.float32)
    # one[j], two[j]: weight of common subsequences of order 1, 2 within the first i letters of a
    # and j letters of b, discounted up to there
    one, two = np.zeros((n + 1, *shape), np.float32), np.zeros((n + 1, *shape), np.float32)
    for i in range(a.shape[1]):
        run1, run2 = np.zeros(shape, np.float32), np.zeros(shape, np.float32)
        new1, new2 = one * d, two * d
        letter = a[:, i, None]
        live = letter > 0
        for j in range(n):
            same = np.where((letter == b[None, :, j]) & live, dd, np.float32(0))
            total += same * two[j]
            run2 = run2 * d + same * one[j]
            run1 = run1 * d + same
            new1[j + 1] += run1
            new2[j + 1] += run2
        one, two = new1, new2
    return total


def self_kernel(rows):
    """Kernel of each row with itself."""
    import numpy as np

    d, dd = np.float32(DECAY), np.float32(DECAY * DECAY)
    x, n = rows.shape
    total = np.zeros(x, np.float32)
    one, two = np.zeros((n + 1, x), np.float32), np.zeros((n + 1, x), np.float32)
    for i in range(n):
        run1, run2 = np.zeros(x, np.float32), np.zeros(x, np.float32)
        new1, new2 = one * d, two * d
        for j in range(n):
            same = np.where((rows[:, i] == rows[:, j]) & (rows[:, i] > 0), dd, np.float32(0))
            total += same * two[j]
            run2 = run2 * d + same * one[j]
            run1 = run1 * d + same
            new1[j + 1] += run1
            new2[j + 1] += run2
        one, two = new1, new2
    return total


def kernel(tokens: list[str], landmarks: list[str]):
    """Normalised kernel values, tokens x landmarks. Tokens are taken by length, in blocks."""
    import numpy as np

    out = np.zeros((len(tokens), len(landmarks)), np.float32)
    if not tokens or not landmarks:
        return out
    by_len: dict[int, list[int]] = {}
    for i, t in enumerate(landmarks):
        by_len.setdefault(len(t), []).append(i)
    marks = [(np.array(at), coded([landmarks[i] for i in at], n)) for n, at in by_len.items()]
    norms = [np.sqrt(self_kernel(m)) for _, m in marks]
    order: dict[int, list[int]] = {}
    for i, t in enumerate(tokens):
        order.setdefault(len(t), []).append(i)
    for n, at in order.items():
        for k in range(0, len(at), 1024):
            part = np.array(at[k:k + 1024])
            rows = coded([tokens[i] for i in part], n)
            own = np.sqrt(self_kernel(rows))
            for (cols, m), norm in zip(marks, norms):
                out[np.ix_(part, cols)] = subsequences(rows, m) / np.maximum(own[:, None] * norm[None, :], 1e-12)
    return out


class Expansion:
    """The trained machine as weights on letter triples: a margin is linear in the kernel values at
    the landmarks, and those are sums over common triples, so all landmarks fold into one table."""

    def __init__(self, model: dict):
        from itertools import combinations

        import numpy as np

        marks, alpha, self.bias = model["landmarks"], model["alpha"], model["bias"]
        self.letters = np.array(sorted({ord(c) for z in marks for c in z}), dtype=np.uint32)
        self.n = len(self.letters) + 1
        place = {int(c): i + 1 for i, c in enumerate(self.letters)}
        weights: dict[int, float] = {}
        for z, a in zip(marks, alpha):
            own = math.sqrt(max(float(self_kernel(coded([z], len(z)))[0]), 1e-12))
            c = [place[ord(x)] for x in z]
            for i, j, k in combinations(range(len(z)), 3):
                t = (c[i] * self.n + c[j]) * self.n + c[k]
                weights[t] = weights.get(t, 0.0) + float(a) / own * DECAY ** (k - i + 1)
        self.triples = np.array(sorted(weights) or [0], dtype=np.int64)
        self.weights = np.array([weights.get(int(t), 0.0) for t in self.triples], np.float32)
        self.table = None
        if self.n <= 160:  # a few MB; larger alphabets are looked up by bisection
            self.table = np.zeros(self.n ** 3, np.float32)
            self.table[self.triples] = self.weights

    def of(self, triples):
        import numpy as np

        if self.table is not None:
            return self.table[triples]
        at = np.minimum(np.searchsorted(self.triples, triples), len(self.triples) - 1)
        return np.where(self.triples[at] == triples, self.weights[at], np.float32(0))

    def margins(self, tokens: list[str]):
        """Margin of each token; tokens are taken by length, in blocks."""
        import numpy as np

        out = np.full(len(tokens), self.bias, np.float32)
        order: dict[int, list[int]] = {}
        for i, t in enumerate(tokens):
            order.setdefault(len(t), []).append(i)
        for n, at in order.items():
            for b in range(0, len(at), 4096):
                part = at[b:b + 4096]
                rows = coded([tokens[i] for i in part], n)
                code = np.minimum(np.searchsorted(self.letters, rows), max(len(self.letters) - 1, 0))
                code = np.where(self.letters[code] == rows, code + 1, 0).astype(np.int64) if len(self.letters) else rows * 0
                total = np.zeros(len(part), np.float32)
                for i in range(n - 2):
                    for k in range(i + 2, n):
                        ends = code[:, i] * self.n * self.n + code[:, k]
                        total += self.of(ends[:, None] + code[:, i + 1:k] * self.n).sum(1) * np.float32(DECAY ** (k - i + 1))
                out[part] += total / np.sqrt(np.maximum(self_kernel(rows), 1e-12))
        return out


# ---------------------------------------------------------------- training (bounded sample)

def linear_svm(x, y, weight, epochs: int = 60, cost: float = 4.0):
    """Dual coordinate descent of the L2-regularised squared-hinge SVM; the last column of ``x``
    is the constant. Returns the weights."""
    import numpy as np

    rng = np.random.default_rng(5)
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(y))
    ridge = 1.0 / (2.0 * cost * weight)
    diag = (x * x).sum(1) + ridge
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            grad = y[i] * (x[i] @ w) - 1.0 + ridge[i] * alpha[i]
            new = max(0.0, alpha[i] - grad / diag[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def pick_landmarks(ranked: list[str], count: int) -> list[str]:
    """Pivoted Cholesky over the candidates, best told apart first: a candidate that the landmarks
    before it already span is passed over."""
    import numpy as np

    ranked = ranked[:6 * count]
    if not ranked:
        return []
    gram = kernel(ranked, ranked).astype(float)
    left, basis, picked = np.ones(len(ranked)), np.zeros((len(ranked), count)), []
    prior = 1.0 / (1.0 + np.arange(len(ranked)) / count)
    for m in range(min(count, len(ranked))):
        i = int(np.argmax(left * prior))
        if left[i] < 0.05:
            break
        row = (gram[:, i] - basis[:, :m] @ basis[i, :m]) / math.sqrt(left[i])
        basis[:, m] = row
        left = np.maximum(left - row * row, 0.0)
        left[i] = 0.0
        picked.append(ranked[i])
    return picked


def fit(bags: list[set[str]], strength: dict[str, float], clean: dict[str, int]) -> dict | None:
    """``bags``: suspicious tokens of each toxic document, ``strength``: how well such a token tells
    the classes apart, ``clean``: tokens of clean documents and their counts."""
    import numpy as np

    bags = [b for b in bags if b]
    if not bags or not clean:
        return None
    ranked = sorted(strength, key=lambda t: (-strength[t], t))
    common = sorted(clean, key=lambda t: (-clean[t], t))
    marks = pick_landmarks(ranked, LANDMARKS * 2 // 3)
    marks += [t for t in pick_landmarks(common, LANDMARKS // 3) if t not in marks]
    value, vector = np.linalg.eigh(kernel(marks, marks).astype(float))
    kept = value > 1e-4 * value.max()
    white = vector[:, kept] / np.sqrt(value[kept])
    tokens = sorted(set().union(*bags))
    place = {t: i for i, t in enumerate(tokens)}
    lift = lambda ts: np.hstack([kernel(ts, marks) @ white, np.ones((len(ts), 1))])
    pos, neg = lift(tokens), lift(common)
    margin = np.array([strength[t] for t in tokens])
    least = 1 + (len(bags) >= 100)
    for _ in range(ROUNDS):
        witness: dict[int, int] = {}
        for b in bags:
            i = max((place[t] for t in sorted(b)), key=lambda i: margin[i])
            witness[i] = witness.get(i, 0) + 1
        # with many bags, a witness of a single one is chance
        at = sorted(i for i in witness if witness[i] >= least)
        x = np.vstack([pos[at], neg])
        y = np.concatenate([np.ones(len(at)), -np.ones(len(common))])
        seen = np.array([min(witness[i], 10) for i in at], float)
        weight = np.concatenate([seen / seen.mean(), np.full(len(common), 1.0)])
        w = linear_svm(x, y, weight)
        margin = pos @ w
    return {"landmarks": marks, "alpha": (white @ w[:-1]).astype(np.float32), "bias": float(w[-1])}


def logistic(margins, labels) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton steps with a small prior."""
    import numpy as np

    x = np.column_stack([margins, np.ones(len(margins))])
    y, beta = np.asarray(labels, float), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (p - y) + 1e-2 * (beta - np.array([1.0, 0.0]))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta -= step
        if abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


class Scorer:
    """Largest token margin of a text; a bounded memo keeps the margins of tokens met before."""

    def __init__(self, model: dict):
        self.machine, self.tokens, self.memo = Expansion(model), Tokens(), {}

    def margins(self, texts: list[str]) -> list[float]:
        units = [self.tokens.of(t) for t in texts]
        new = sorted(set().union(*units).difference(self.memo)) if units else []
        if len(self.memo) + len(new) > 250_000:
            self.memo.clear()
            new = sorted(set().union(*units))
        for i in range(0, len(new), 16384):
            part = new[i:i + 16384]
            self.memo.update(zip(part, self.machine.margins(part).tolist()))
        # a token alike no landmark has the bias alone
        return [max(map(self.memo.__getitem__, u), default=self.machine.bias) for u in units]


MARGIN = "_toxic_margin"


def document_margins(docs: DataFrame, model: dict, columns: list[str]) -> DataFrame:
    """``columns`` and the margin of every document; the model is a few hundred kB at most."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*columns).schema.add(MARGIN, "double")

    def run(batches: Iterator):
        import pyarrow as pa

        scorer = Scorer(sent.value)
        for whole in batches:
            for b in (whole.slice(at, 250) for at in range(0, whole.num_rows, 250)):
                made = scorer.margins([t or "" for t in b.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column(c) for c in columns] + [pa.array(made, pa.float64())],
                                                 names=[*columns, MARGIN])

    return docs.mapInArrow(run, schema)


def _tokens_of(docs: DataFrame) -> DataFrame:
    """doc_id, toxic, token: a row for each distinct token of a sampled document."""

    def run(batches: Iterator):
        import pyarrow as pa

        tokens = Tokens()
        for b in batches:
            for i, t, x in zip(*(b.column(c).to_pylist() for c in ("doc_id", "toxic", "text"))):
                u = sorted(tokens.of(x))
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(u), pa.int64()), pa.array([t] * len(u), pa.int32()),
                                                  pa.array(u, pa.string())], names=["doc_id", "toxic", "token"])

    return docs.select("doc_id", "toxic", "text").mapInArrow(run, "doc_id long, toxic int, token string")


def train(documents: DataFrame, labels: DataFrame) -> dict | None:
    """Model from a bounded sample of the labelled documents outside the held-out fifth."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")) \
        .where(crc_bucket(F.col("doc_id"), 5) != 0)
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    place, sample = F.xxhash64("doc_id"), known.where("false")
    for toxic, most in ((1, MAX_TOXIC), (0, MAX_CLEAN)):
        # a share of the hashes holds somewhat more than the rows to take, so that only these are sorted
        share = min(1.0, (1.2 * most + 200) / max(sizes.get(toxic, 0), 1))
        near = known.where((F.col("toxic") == toxic) & (place <= F.lit(min(2 ** 63 - 1, int(-2 ** 63 + share * 2.0 ** 64)))))
        sample = sample.unionByName(near.orderBy(place, "doc_id").limit(most))
    rows = sample.collect()  # at most MAX_TOXIC + MAX_CLEAN pairs of numbers
    if not rows:
        return None
    sample = documents.sparkSession.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, toxic int")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")) \
        .join(F.broadcast(sample), "doc_id")
    held = stored(_tokens_of(docs), "toxic_tokens")
    stats = held.groupBy("token").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    n_toxic = max(1, sum(r[1] for r in rows))
    n_clean = max(1, len(rows) - n_toxic)
    # rate among toxic documents against that among clean ones, chance pushed down
    strength = F.log((F.col("t") + 0.01) / n_toxic) - F.log((F.col("c") + 1.0) / n_clean)
    least = 3 if n_toxic >= 100 else 2
    told = stats.where((F.col("t") >= least) & (F.col("c") * 20 <= F.col("t") * n_clean / n_toxic)) \
        .select("token", (strength * F.sqrt("t")).alias("s"))
    told = told.orderBy(F.desc("s"), "token").limit(4000)
    strengths = {r.token: r.s for r in told.collect()}
    bags: dict[int, set] = {}
    pairs = held.where("toxic = 1").join(F.broadcast(told.select("token")), "token").select("doc_id", "token")
    for r in pairs.collect():  # sampled documents x suspicious tokens
        bags.setdefault(r.doc_id, set()).add(r.token)
    # tokens about as frequent in clean documents, the common ones among them
    clean = stats.where((F.col("c") > 0) & (F.col("t") / n_toxic <= 1.5 * F.col("c") / n_clean)).select("token", "c")
    frequent = clean.orderBy(F.desc("c"), "token").limit(3000)
    some = clean.orderBy(F.xxhash64("token"), "token").limit(5000)
    negatives = {r.token: r.c for r in frequent.unionByName(some).collect()}
    model = fit([bags[i] for i in sorted(bags)], strengths, negatives)
    if model is None:
        return None
    seen = document_margins(docs, model, ["doc_id", "toxic"]).select(F.col(MARGIN).alias("margin"), "toxic").collect()
    model["curve"] = logistic([r.margin for r in seen], [r.toxic for r in seen])
    return model


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, score: the whole table, by a model of its labels."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    model = train(documents, labels)
    if model is None:
        return docs.withColumn("score", F.lit(0.0))
    slope, offset = model["curve"]
    out = document_margins(docs, model, ["doc_id"])
    return out.withColumn("score", 1.0 / (1.0 + F.exp(-(F.col(MARGIN) * slope + offset))))


def score_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    out = scored(documents, labels)
    return out.select("doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``documents`` whose own text scores under 0.5; columns unchanged."""
    model = train(documents, labels)
    if model is None:
        return documents
    slope, offset = model["curve"]
    out = document_margins(documents, model, documents.columns)
    return out.where(F.col(MARGIN) * slope + offset < 0).select(*documents.columns)
