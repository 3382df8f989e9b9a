"""Hidden Markov language model (operator 9).

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end token a text. A token is
made in two steps: the hidden state emits a word class (the ``OWN`` most frequent words each have
their own class, other words fall in ``SHARED`` classes by crc32, the end token has one), and the
class emits the word by its smoothed corpus count, ``(c + 1) / (N_class + V_class + 1)``, which
leaves one share for words never seen. The states are learnt by Baum-Welch: every task runs the
scaled forward-backward recursion over its whole training texts and emits its expected counts, which
Spark sums; their size does not grow with the corpus. A text counts one start. A text's score is
log10 of its exact probability: the scaled forward recursion over the whole text.

Word counts cover all training texts. Counts of the most frequent words, about ``FREQUENT``, go to every
task; other words of a text are joined with the table of counts. Texts are those whose
crc32(doc_id) mod 7 is not 2; a null id counts as the empty text. Null text is empty: one end token.
Repeated rows are scored each and count each. Without training texts all counts are 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import SPACE_CHARS, SPACE_CLASS, crc_bucket, stored, text_of

STATES = 6
OWN = 512
SHARED = 511
FREQUENT = 50_000
#: Places (texts x time) whose forward states are held at once.
CELLS = 1_500_000
ROUNDS = 4
#: First probability of staying in a state.
STAY = 0.95
#: Class of the end token, after the words' own and shared classes.
END = OWN + SHARED
CLASSES = END + 1
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROWS = ("uid long, doc_id long, train boolean, n_tokens long, n_frequent long, log_frequent double, "
        "log_class double, classes binary, rare array<string>")


def words_of(text: Column) -> Column:
    bare = F.trim(F.translate(text, UPPER, UPPER.lower()), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS + "+"))


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c over the training texts; stored."""
    words = docs.where("train").select(F.explode(words_of(F.col("text"))).alias("word"))
    return stored(words.groupBy("word").agg(F.count("*").alias("c")), "word_counts")


def most_frequent(counts: DataFrame, most: int = FREQUENT) -> list[tuple[str, int]]:
    """About ``most`` words of the greatest counts, greatest first. The least count is chosen on a
    histogram over logarithmic steps, so partitions send only words that are taken. Of a step that does not fit
    as a whole, words are taken by their hash as far as there is room: where many words have
    equal counts, none of them is more frequent than the others."""
    step = F.floor(F.log2(F.col("c")) * 64)
    taken, wanted = 0, F.lit(False)
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        room = most - taken
        share = min(1.0, room / r["count"])
        drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
        wanted = (step > r["step"]) | ((step == r["step"]) & drawn)
        taken += r["count"]
        if taken >= most:
            break
    rows = counts.where(wanted).collect()
    return sorted(((r["word"], r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


def class_of(word: Column, rank: Column) -> Column:
    """Own class by rank among the most frequent words, else a shared one."""
    return F.coalesce(rank, F.lit(OWN) + F.crc32(word.cast("binary")) % SHARED).cast("int")


def sequences(docs: DataFrame, frequent: list[tuple[str, int]], class_log: list[float]) -> DataFrame:
    """ROWS: the classes of each text, its sums over frequent words and its other words; stored."""
    sent = docs.sparkSession.sparkContext.broadcast((frequent, class_log))

    def run(batches: Iterator):
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        listed, logs = sent.value
        place = {w.encode(): i for i, (w, _) in enumerate(listed)}
        count_log = np.append(np.log10(np.array([c for _, c in listed], float) + 1.0), 0.0)
        classes = np.array([i if i < OWN else OWN + zlib.crc32(w.encode()) % SHARED
                            for i, (w, _) in enumerate(listed)] + [0], dtype="<u2")
        class_log = np.array(logs)
        unseen, other = len(listed), zlib.crc32
        uid = TaskContext.get().partitionId() << 40
        for b in batches:
            out = []
            for doc_id, train, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "train", "text"))):
                words = text.encode("utf-8", "surrogatepass").lower().split()
                at = np.fromiter((place.get(w, unseen) for w in words), dtype=np.int64, count=len(words))
                made = np.empty(len(words) + 1, dtype="<u2")
                made[:-1], made[-1] = classes[at], END
                holes = np.flatnonzero(at == unseen).tolist()
                rare = [words[i] for i in holes]
                if holes:
                    made[holes] = [OWN + other(w) % SHARED for w in rare]
                out.append((uid, doc_id, train, len(made), len(words) - len(holes), float(count_log[at].sum()),
                            float(class_log[made].sum()), made.tobytes(),
                            [w.decode("utf-8", "surrogatepass") for w in rare]))
                uid += 1
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                     pa.binary(), pa.list_(pa.string()))
            cols = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=[f.split()[0] for f in ROWS.split(", ")])

    return stored(docs.select("doc_id", "train", "text").mapInArrow(run, ROWS), "class_sequences")


# ---------------------------------------------------------------- the model

def first_model(class_counts: list[float], states: int = STATES, seed: int = 11) -> tuple:
    """Emissions are the classes' shares under a seeded disturbance; states begin by staying where
    they are (texts keep to a language and a register), so that they come to tell texts apart."""
    import numpy as np

    rng = np.random.default_rng(seed)
    share = (np.array(class_counts, float) + 0.1) / (sum(class_counts) + 0.1 * len(class_counts))
    emit = share[None] * np.exp(0.7 * rng.normal(size=(states, len(share))))
    move = np.full((states, states), (1.0 - STAY) / max(1, states - 1))
    np.fill_diagonal(move, STAY if states > 1 else 1.0)
    return np.full(states, 1.0 / states), move, emit / emit.sum(1, keepdims=True)


def expected(texts, lengths, start, move, emit, cells: int = CELLS):
    """Baum-Welch counts of padded texts (rows x time): start, moves, emissions. Forward states are
    held for a chunk of ``cells`` places: the first pass keeps those at the chunks' borders, the
    backward pass goes through the chunks from the last, with the states of each computed again."""
    import numpy as np

    rows, width = texts.shape
    states = len(start)
    at_time = np.ascontiguousarray(texts.T)
    by_class = np.ascontiguousarray(emit.T, dtype=np.float32)
    start, move = start.astype(np.float32), move.astype(np.float32)
    chunk = max(1, cells // rows)
    firsts = list(range(0, width, chunk))

    def forward_states(begin, now):
        size = min(chunk, width - begin)
        ahead = np.empty((size, rows, states), np.float32)
        scale = np.empty((size, rows), np.float32)
        for k in range(size):
            now = (start[None] if now is None else now @ move) * by_class[at_time[begin + k]]
            total = now.sum(1)
            now = now / total[:, None]
            ahead[k], scale[k] = now, total
        return ahead, scale

    borders = [None]
    for begin in firsts:
        ahead, scale = forward_states(begin, borders[-1])
        borders.append(ahead[-1].copy())
    moves = np.zeros((states, states))
    emits = np.zeros((states, emit.shape[1]))
    back = np.ones((rows, states), np.float32)
    first = later = None
    for at in range(len(firsts) - 1, -1, -1):
        if at < len(firsts) - 1:
            ahead, scale = forward_states(firsts[at], borders[at])
        for k in range(len(ahead) - 1, -1, -1):
            t = firsts[at] + k
            if later is not None:
                inside = (t + 1) < lengths
                step = by_class[at_time[t + 1]] * back / later[:, None]
                step[~inside] = 0.0
                moves += (ahead[k].T @ step) * move
                back = np.where(inside[:, None], step @ move.T, np.float32(1.0))
            gamma = ahead[k] * back
            total = np.maximum(gamma.sum(1, keepdims=True), 1e-30)
            gamma /= total
            # rounding errors do not add up over a long text
            back = back / total
            gamma[t >= lengths] = 0.0
            # the forward states of this time are done with
            first, later, ahead[k] = gamma, scale[k], gamma
        here = at_time[firsts[at]:firsts[at] + len(ahead)].ravel()
        for s in range(states):
            emits[s] += np.bincount(here, weights=ahead[:, :, s].ravel(), minlength=emit.shape[1])
    return first.sum(0).astype(float), moves, emits


def groups_of(lengths):
    """Positions of texts of like lengths, longest first, in groups of at most CELLS places or one text."""
    import numpy as np

    order = np.argsort(-lengths, kind="stable")
    ordered, k = lengths[order], 0
    while k < len(order):
        like = np.searchsorted(-ordered, -0.7 * ordered[k], side="right")
        end = max(k + 1, min(int(like), k + int(CELLS // ordered[k])))
        yield order[k:end]
        k = end


def train(rows: DataFrame, model: tuple, rounds: int = ROUNDS) -> tuple:
    """Baum-Welch over all training sequences; each round sums the tasks' expected counts."""
    import numpy as np

    spark = rows.sparkSession
    states, classes = model[2].shape
    sizes = (states, states * states, states * classes)

    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def run(batches: Iterator, sent=sent):
            import numpy as np
            import pyarrow as pa

            start, move, emit = sent.value
            total = np.zeros(sum(sizes))
            for b in batches:
                seqs = [np.frombuffer(x, dtype="<u2") for x in b.column("classes").to_pylist()]
                if not seqs:
                    continue
                lengths = np.array([len(s) for s in seqs])
                for group in groups_of(lengths):
                    flat = np.full((len(group), int(lengths[group[0]])), END, dtype=np.int64)
                    for i, at in enumerate(group):
                        flat[i, :lengths[at]] = seqs[at]
                    total += np.concatenate([x.ravel() for x in expected(flat, lengths[group], start, move, emit)])
            yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(total)), pa.int32()), "n": total})

        sums = np.zeros(sum(sizes))
        made = rows.where("train").select("classes").mapInArrow(run, "at int, n double")
        for r in made.groupBy("at").agg(F.sum("n").alias("n")).collect():
            sums[r["at"]] = r["n"]
        start, move, emit = np.split(sums, np.cumsum(sizes)[:-1])
        start = start + 0.1
        move = move.reshape(states, states) + 0.1
        emit = emit.reshape(states, classes) + 0.01
        model = (start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))
    return model


def forward(seqs: list, model: tuple):
    """log10 probability of each class sequence by the scaled forward recursion; all sequences
    step together, those that have ended drop out."""
    import numpy as np

    start, move, emit = model
    by_class = np.ascontiguousarray(emit.T)
    lengths = np.array([len(s) for s in seqs])
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate([seqs[i] for i in order]).astype(np.int64)
    lengths = lengths[order]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    logs = np.zeros(len(seqs))
    now = np.repeat(start[None], len(seqs), 0)
    for t in range(int(lengths[0])):
        n = alive[t]
        now = (now[:n] if t == 0 else now[:n] @ move) * by_class[flat[first[:n] + t]]
        total = now.sum(1)
        now /= total[:, None]
        logs[:n] += np.log10(total)
    out = np.empty(len(seqs))
    out[order] = logs
    return out


def forward_scores(rows: DataFrame, model: tuple) -> DataFrame:
    """uid, log_states: the log10 probability of the class sequence."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kept = ["uid", "doc_id", "train", "n_tokens", "n_frequent", "log_frequent", "log_class"]
    schema = rows.select(*kept).schema.add("log_states", "double")

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            seqs = [np.frombuffer(x, dtype="<u2") for x in b.column("classes").to_pylist()]
            logs = forward(seqs, sent.value) if seqs else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(logs)], names=[*kept, "log_states"])

    return rows.select(*kept, "classes").mapInArrow(run, schema)


def score_documents(df: DataFrame, mod: int = 7, out: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")) \
        .withColumn("train", crc_bucket(F.col("doc_id"), mod) != out)
    counts = word_counts(docs)
    n_end = docs.where("train").count()
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, distinct = totals[0] + n_end, totals[1] + (n_end > 0)
    frequent = most_frequent(counts)
    spark = df.sparkSession
    ranked = spark.createDataFrame([(w, i) for i, (w, _) in enumerate(frequent)], "word string, rank int")

    placed = counts.join(F.broadcast(ranked), "word", "left")
    own = F.when(F.col("rank") < OWN, F.col("rank"))
    per_class = {r["class"]: r for r in placed.groupBy(class_of(F.col("word"), own).alias("class")).agg(
        F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    class_counts = [float(per_class[i]["n"]) if i in per_class else 0.0 for i in range(END)] + [float(n_end)]
    class_log = [math.log10(per_class[i]["n"] + per_class[i]["v"] + 1) if i in per_class else 0.0
                 for i in range(END)] + [0.0]
    rows = sequences(docs, frequent, class_log)
    model = train(rows, first_model(class_counts))

    # words outside the frequent ones: those never seen add log10(1) = 0 and are not known
    rest = placed.where("rank IS NULL").select("word", "c")
    found = rows.select("uid", F.explode("rare").alias("word")).join(rest, "word")
    rare = found.groupBy("uid").agg(F.sum(F.log10(F.col("c") + 1)).alias("log_rare"), F.count("*").alias("n_rare"))
    scored = forward_scores(rows, model).join(rare, "uid", "left")
    words_log = F.col("log_frequent") + F.coalesce("log_rare", F.lit(0.0))
    base = words_log + F.lit(math.log10(n_end + 1)) - F.col("n_tokens") * F.lit(math.log10(tokens + distinct + 1))
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0)) + F.lit(int(n_end > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("log_states") + words_log - F.col("log_class")).alias("score"))
