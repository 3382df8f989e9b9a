"""Benchmark decontamination by a distributed positional inverted index (operator 13).

The training texts are cut into segments of about ``SEGMENT_CHARS`` characters. A segment's index is
a set of posting rows (segment, token, n, positions), written for every token of every text; its
documents stand one after the other on one line of positions, ``GAP`` apart, so that no phrase
crosses two of them. The row of the empty token lists the segment's documents. A frequent word has
one row a segment and none grows beyond it.

The test items are cut into windows of ``WINDOW`` words. Spark sums the frequency of every test term
over the postings and orders each window's terms by it. The postings of test terms meet per segment,
where each window starts from the positions of its rarest term: those that have the next terms in
reach are kept, term by term. What is left is an exact phrase where every list, moved by the term's
offset, holds the start, and a proximity match where all the window's words stand within ``slop``
words more than its own length. Windows go out in blocks of about ``BLOCK``, or
``BLOCK_BYTES`` of words; a block's words are broadcast, so postings are filtered where they lie and
only those of test terms move. One block meets all segments, then the next.

Null and empty texts have no words; they keep their row in the report, and an item without words has
no window. Repeated documents are rows of their own. Items of one id are one item; a null item_id is
an item named by the empty string, a null doc_id stays null. Windows that several items hold are
searched once. A text of any length is taken whole; one longer than a segment is a segment of its
own. Empty tables give no rows, or no matches. Extra columns may have any names: only ids and texts
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import stored, text_of
from staygrid.llm.importance import words_of

WINDOW = 10
SLOP = 5
#: Free positions between two documents of a segment; more than any proximity match spans.
GAP = 64
SEGMENT_CHARS = 8_000_000
SEGMENT_DOCS = 100_000
BLOCK, BLOCK_BYTES = 50_000, 16_000_000
POSTINGS = "segment long, token string, n int, positions array<int>, doc_ids array<bigint>, lengths array<int>"
HITS = ("segment long, ordinal int, starts array<int>, ends array<int>, windows array<bigint>, places array<int>, "
        "near_windows array<bigint>, near_places array<int>")


# ---------------------------------------------------------------- the index

def positional_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored postings of all tokens of all texts, sorted by token within a segment."""

    def postings(segment: int, ids: list, texts: list):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        words, lengths = [], []
        for t in texts:
            found = words_of(t)
            lengths.append(len(found))
            words += found
        lengths = np.array(lengths, dtype=np.int64)
        firsts = np.concatenate([[0], np.cumsum(lengths + GAP)[:-1]])
        kinds = pa.array(words, pa.binary()).dictionary_encode()
        del words
        order = pc.sort_indices(kinds.dictionary).to_numpy()
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        code = rank[kinds.indices.to_numpy()]
        places = np.arange(len(code)) + np.repeat(firsts - np.cumsum(lengths) + lengths, lengths)
        places = places[np.argsort(code, kind="stable")].astype(np.int32)
        n = np.bincount(code, minlength=len(order))
        tokens, rows = kinds.dictionary.take(pa.array(order)).cast(pa.string()), len(order)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(places))
        nulls = [pa.nulls(rows, pa.list_(pa.int64())), pa.nulls(rows, pa.list_(pa.int32()))]
        names = ["segment", "token", "n", "positions", "doc_ids", "lengths"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment], pa.int64()), pa.array([""]), pa.array([0], pa.int32()),
             pa.array([firsts.tolist()], pa.list_(pa.int32())), pa.array([ids], pa.list_(pa.int64())),
             pa.array([lengths.tolist()], pa.list_(pa.int32()))], names=names)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(rows, segment)), tokens, pa.array(n.astype(np.int32)), lists, *nulls], names=names)

    def run(batches: Iterator):
        from pyspark import TaskContext

        segment, ids, texts, size = TaskContext.get().partitionId() << 24, [], [], 0
        for b in batches:
            for key, value in zip(b.column(0).to_pylist(), b.column(1)):
                value = value.as_py()
                if texts and (size + len(value) > SEGMENT_CHARS or len(texts) >= SEGMENT_DOCS):
                    yield from postings(segment, ids, texts)
                    segment, ids, texts, size = segment + 1, [], [], 0
                ids.append(key)
                texts.append(value)
                size += len(value)
        if texts:
            yield from postings(segment, ids, texts)

    taken = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return stored(taken.mapInArrow(run, POSTINGS), "postings")


def indexed_documents(index: DataFrame) -> DataFrame:
    """segment, ordinal, doc_id, n_words of every indexed document."""
    rows = index.where("token = ''").select("segment", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("ordinal", "d"))
    return rows.select("segment", "ordinal", F.col("d.doc_ids").alias("doc_id"), F.col("d.lengths").cast("long").alias("n_words"))


# ---------------------------------------------------------------- the test side

def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(window, phrase) of every distinct window, and (window, item) of the items that hold it."""

    def run(batches: Iterator):
        import pyarrow as pa

        for b in batches:
            rows = []
            for item, value in zip(b.column(0).to_pylist(), b.column(1)):
                words = words_of(value.as_py())
                phrases = {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else ()
                rows += [(item, p) for p in sorted(phrases)]
            cols = list(zip(*rows)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary()).cast(pa.string())],
                                             names=["item", "phrase"])

    taken = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), text_of(text).alias("text"))
    held = stored(taken.mapInArrow(run, "item string, phrase string").distinct(), "item_windows")
    windows = stored(held.select("phrase").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    return windows, held.join(windows, "phrase").select("window", "item")


def ordered_windows(index: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored (window, length, terms), terms as (frequency, term, offsets) from the rarest on, of the
    windows of a block whose words all occur; and (token, term)."""
    words = windows.select("window", F.posexplode(F.split("phrase", " ")).alias("at", "token"))
    of = words.groupBy("window", "token").agg(F.sort_array(F.collect_list("at")).alias("offsets"))
    # a block's words; the map side sums each token over a task's segments first
    asked = F.broadcast(words.select("token").distinct())
    found = index.select("token", "n").join(asked, "token").groupBy("token").agg(F.sum("n").alias("frequency"))
    terms = stored(found.withColumn("term", F.monotonically_increasing_id()), "terms")
    whole = windows.select("window", F.size(F.split("phrase", " ")).alias("length"),
                           F.size(F.array_distinct(F.split("phrase", " "))).alias("kinds"))
    listed = of.join(terms, "token").groupBy("window").agg(
        F.sort_array(F.collect_list(F.struct("frequency", "term", "offsets"))).alias("terms"))
    made = listed.join(whole, "window").where(F.size("terms") == F.col("kinds")).select("window", "length", "terms")
    return stored(made, "ordered_windows"), terms.select("token", "term")


# ---------------------------------------------------------------- searching, in tasks

def held_at(sorted_list, places):
    """Which of ``places`` the sorted list holds."""
    import numpy as np

    at = np.searchsorted(sorted_list, places)
    at[at == len(sorted_list)] = 0
    return sorted_list[at] == places


def window_matches(lists: dict, length: int, terms: list, slop: int):
    """(starts of exact phrases, starts of the proximity matches) of one window in a segment.

    ``terms`` are (term, offsets) from the rarest on; each later list narrows the places of the first."""
    import numpy as np

    width, places = length + slop, lists[terms[0][0]]
    for term, _ in terms[1:]:
        other = lists[term]
        near = np.searchsorted(other, places + width, "left") > np.searchsorted(other, places - width, "right")
        places = places[near]
        if not len(places):
            return places, places
    starts = places - terms[0][1][0]
    for term, offsets in terms:
        for offset in offsets:
            starts = starts[held_at(lists[term], starts + offset)]
    # every stretch of ``width`` words around a place, and whether all terms stand in it
    spans = places[:, None] - np.arange(width, dtype=np.int32)
    good = np.ones(spans.shape, bool)
    for term, _ in terms[1:]:
        good &= np.searchsorted(lists[term], spans + width) > np.searchsorted(lists[term], spans)
    any_good = good.any(1)
    # the last such stretch begins nearest to the words
    return starts, spans[any_good, good[any_good].argmax(1)]


def segment_search(by_rarest: dict, slop: int):
    """Function of one segment's posting rows: a row for each document with a match."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        table = table.combine_chunks()
        rows, values = table["positions"].chunk(0), table["positions"].chunk(0).flatten().to_numpy()
        ends = np.cumsum(rows.value_lengths().to_numpy())
        lists, docs = {}, None
        for i, (term, end) in enumerate(zip(table["term"].to_pylist(), ends.tolist())):
            part = values[(ends[i - 1] if i else 0):end]
            if term < 0:
                docs, lengths = part, table["lengths"][i].as_py()
            else:
                lists[term] = part
        exact, near, cover = [], [], np.zeros(int(docs[-1]) + lengths[-1] + 1, np.int32)
        for rarest in lists:
            for window, length, terms in by_rarest.get(rarest, ()):
                if any(t not in lists for t, _ in terms):
                    continue
                starts, close = window_matches(lists, length, terms, slop)
                if len(starts):
                    exact.append((np.full(len(starts), window), starts))
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, starts + length, -1)
                if len(close):
                    near.append((np.full(len(close), window), close))
        covered = np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)])
        edge = np.diff(covered)
        first, last = np.flatnonzero(edge == 1).astype(np.int32), np.flatnonzero(edge == -1).astype(np.int32)

        def of_documents(at, *columns):
            """{ordinal: columns of the rows whose place ``at`` lies in it}, places from its first word."""
            doc = np.searchsorted(docs, at, "right") - 1
            order = np.argsort(doc, kind="stable")
            cuts = np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else []
            return {int(doc[g[0]]): [c[g] if moved is None else c[g] - docs[doc[g[0]]] for c, moved in columns] for g in cuts}

        def joined(found):
            return [np.concatenate([f[k] for f in found]) for k in (0, 1)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int32)]

        (exact_window, exact_at), (near_window, near_at) = joined(exact), joined(near)
        # a proximity match may begin in the gap before a document: its place is that of the next word
        near_doc = np.searchsorted(docs, near_at + GAP // 2, "right") - 1
        near_at = np.maximum(near_at, docs[near_doc]) if len(near_at) else near_at
        spans = of_documents(first, (first, True), (last, True))
        whole = of_documents(exact_at, (exact_window, None), (exact_at, True))
        close = of_documents(near_at, (near_window, None), (near_at, True))
        none, segment = [[], []], table["segment"][0].as_py()
        made = [(segment, d, *spans.get(d, none), *whole.get(d, none), *close.get(d, none)) for d in sorted({*spans, *close})]
        kinds = [pa.int64(), pa.int32(), *(pa.list_(t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32()))]
        cols = list(zip(*made)) or [()] * 8
        return pa.table([pa.array(list(c), t) for c, t in zip(cols, kinds)],
                        names=["segment", "ordinal", "starts", "ends", "windows", "places", "near_windows", "near_places"])

    return run


def matches(index: DataFrame, windows: DataFrame, slop: int = SLOP) -> DataFrame:
    """Stored rows a document and block: the covered stretches (starts, ends), the exact phrases
    (windows, places) and the proximity matches (near_windows, near_places); places count words
    from the document's first."""
    if not 0 <= slop <= GAP // 2 - WINDOW - 1:
        raise ValueError("a proximity match must be shorter than half the gap between documents")
    spark, out = index.sparkSession, []
    size = windows.agg(F.count(F.lit(1)), F.sum(F.octet_length("phrase"))).first()
    blocks = max(-(-size[0] // BLOCK), -(-(size[1] or 0) // BLOCK_BYTES))
    for block in range(blocks):
        ordered, terms = ordered_windows(index, windows.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == block))
        by_rarest: dict = {}
        # about BLOCK rows of at most WINDOW numbers
        for r in ordered.toLocalIterator():
            by_rarest.setdefault(r.terms[0].term, []).append((r.window, r.length, [(t.term, t.offsets) for t in r.terms]))
        used = ordered.select(F.explode("terms.term").alias("term")).distinct().join(terms, "term").select("token", "term")
        used = used.unionByName(spark.createDataFrame([("", -1)], "token string, term long"))
        rows = index.join(F.broadcast(used), "token").select("segment", "term", "positions", "lengths")
        out.append(stored(rows.groupBy("segment").applyInArrow(segment_search(by_rarest, slop), HITS), "window_hits"))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], HITS)


def _covered(stretches: Column) -> Column:
    """Words in the union of (start, end) stretches sorted by their starts."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    return F.aggregate(stretches, zero, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["ends"] - F.greatest(a["to"], x["starts"]))).alias("n"),
        F.greatest(a["to"], x["ends"]).alias("to")), lambda a: a["n"].cast("long"))


def contamination_report(docs: DataFrame, items: DataFrame, slop: int = SLOP) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and n_near (items with a proximity
    match) of every document."""
    windows, held = item_windows(items)
    index = positional_index(docs)
    hits, key = matches(index, windows, slop), ["segment", "ordinal"]
    covered = hits.groupBy(*key).agg(_covered(F.sort_array(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))).alias("n_hit"))
    each = lambda c, near: hits.select(*key, F.explode(F.array_distinct(c)).alias("window"), F.lit(near).alias("near"))
    found = each("windows", False).unionByName(each("near_windows", True)).join(held, "window").select(*key, "item", "near").distinct()
    exact = F.when(~F.col("near"), F.col("item"))
    listed = found.groupBy(*key).agg(F.sort_array(F.collect_list(exact)).alias("items"),
                                     F.count(F.when(F.col("near"), 1)).alias("n_near"))
    out = indexed_documents(index).join(covered.join(listed, key, "left"), key, "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", zero(F.col("n_hit")).alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
                      (zero(F.col("n_hit")) > 0).alias("contaminated"), zero(F.col("n_near")).alias("n_near"))


#: The same rows in DuckDB: windows as strings, proximity around the rarest word of each window.
REPORT_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
held AS (
  SELECT DISTINCT item, unnest(list_transform(range(1, greatest(1, len(w) - 9) + 1), lambda i: w[i:i + 9])) AS win FROM item WHERE len(w) > 0),
wins AS (SELECT DISTINCT win, len(win) AS n FROM held),
grams AS (
  SELECT id, i, n, w[i:i + n - 1] AS win FROM (
    SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM wins))),
exact AS (SELECT id, i, n, win FROM grams JOIN wins USING (win, n)),
hit AS (SELECT id, count(*) AS n_hit FROM (SELECT DISTINCT id, unnest(range(i, i + n)) FROM exact) GROUP BY id),
items AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT id, item FROM exact JOIN held USING (win)) GROUP BY id),
place AS (SELECT id, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM doc),
freq AS (SELECT t, count(*) AS f FROM place GROUP BY t),
rarest AS (
  SELECT win, n, arg_min(t, (f, t)) AS t FROM (SELECT win, n, unnest(win) AS t FROM wins) LEFT JOIN freq USING (t)
  GROUP BY win, n HAVING count(*) = count(f)),
near AS (
  SELECT DISTINCT id, win FROM (
    SELECT id, win, w, p, n, unnest(range(p - n - 4, p + 1)) AS s FROM rarest JOIN place USING (t) JOIN doc USING (id))
  WHERE list_has_all(w[greatest(s, 1):s + n + 4], win)),
near_items AS (SELECT id, count(DISTINCT item) AS n_near FROM near JOIN held USING (win) GROUP BY id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM doc LEFT JOIN hit USING (id) LEFT JOIN items USING (id) LEFT JOIN near_items USING (id)
"""
