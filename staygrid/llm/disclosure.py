"""Personal data and information-theoretic sanitisation (operator 4), in DataFrame operations only.

Base spans are emails, addresses (ip), card and phone numbers, found leftmost without overlap per
kind over whole texts. Matched values are protected entities. A term of a text that holds an entity,
wherever it stands, discloses it by the share of the entity's information that the term gives away:

    disclosure(c, t) = PMI(c; t) / IC(c) = log(n_ct * N / (n_c * n_t)) / log(N / n_c)

with N documents, n_c of them holding the entity, n_t the term and n_ct both: 1 when the term
occurs with this entity only. Terms are words of four letters or more; those of the entity itself are
none of its terms. Terms that meet an entity in at least ``SUPPORT`` different texts and whose disclosure reaches ``GENERALISE`` become, at each of their places in these texts, spans of kind ``term`` (shown by a
general label), those from ``REMOVE`` on spans of kind ``hidden`` (taken out). Counts cover all
documents. Documents without personal data get no spans.

Null text is empty and has no spans. Repeated rows count as documents, but support counts
different texts. Overlapping spans are merged when a text is rewritten. Offsets are code points,
ends exclusive. Only doc_id and text are read; other columns of a rewritten table stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staygrid.llm.common import stored, text_of
from staygrid.llm.simhash import let

KINDS = ["email", "ip", "card", "phone"]
# Possessive forms of the four patterns: same leftmost matches, no backtracking and no recursion
# on long texts. ``\G`` lets a match start where the one before it ended.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERN = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # runs of fewer than 16 digits are no cards, so they need no match
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
POSSIBLE = {"email": r"@[A-Za-z0-9-]++\.", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
            "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
LABEL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "hidden": ""}
SPAN = "struct<kind:string,start:int,end:int,value:string>"
WORD = r"\p{L}++"
SUPPORT = 2
GENERALISE = 0.8
REMOVE = 0.999


def located(text: Column, kind: str, pattern: str) -> Column:
    """All matches as spans: the gaps between them come from a split by the same pattern."""
    def walk(pair: Column) -> Column:
        steps = F.transform(pair["found"], lambda v, i: F.struct(
            F.length(F.get(pair["gaps"], i)).alias("gap"), F.length(v).alias("n"), v.alias("value")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            span = F.struct(F.lit(kind).alias("kind"), (acc["at"] + s["gap"]).alias("start"),
                            (acc["at"] + s["gap"] + s["n"]).alias("end"), s["value"].alias("value"))
            return F.struct((acc["at"] + s["gap"] + s["n"]).alias("at"),
                            F.concat(acc["out"], F.array(span)).alias("out"))

        return F.aggregate(steps, start, step, lambda acc: acc["out"])

    pair = F.struct(F.split(text, pattern, -1).alias("gaps"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return let(pair, walk)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's sum over the digits from the right ends in 0."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: let(
        F.coalesce(d.try_cast("int"), F.lit(0)) * F.when(i % 2 == 1, 2).otherwise(1),
        lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _kept(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: let(
            F.regexp_replace(p, "^0+(?=[0-9])", ""),
            lambda x: (F.length(x) <= 3) & (F.coalesce(x.try_cast("int"), F.lit(999)) <= 255)))
    if kind == "card":
        return let(_digits(value), lambda d: F.length(d).between(16, 19) & _luhn(d))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans of the four kinds, by kind, then start."""
    none = F.array().cast(f"array<{SPAN}>")
    return F.concat(*[
        F.when(text.rlike(POSSIBLE[k]), _kept(located(text, k, PATTERN[k]), k))
        .otherwise(none) for k in KINDS])


def entity_value(kind: Column, value: Column) -> Column:
    return F.when(kind.isin("card", "phone"), _digits(value)).otherwise(F.lower(value))


def found_spans(df: DataFrame) -> DataFrame:
    """doc_id, text_key, base, text: a row a document; stored. The text is there where it has spans."""
    text = text_of()
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                     text.alias("text")).withColumn("base", base_spans(F.col("text")))
    return stored(docs.select("doc_id", "text_key", "base", F.when(F.size("base") > 0, F.col("text")).alias("text")), "pii_spans")


def text_terms(spans: DataFrame) -> DataFrame:
    """text_key, term, start, end, own: every term of the texts that have base spans, a text once; ``own``
    is the email the word is part of (entities of the other kinds have no letters)."""
    texts = spans.where(F.size("base") > 0).dropDuplicates(["text_key"]).select(
        "text_key", F.filter("base", lambda s: s["kind"] == "email").alias("mails"),
        F.transform(F.split("text", WORD, -1), lambda g: F.length(g)).alias("gap"),
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("word"))
    each = texts.select("text_key", "mails", F.posexplode(F.arrays_zip("gap", "word")).alias("at", "z")).select(
        "text_key", "mails", "at", F.col("z.gap").alias("gap"), F.col("z.word").alias("word"))
    before = Window.partitionBy("text_key").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.where(F.col("word").isNotNull()).withColumn("end", F.sum(F.col("gap") + F.length("word")).over(before).cast("int"))
    placed = placed.withColumn("start", F.col("end") - F.length("word"))
    own = F.get(F.filter("mails", lambda m: (m["start"] < F.col("end")) & (m["end"] > F.col("start"))), F.lit(0))["value"]
    return placed.select("text_key", F.lower("word").alias("term"), "start", "end", F.lower(own).alias("own")).where(F.length("term") >= 4)


def text_entities(spans: DataFrame) -> DataFrame:
    """text_key, kind, entity: the different entities of each text."""
    each = spans.where(F.size("base") > 0).select("text_key", F.explode("base").alias("s"))
    return each.select("text_key", F.col("s.kind").alias("kind"), entity_value(F.col("s.kind"), F.col("s.value")).alias("entity")).distinct()


def term_frequencies(df: DataFrame) -> DataFrame:
    """term, n_t: documents that hold the term, over all documents."""
    words = F.array_distinct(F.split(F.lower(text_of()), r"[^\p{L}]+"))
    return df.select(F.explode(words).alias("term")).where(F.length("term") >= 4) \
        .groupBy("term").agg(F.count("*").alias("n_t"))


def disclosing_terms(df: DataFrame, spans: DataFrame, generalise: float = GENERALISE) -> DataFrame:
    """kind, entity, term, disclosure, for the pairs at or above the threshold.

    As n_ct is n_c at most, a term can reach the threshold only where n_t is at most N^(1 - t) n_c^t: frequent
    terms are left out before texts' entities and terms are paired, and no pair is lost."""
    n = F.lit(float(max(spans.count(), 1)))
    # copies of a text share its key, so a document row is (text, how many rows); ids may be null
    rows = spans.where(F.size("base") > 0).groupBy("text_key").agg(F.count("*").alias("copies"))
    held = text_entities(spans).join(rows, "text_key")
    entities = held.groupBy("kind", "entity").agg(F.sum("copies").alias("n_c"), F.count("*").alias("in_texts")).where(
        (F.col("in_texts") >= SUPPORT) & (F.col("n_c") < n)).select(
        "kind", "entity", "n_c", ((1 - generalise) * F.log(n) + generalise * F.log("n_c") + 1e-9).alias("most"))
    terms = text_terms(spans).select("text_key", "term", "own").distinct().join(term_frequencies(df), "term")
    pairs = held.join(entities, ["kind", "entity"]).join(terms, "text_key").where(
        (F.log("n_t") <= F.col("most")) & ~((F.col("kind") == "email") & F.col("own").eqNullSafe(F.col("entity"))))
    # a term within an email and beside it is one pair of the text
    pairs = pairs.select("text_key", "kind", "entity", "term", "copies", "n_c", "n_t").distinct()
    known = pairs.groupBy("kind", "entity", "term", "n_c", "n_t").agg(
        F.sum("copies").alias("n_ct"), F.count("*").alias("texts")).where(F.col("texts") >= SUPPORT)
    share = F.log(F.col("n_ct") * n / (F.col("n_c") * F.col("n_t"))) / F.log(n / F.col("n_c"))
    return known.withColumn("disclosure", F.least(share, F.lit(1.0))) \
        .where(F.col("disclosure") >= generalise - 1e-12).select("kind", "entity", "term", "disclosure")


def sanitised_spans(df: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """doc_id, text_key, base, added: base spans and the spans of disclosing terms."""
    spans = found_spans(df)
    terms = disclosing_terms(df, spans, generalise)
    # every row of a text has the same spans, so the work is done once a text
    told = text_entities(spans).join(terms, ["kind", "entity"])
    places = text_terms(spans).join(told, ["text_key", "term"]).where(
        ~((F.col("kind") == "email") & F.col("own").eqNullSafe(F.col("entity"))))
    flagged = places.groupBy("text_key", "start", "end").agg(F.max("disclosure").alias("d"))
    kind = F.when(F.col("d") >= remove, "hidden").otherwise("term")
    # a text's spans are as many as its words at most
    added = flagged.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct(
        kind.alias("kind"), "start", "end"))).alias("added"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    held = spans.where(F.size("base") > 0).join(added, "text_key", "left")
    held = held.select("doc_id", "text_key", "base", F.coalesce("added", none).alias("added"))
    return spans.where(F.size("base") == 0).select("doc_id", "text_key", "base", none.alias("added")).unionByName(held)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_report(df: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term: a row a document."""
    out = sanitised_spans(df)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    bare = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    order = lambda k: F.filter("added", lambda s: s["kind"] == k)
    return out.select("doc_id", *[count(k) for k in KINDS], F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      _listed(F.concat(bare, order("term"), order("hidden"))).alias("spans"),
                      F.size("added").cast("long").alias("n_term"))


def rewritten(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind's label; spans that overlap are merged, the
    first one's label stands."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        label = F.lit("")
        for k, v in LABEL.items():
            label = F.when(s["kind"] == k, v).otherwise(label)
        fresh = s["start"] >= acc["at"]
        new = F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), label))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, new).otherwise(acc["out"]).alias("out"))

    ordered = F.array_sort(spans, lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                           .otherwise(b["end"] - a["end"]))
    return F.aggregate(ordered, start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))


def sanitise(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with personal data and disclosing terms rewritten in ``text``; a null text stays
    null and texts without spans stay as they are."""
    spans = sanitised_spans(df).where(F.size("base") > 0)
    bare = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    spans = spans.groupBy("text_key").agg(F.max(F.concat(bare, "added")).alias("_pii_spans")) \
        .withColumnRenamed("text_key", "_pii_key")
    keyed = df.withColumn("_pii_text", F.xxhash64(text_of(text)))
    out = keyed.join(spans, F.col("_pii_text") == F.col("_pii_key"), "left")
    new = F.when(F.col("_pii_spans").isNull(), F.col(text)).otherwise(rewritten(F.col(text), F.col("_pii_spans")))
    return out.withColumn(text, new).select(*df.columns)
