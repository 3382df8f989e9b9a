"""Corpus pipeline: documents -> not toxic -> one of each near-duplicate class -> sanitised -> mixed to
source weights -> token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is stored as Parquet in the
shared checkpoint folder and read again as the next stage's documents. All stages but the last
return the columns of ``documents``; the last gives a row a copy with its token count and digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid.llm.bpe_codec import round_trip
from staygrid.llm.common import stored, table
from staygrid.llm.disclosure import sanitise
from staygrid.llm.mixing import repeat_documents
from staygrid.llm.probminhash import one_of_each
from staygrid.llm.toxicity import reject_toxic


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labels, does not reject."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of least id, of each near-duplicate class."""
    return one_of_each(docs)


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and disclosing terms rewritten; n_chars follows a changed text."""
    out = sanitise(docs.withColumn("_before", F.col("text")))
    if "n_chars" in docs.columns:
        same = F.col("text").eqNullSafe(F.col("_before"))
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return repeat_documents(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip of every row of the mix."""
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", not_toxic), ("near_duplicates", deduplicated), ("personal_data", sanitised),
          ("source_mix", mixed), ("byte_bpe", tokenised)]

#: Model scores, near-duplicate classes and the dependent rounding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage's result is stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
