"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from staygrid.llm.common import table
from staygrid.llm.decontaminate import REPORT_SQL
from staygrid.llm.importance import DRAW_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {"op11_importance": DRAW_SQL, "op13_positional_index": REPORT_SQL}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_token_files(spark, sf_dir):
    from staygrid.llm.token_files import read_token_files, write_token_files
    from staygrid.session import shared_dir

    manifest = write_token_files(table(spark, sf_dir, "documents"), shared_dir(spark, "token_files"),
                                 public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=2)
    return read_token_files(spark, manifest)


@query
def op6_token_counts(spark, sf_dir):
    from staygrid.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_byte_bpe(spark, sf_dir):
    from staygrid.llm.bpe_codec import round_trip

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN)


@query
def op10_source_mix(spark, sf_dir):
    from staygrid.llm.mixing import mix_report

    return mix_report(table(spark, sf_dir, "documents"))


@query
def op7_simhash(spark, sf_dir):
    from staygrid.llm.simhash import fingerprint_report

    return fingerprint_report(table(spark, sf_dir, "documents"))


@query
def op4_disclosure(spark, sf_dir):
    from staygrid.llm.disclosure import span_report

    return span_report(table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark, sf_dir):
    from staygrid.llm.toxicity import score_report

    return score_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_multiprobe(spark, sf_dir):
    from pyspark.sql import functions as F

    from staygrid.llm.multiprobe import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op9_hidden_markov(spark, sf_dir):
    from staygrid.llm.hidden_markov import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


@query
def op1_probminhash(spark, sf_dir):
    from staygrid.llm.probminhash import class_report

    return class_report(table(spark, sf_dir, "documents"))


@query
def op11_importance(spark, sf_dir):
    from staygrid.llm.importance import draw_report

    return draw_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_alignment(spark, sf_dir):
    from staygrid.llm.alignment import alignment_report

    return alignment_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


@query
def op13_positional_index(spark, sf_dir):
    from staygrid.llm.decontaminate import contamination_report

    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
