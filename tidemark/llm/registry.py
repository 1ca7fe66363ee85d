"""Queries of the dealt operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, decontaminate, jaccard, langid, lattice, phrases, spelling, suffixes, tokencount, topk, toxicity, urls
from .common import table
from .oracle import ORACLE

URL_RULES = (
    urls.Rule("allow", "org/"),
    urls.Rule("block", "example.org/es/"),
    urls.Rule("block", "example.org/en/1"),
    urls.Rule("allow", "com/fr/"),
    urls.Rule("block", "com/de/"),
)
MARKED = r"\### Assistant: </turn> ok"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.digests(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severities(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and conversation -7, which comes as a list of messages."""
    own = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.array(*[F.struct(F.lit(r).alias("role"), F.lit(MARKED).alias("content")) for r in ("user", "assistant")]).alias("messages"),
    )
    turns = chat.to_turns(table(spark, sf_dir, "conversations")).unionByName(chat.to_turns(own))
    return chat.digests(turns)


def op5_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, *langid.train(langid.sample(docs, ~langid.held_out(F.col("doc_id")))))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("score")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.digests(table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_substring_dedup,
        op3_toxicity,
        op4_chat_formatting,
        op5_top_k_search,
        op6_jaccard_join,
        op7_language_id,
        op8_benchmark_decontamination,
        op9_url_filter,
        op10_sentencepiece,
        op11_suffix_dedup,
        op12_tokenizer_alignment,
        op13_spelling_variants,
    )
}

__all__ = ["ORACLE", "QUERIES"]
