"""Corpus pipeline: toxic documents go, one of each group of near copies stays,
repeated passages are cut out, documents with benchmark items go, and what is left
is encoded.  Each stage reads what its predecessor kept.

A document is a row's id and text.  Of repeated rows one stays; texts under one id
are documents of their own, and so are rows without id: the stages that tell
documents by id get a number for each (see ``rows``).  Where the smallest document
stays, that is the one of smallest id; further texts of an id come after all ids,
rows without id last.  Blank texts are near copies of none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, lattice, phrases, toxicity
from tidemark.llm.common import free, stored, table
from tidemark.llm.rows import digest, numbered, restored

#: Near copies: word shingles of five words, Jaccard similarity 0.8 or more.
SHINGLE, SIMILAR = 5, (80, 100)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, own, copied = numbered(docs)
    kept = jaccard.one_of_each(rows, SHINGLE, SIMILAR)
    once = kept.filter(~F.col(copied)).unionByName(kept.filter(copied).dropDuplicates(["doc_id"]))
    return restored(once, own, docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, own, _ = numbered(docs)
    return restored(phrases.without_repeats(rows), own, docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # whether a document holds an item depends on its text alone
    own = free("_own_id", docs)
    rows = docs.withColumn(own, F.col("doc_id")).withColumn("doc_id", digest())
    return restored(decontaminate.without_items(rows, table(spark, sf_dir, "benchmark")), own, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lattice.digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]

#: The severity of a document comes from a fitted model: no SQL gives the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
