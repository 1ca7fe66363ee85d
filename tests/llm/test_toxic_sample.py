"""Rare labels are in the sample."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.llm import toxicity


def test_toxic_sample_has_both_classes(spark):
    r = random.Random(8)
    order = [x.id for x in spark.range(400).orderBy(F.xxhash64("id"), "id").collect()]
    bad = set(order[-12:])  # rare, and the last by hash
    text = lambda i: " ".join(f"w{r.randrange(400)}" for _ in range(60)) + (" idiot scum" if i in bad else "")
    docs = spark.createDataFrame([(i, text(i)) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in bad)) for i in range(400)], "doc_id long, toxic int")
    found = toxicity.severities(docs, toxicity.fit(docs, labels, sample=100)).filter("toxic").collect()
    assert {x.doc_id for x in found} == bad
