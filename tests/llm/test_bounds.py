"""What a task or the driver holds stays bounded under repeated rows, boilerplate, long
words and huge numbers."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, pieces, tokencount, topk, toxicity


def test_repeated_rows_bring_one_text_to_the_driver(spark):
    text = "alpha beta gamma delta " * 30
    rows = [(i, f"{text}{i} {'bad' if i % 2 else 'good'}", "en" if i % 3 else "fr") for i in range(60)]
    kind = "doc_id long, text string, lang string"
    once, often = spark.createDataFrame(rows, kind), spark.createDataFrame(rows + [rows[7]] * 3000, kind)
    got = langid.sample(often, F.lit(True), size=5)
    assert got == langid.sample(once, F.lit(True), size=5) and len(got) == 2 * 5 * langid.EXCERPTS
    two = langid.sample(often.unionByName(spark.createDataFrame([(7, "another text", "en")] * 50, kind)), F.lit(True), size=100)
    assert len({t for _, t in two}) <= len(rows) * langid.EXCERPTS
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    a, b = (toxicity.fit(x, labels, sample=40) for x in (often, once))
    assert a.terms == b.terms and a.cut == b.cut and a.terms


def test_sample_is_the_first_by_hash(spark):
    r = random.Random(1)
    rows = [(r.randrange(10**9), "some letters", r.choice(["a", "b"])) for _ in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    h = {x.doc_id: x.h for x in df.select("doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).collect()}
    got = langid.sample(df, F.lit(True), size=7)
    assert sorted(x for x, _ in got) == ["a"] * 7 + ["b"] * 7
    assert len({d for d, _, lang in rows if lang == "a"}) > 7 and len(h) > 300


def test_words_remembered_are_bounded(monkeypatch):
    monkeypatch.setattr(tokencount, "MAX_WORDS", 50)
    table = pieces.load()
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) + " " + "long" * 40 + str(i) for i in range(20)] + [" ".join(f"q{j}" for j in range(200))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    (out,) = tokencount._counter(table)(iter([batch]))
    assert out["n_tokens"].to_pylist() == [sum(len(pieces.viterbi(w, table)) for w in t.split()) for t in texts]


def test_boilerplate_makes_no_pairs(spark, monkeypatch):
    boiler = " ".join(f"b{i}" for i in range(30))
    pairs = {}
    own = decontaminate.stored

    def counted(df, name):
        out = own(df, name)
        if name == "leak-pairs":
            pairs[len(pairs)] = out.count()
        return out

    monkeypatch.setattr(decontaminate, "stored", counted)
    for n in (30, 60):
        items = [(i, boiler + " " + " ".join(f"i{i}x{j}" for j in range(20))) for i in range(n)]
        docs = [(i, boiler + " " + " ".join(f"d{i}x{j}" for j in range(40))) for i in range(n)] + [(-1, "x " + items[3][1]), (-2, boiler)]
        items += [(1000 + i, boiler) for i in range(12)]
        got = decontaminate.contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
        found = {(r.doc_id, r.item_id) for r in got.collect()}
        # items that are boilerplate alone are in every document, as they should
        assert {x for x in found if x[1] < 1000} == {(-1, 3)}
        assert {x for x in found if x[1] >= 1000} == {(d, 1000 + i) for d, _ in docs for i in range(12)}
        assert pairs[len(pairs) - 1] <= 12 * (n + 2) + 5


def test_huge_finite_components(spark):
    rows = [(0, [1e307, 1.0]), (50, [0.5, 2.0]), (1, [-1e307, 1.0]), (2, [0.25, 1.0]), (3, [float("inf"), 1.0]), (4, [3e9, -1.5])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    whole = {i: [int(x) * 256 if abs(x) > 2**60 else int(x * 256 // 1) for x in v] for i, v in rows if i != 3}
    top = (1 << 63) - 1
    clip = lambda x: max(-top - 1, min(top, x))
    for q in (0, 50):
        want = sorted(((-clip(sum(a * b for a, b in zip(whole[q], v, strict=True))), i) for i, v in whole.items() if i != q))[:5]
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [(i, -s) for s, i in want]


def test_bounds_prune_pairs_and_lose_none():
    """Vectors around a few directions: most pairs go by their bounds."""
    import numpy as np

    r = np.random.default_rng(1)
    centres = r.normal(0, 40, (20, 64))
    m = np.round(centres[r.integers(0, 20, 3000)] + r.normal(0, 2, (3000, 64)))
    best = topk._Best(np.arange(100), m[:100], 5, topk.LEVELS)
    scored, own = [], topk._exact
    topk._exact = lambda q, c: scored.append(len(q) * len(c)) or own(q, c)
    try:
        for lo in range(0, 3000, 500):
            best.add(np.arange(lo, lo + 500), m[lo : lo + 500])
    finally:
        topk._exact = own
    want = m[:100] @ m.T
    want[np.arange(100), np.arange(100)] = -np.inf
    for i in range(100):
        order = sorted(((-int(want[i, j]), j) for j in range(3000) if j != i))[:5]
        assert best.score[i] == order
    assert sum(scored[1:]) < 0.2 * 100 * 2500
