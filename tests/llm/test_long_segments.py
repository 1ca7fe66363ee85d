"""Segments that are too long for a fold."""

from __future__ import annotations

from tidemark.llm import lattice, pieces


def test_long_segments(spark, monkeypatch):
    monkeypatch.setattr(lattice, "STRETCH", 7, raising=False)
    monkeypatch.setattr(lattice, "PIECE_BITS", 5)
    model = pieces.load()
    texts = ["the" * 60 + " theranios " + "x" * 90, "ü" * 300 + " 日本語" * 3, "qzxjkv" * 40 + "é", "short one"]
    want = {w: pieces.viterbi(w, model) for t in texts for w in t.split()}
    assert max(len(x) for x in want.values()) > 32
    table, _ = lattice.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.word: list(r.ids) for r in table.collect()} == want


def test_words_of_one_segment_are_not_put_together_by_a_shuffle(spark):
    model = pieces.load()
    own = ["the", "a", "日本", "house", "x日y", "housex日ythe", "▁", "z▁z", "zz\x00z", "é"]
    vocabulary = spark.createDataFrame([(w, i + 1) for i, w in enumerate(own)], "word string, count long")
    for frequent in (0, 3, 1000):
        spelt, _ = lattice.spell(vocabulary, model, frequent)
        assert sorted(map(tuple, spelt.collect())) == sorted((w, i + 1, pieces.viterbi(w, model)) for i, w in enumerate(own))
        # parts are grouped below the union, those of several segments alone
        assert spelt._jdf.queryExecution().optimizedPlan().nodeName() == "Union"
