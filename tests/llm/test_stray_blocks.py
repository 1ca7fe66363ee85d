"""Each stray meets each member in a bounded block."""

from __future__ import annotations

from tidemark.llm import jaccard


def test_blocks_of_strays(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MEMBERS", 8)
    split = spark.createDataFrame([(1, r, r if r < 60 else 60, 60, 5, [0], 13, 8) for r in range(100)], "g long, r long, c long, main long, n long, bits array<long>, salts int, blocks int")
    rows = jaccard._dealt(split).collect()
    tasks = {}
    for x in rows:
        tasks.setdefault((x.salt, x.block), ([], []))[x.stray].append(x.r)
    pairs = [(a, b) for whole, stray in tasks.values() for a in stray for b in whole]
    assert sorted(pairs) == [(a, b) for a in range(60) for b in range(100)]
    assert max(len(stray) for _, stray in tasks.values()) < 30 and max(len(whole) for whole, _ in tasks.values()) < 30
