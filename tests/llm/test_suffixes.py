"""Suffix-array dedup against brute force: copies, near copies, periods, texts whose
polynomial hashes collide, windows one byte short of or past the threshold."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import registry, suffixes

KIND = "doc_id long, text string, row long, place string, _spans string, k1 string"


def brute(rows, window=400):
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        seen.update(b[p : p + window] for p in range(len(b) - window + 1))
    out = []
    for i, b in texts:
        gone, end = bytearray(len(b)), 0
        for p in range(len(b) - window + 1):
            if seen[b[p : p + window]] > 1:
                for q in range(max(p, end), p + window):
                    gone[q] = 1
                end = p + window
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        spans = sum(1 for q in range(len(b)) if gone[q] and (q == 0 or not gone[q - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def thue_morse(n):
    t = "a"
    while len(t) < n:
        t += t.translate(str.maketrans("ab", "ba"))
    return t


def hostile(seed):
    r = random.Random(seed)

    def prose(n):
        return " ".join("".join(r.choice("abcdeéöü日") for _ in range(r.randrange(1, 9))) for _ in range(n))

    rows = [(i, prose(r.randrange(1, 200))) for i in range(50)]
    shared = [prose(k) for k in (30, 60, 90, 100, 200)]
    for i in range(80, 150):
        own = prose(r.randrange(0, 100)).split(" ")
        k = r.randrange(len(own) + 1)
        own[k:k] = r.choice(shared).split(" ")
        rows.append((i, " ".join(own)))
    base = prose(200)
    for i in range(200, 230):
        near = list(base)
        for _ in range(i % 13):
            near[r.randrange(len(near))] = "x"
        rows.append((i, "".join(near)))
    edge, t = prose(100), thue_morse(2048)
    rows += [(400 + k, f"X{k}{edge[:k]}Y{k}") for k in range(396, 405)]
    rows += [(300, None), (301, ""), (302, "a" * 399), (303, "b" * 400), (304, "b" * 401), (305, "c" * 3000), (306, "la " * 400), (307, "la " * 130)]
    rows += [(308, base), (308, base), (None, base[:500]), (None, None), (309, prose(3000)), (310, "ab" * 150 + "q" + "ab" * 260), (311, "d" * 400), (312, "d" * 400)]
    rows += [(320, t), (321, t.translate(str.maketrans("ab", "ba")) + "zz"), (322, rows[5][1] + shared[4][:398])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"window": 40, "gap": 8, "gram": 4})])
def test_against_brute_force(spark, seed, options):
    rows = hostile(seed)
    df = spark.createDataFrame([(i, t, 1, "x", "x", "x") for i, t in rows], KIND).repartition(5)
    want = brute(rows, options.get("window", 400))
    assert sorted(map(tuple, suffixes.digests(df, **options).collect()), key=str) == want
    assert 0 < sum(x[2] > 0 for x in want) < len(want)


def test_spans_and_bytes(spark):
    rows = hostile(3)[:60]
    got = suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    digests = [(x.doc_id, x.n_bytes, sum(s.b - s.a for s in x.removed), len(x.removed), hashlib.sha256(x.kept).hexdigest()) for x in got]
    assert sorted(digests, key=str) == brute(rows)


def test_empty_table_and_impossible_windows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.digests(none).collect() == []
    with pytest.raises(ValueError):
        suffixes.digests(none, window=100, gap=90)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_ranks_go_on_over_tasks(spark, parts):
    """Equal keys over several tasks have one rank, wherever a task ends."""
    r = random.Random(parts)
    keys = [r.choice([1, 1, 1, 2, 3, *range(10, 40)]) for _ in range(300)]
    df = spark.createDataFrame([(k, i, i * 7) for i, k in enumerate(keys)], "k1 long, row long, place long")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {x.row: x["rank"] for x in suffixes.ranked(df, ["k1"], "test")[0].collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    uses = Counter(keys)
    order = sorted(keys)
    assert got == {i: order.index(k) for i, k in enumerate(keys) if uses[k] > 1}


def test_registered_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, registry.op11_suffix_dedup(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute([tuple(x) for x in docs.collect()])
    assert docs.filter(F.col("text").isNull()).count() < len(got)


@pytest.mark.parametrize("most", [50, 333, 1000])
def test_positions_of_a_long_text_come_in_stretches(most):
    r = random.Random(most)
    text = "".join(r.choice("ab ") for _ in range(4000)) + "x" * 500 + "ab" * 300 + "".join(r.choice("abc ") for _ in range(3000))
    data, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    for window, gap, gram in ((400, 124, 16), (60, 10, 4)):
        whole = suffixes.positions(data, offsets, window, gap, gram)
        parts = list(suffixes._stretches(data, offsets, window, gap, gram, most))
        assert len(parts) > 1 or most >= 1000
        assert [np.concatenate(x).tolist() for x in zip(*parts, strict=True)] == [x.tolist() for x in whole]


@pytest.mark.parametrize("block", [1, 7, 100, 1 << 15])
def test_anchors_found_in_blocks_are_those_of_a_plain_walk(monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK", block, raising=False)
    r = random.Random(block)
    text = "".join(r.choice("ab ") for _ in range(600)) + "x" * 300 + "ab" * 200
    data = np.frombuffer(text.encode(), np.uint8)
    sums, down = suffixes._prefix(suffixes._BYTE_VALUE[data], "byte")
    gap, gram = 20, 4
    value = (suffixes.mix((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]) >> np.uint64(suffixes.PLACE_BITS)).tolist()
    of_place = [min(range(x, x + gap), key=lambda i: (value[i], i)) for x in range(len(value) - gap + 1)]
    starts, anchors = suffixes._anchors(sums, down, gap, gram)
    want = [x for x in range(len(of_place)) if not x or of_place[x] != of_place[x - 1]]
    assert starts.tolist() == want
    assert anchors.tolist() == [of_place[x] for x in want]


def test_the_table_of_a_sorts_tasks_needs_no_python_tasks(spark):
    df = spark.createDataFrame([(i % 3, i, i) for i in range(20)], "k1 long, row long, place long")
    found, _ = suffixes.ranked(df, ["k1"], "test")
    assert found.count() == 20
    assert "ExistingRDD" not in found._jdf.queryExecution().toString()
