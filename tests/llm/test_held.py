"""What stays on disk after a stored table, and what a task holds of its texts."""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lattice, phrases, pieces
from tidemark.llm.common import ARROW_ROWS, few_rows, stored


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in found if name.startswith("shuffle_")}


def test_texts_go_to_python_few_rows_at_a_time(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(key)
    with few_rows(spark):
        assert int(spark.conf.get(key)) == ARROW_ROWS
    assert spark.conf.get(key) == own


def test_a_stored_table_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, own = _shuffle_files(spark), spark.conf.get(key)
    counts = spark.range(5000).groupBy((F.col("id") % 97).alias("k")).agg(F.count("*").alias("n"))
    table = stored(counts.join(counts.withColumnRenamed("n", "m"), "k"), "counts")
    for _ in range(50):  # they go in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(key) == own
    assert table.count() == 97 and counts.count() == 97


def test_words_are_decoded_without_the_names_in_the_plan(spark):
    model = pieces.load()
    texts = ["plain", "na\u00efve", "\U0001f9ff\u2581x", "\u2581", "", "plain"]
    rows = [(i, w, pieces.viterbi(w, model) if w else []) for i, w in enumerate(texts)]
    spelt = spark.createDataFrame(rows, "count long, word string, ids array<int>").repartition(2)
    got = lattice.decode(spelt, model)
    assert got.columns == ["count", "word", "ids", "decoded"]
    assert sorted((r["count"], r.word, r.decoded) for r in got.collect()) == [(i, w, w) for i, w in enumerate(texts)]
    # the driver keeps the descriptions of plans; the model has 32,000 names
    assert len(got._jdf.queryExecution().toString()) < 50_000


def test_passages_are_cut_out_some_rows_at_a_time():
    n = 2000
    spans = [[{"a": 1, "b": 2}] if i % 3 else None for i in range(n)]
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([f"a{i} b c" for i in range(n)]), pa.array(spans, kind)], names=["doc_id", "text", "_spans"])
    out = list(phrases._rewrite(["doc_id", "text"], "_spans")(iter([batch])))
    assert max(b.num_rows for b in out) <= 512
    assert [t for b in out for t in b["text"].to_pylist()] == [f"a{i} c" if i % 3 else f"a{i} b c" for i in range(n)]
    digests = list(phrases._digest(iter([batch])))
    assert max(b.num_rows for b in digests) <= 512 and sum(b.num_rows for b in digests) == n


@pytest.mark.parametrize("edges", [1, 50, 1 << 17])
def test_edges_of_many_segments_are_folded_at_once(monkeypatch, edges):
    # 1: the last batch of a task has been folded but for its last segment
    monkeypatch.setattr(lattice, "EDGES", edges)
    table = pieces.load()
    r = np.random.default_rng(5)
    texts = ["".join(r.choice(list("abenorsté中"), int(r.integers(1, 20)))) for _ in range(300)]
    rows = []
    for t in texts:
        for end in range(1, len(t) + 1):
            for length in range(1, min(end, table.longest) + 1):
                piece = t[end - length : end]
                if piece in table.scores:
                    edge = lattice._edge(-table.scores[piece], 1, length, table.ids[piece])
                elif length == 1:
                    score, n = table.fallback(piece)
                    edge = lattice._edge(-score, n, 1, lattice.BYTES)
                else:
                    continue
                rows.append(({"segment": t, "uses": 1} if end == 1 else None, edge))
    kinds = [pa.struct([("segment", pa.string()), ("uses", pa.int64())]), pa.int64()]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[lo : lo + 37], strict=True), kinds, strict=True)], names=["segment", "edge"]) for lo in range(0, len(rows), 37)]
    got = [(s["segment"], p) for b in lattice._by_segment(iter(batches)) for s, p in zip(b["segment"].to_pylist(), b["path"].to_pylist(), strict=True)]
    assert [s for s, _ in got] == texts
    for t, path in got:
        ids: list[int] = []
        for p in path:
            code, end = p & (1 << 25) - 1, p >> 31
            ids += [code] if code != lattice.BYTES else [table.byte_ids[b] for b in t[end - 1].encode()]
        assert ids == pieces.best_ids(t, table)
