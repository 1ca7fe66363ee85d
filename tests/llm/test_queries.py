"""The registered queries against their SQL, and the pipeline against a plain
version of its stages, on the driver's smallest tables."""

from __future__ import annotations

import re
from collections import defaultdict

import duckdb
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from tidemark.llm import pieces, toxicity
from tidemark.llm.registry import ORACLE, QUERIES
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(cols, want)[0]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.severities(docs, model).collect() if r.toxic}
    texts = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist() if r["doc_id"] not in toxic}

    def shingles(text):
        w = WORD.findall(text)
        return {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {i: shingles(t.translate(lower)) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[:a]:
            x, y = sets[i], sets[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    texts = {i: t for i, t in texts.items() if find(i) == i}

    first = {}
    for i, t in texts.items():
        w = WORD.findall(t)
        for p in range(len(w) - 49):
            k = tuple(w[p : p + 50])
            first[k] = min(i, first.get(k, i))
    cut = {}
    for i, t in texts.items():
        w = WORD.findall(t)
        gone = {q for p in range(len(w) - 49) if first[tuple(w[p : p + 50])] < i for q in range(p, p + 50)}
        cut[i] = " ".join(x for q, x in enumerate(w) if q not in gone) if gone else t

    norm = lambda t: [x for x in re.split(r"[\W_]+", t.lower()) if x]
    fives = lambda w: {tuple(w[p : p + 5]) for p in range(len(w) - 4)}
    items = [s for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist() if (s := fives(norm(r["text"])))]
    by = defaultdict(list)
    for n, s in enumerate(items):
        for x in s:
            by[x].append(n)
    left = {}
    for i, t in cut.items():
        hits = defaultdict(int)
        for x in fives(norm(t)):
            for n in by.get(x, ()):
                hits[n] += 1
        if not any(100 * c >= 80 * len(items[n]) for n, c in hits.items()):
            left[i] = t

    table = pieces.load()
    want = sorted((i, len(w := WORD.findall(t)), sum(len(pieces.viterbi(x, table)) for x in w)) for i, t in left.items())
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.n_words, r.n_pieces) for r in got) == want
    assert 0 < len(got) < docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] and all(r.n_exact == r.n_words for r in got)
