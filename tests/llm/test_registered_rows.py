"""The rows of the registered queries without SQL against plain versions: the same
fitted model, scored row by row."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, lattice, pieces, registry, toxicity, urls

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def test_token_counts_and_pieces(spark, docs, texts):
    table = pieces.load()
    words = {i: (t or "").encode().split() for i, t in texts.items()}
    memo = {w: len(pieces.viterbi(w.decode(), table)) for ws in words.values() for w in ws}
    want = {i: (len(ws), sum(map(memo.__getitem__, ws))) for i, ws in words.items()}
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in registry.op1_token_counts(spark, SF).collect()} == want
    got = {r.doc_id: r for r in registry.op10_sentencepiece(spark, SF).collect()}
    assert {i: (r.n_words, r.n_pieces) for i, r in got.items()} == want and all(r.n_exact == r.n_words for r in got.values())
    # the digest from the ids of every word
    _, rows = lattice.encode(docs)
    each = ((F.col("pos") + 1) * F.xxhash64("ids").bitwiseAND(lattice.DIGEST)).bitwiseAND(lattice.DIGEST)
    digests = {r.doc_id: r.d for r in rows.groupBy("doc_id").agg(F.sum(each).alias("d")).collect()}
    assert all(r.ids_digest == digests.get(i, 0) for i, r in got.items())


def test_toxicity_scores(spark, docs, texts):
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r.doc_id: r for r in registry.op3_toxicity(spark, SF).collect()}
    assert set(got) == set(texts) and model.terms
    for i, t in texts.items():
        own = {f for w in (t or "").encode().split() for f in toxicity.features(w)}
        z = sum(model.weights[k] for f, k in model.terms.items() if f in own)
        severity = sum(1 / (1 + math.exp(-(z - x))) for x in model.thresholds)
        assert got[i].severity == pytest.approx(severity, abs=2e-6)
        assert got[i].toxic == (got[i].severity >= model.cut)
    assert 0 < sum(r.toxic for r in got.values()) < len(got)


def _plain_probabilities(net, text):
    """One position after the other, both ways, block by block."""
    total, h_size = np.zeros(len(net.p["bias"])), net.h
    for lo in range(0, len(text), langid.BLOCK):
        block = text[lo : lo + langid.BLOCK]
        states = {}
        for d, order in (("f", range(len(block))), ("b", range(len(block) - 1, -1, -1))):
            h, states[d] = np.zeros(h_size), {}
            for t in order:
                a, b = net.p[f"in_{d}"][block[t]].astype(float), h @ net.p[f"re_{d}"].astype(float)
                gates = a[: 2 * h_size] + b[: 2 * h_size]
                gates = 0.5 + 0.5 * gates / (1 + np.abs(gates))
                z, r = gates[:h_size], gates[h_size:]
                c = a[2 * h_size :] + r * b[2 * h_size :]
                c = c / (1 + np.abs(c))
                h = states[d][t] = (1 - z) * c + z * h
        for t in range(len(block)):
            e = np.concatenate([states["f"][t], states["b"][t]]) @ net.p["out"].astype(float) + net.p["bias"]
            e = np.exp(e - e.max())
            total += e / e.sum()
    return total / len(text)


def test_languages(spark, docs, texts):
    langs, net = langid.train(langid.sample(docs, ~langid.held_out(F.col("doc_id"))))
    got = {r.doc_id: r for r in registry.op7_language_id(spark, SF).collect()}
    assert set(got) == set(texts)
    short = sorted((i for i, t in texts.items() if t), key=lambda i: len(texts[i]))[:90]
    for i in short + [i for i, t in texts.items() if not t]:
        t = texts[i] or ""
        if not any(c.isalpha() for c in t):
            assert (got[i].lang_pred, got[i].score) == (langid.UNKNOWN, 0.0)
            continue
        p = _plain_probabilities(net, t.encode())
        assert got[i].score == pytest.approx(p.max(), abs=1e-3)
        assert p[langs.index(got[i].lang_pred)] == pytest.approx(p.max(), abs=1e-3)


def test_urls(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    ruled = urls.with_rules(pages, registry.URL_RULES)
    fold = F.pmod(F.xxhash64(F.coalesce("url", F.lit(""))), F.lit(urls.FOLDS)) != 0
    rows = [(r.page_id, r.url or "", r.by_rule, r.seen) for r in ruled.select("page_id", "url", "by_rule", fold.alias("seen")).collect()]
    distinct = {u: (v, s) for _, u, v, s in rows}
    counts = {v: defaultdict(Counter) for v in ("allow", "block")}
    for u, (v, seen) in distinct.items():
        if v and seen:
            text = urls.START + u + urls.END
            for at in range(1, len(text)):
                for o in range(min(urls.ORDER, at) + 1):
                    counts[v][text[at - o : at]][text[at]] += 1

    def p(model, ctx, c):
        lower = p(model, ctx[1:], c) if ctx else 1 / urls.ALPHABET
        n = model.get(ctx)
        return (n[c] + len(n) * lower) / (sum(n.values()) + len(n)) if n else lower

    def score(u):
        text = urls.START + u + urls.END
        total = 0.0
        for at in range(1, len(text)):
            ctx = text[max(0, at - urls.ORDER) : at]
            total += math.log(p(counts["allow"], ctx, text[at])) - math.log(p(counts["block"], ctx, text[at]))
        return total / (len(u) + 1)

    scores = {u: score(u) for u in distinct}
    bins = defaultdict(lambda: [0, 0])
    for u, (v, seen) in distinct.items():
        if v and not seen:
            bins[round(max(-urls.LIMIT, min(urls.LIMIT, scores[u])), urls.DECIMALS)][v == "block"] += 1
    least = urls.threshold([(s, a, r) for s, (a, r) in bins.items()])
    got = {r.page_id: r.verdict for r in registry.op9_url_filter(spark, SF).collect()}
    model = {r.page_id: r.score for r in urls.judge(pages, registry.URL_RULES).collect()}
    for page, u, v, _ in rows:
        assert model[page] == pytest.approx(scores[u], abs=1e-6)
        if v or abs(scores[u] - least) > 1e-6:
            assert got[page] == (v or ("allow" if scores[u] >= least else "block"))
    assert {v for p, u, r, _ in rows if not r for v in [got[p]]} == {"allow", "block"}
