"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import registry, spelling

KIND = "doc_id long, text string, word string, key string, n string, root string"
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def neighbours(w):
    cut = {w[:i] + w[i + 1 :] for i in range(len(w))}
    put = {w[:i] + a + w[i:] for i in range(len(w) + 1) for a in LETTERS}
    other = {w[:i] + a + w[i + 1 :] for i in range(len(w)) for a in LETTERS}
    return (cut | put | other) - {w}


def brute(rows, every=97):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    v = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [x for x in neighbours(w) if x in v] for w in v}
    form = {w: min(near[w], key=lambda x: (-v[x], x), default=None) for w in v}
    form = {w: x if x and v[x] >= 2 * v[w] else None for w, x in form.items()}
    out = []
    for w in v:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, v[w], len(near[w]), v[form[w]] if form[w] else None))
    return sorted(out, key=str)


def hostile():
    r = random.Random(4)
    words = ["".join(r.choice("abcÀéÿ") for _ in range(r.randrange(4, 8))) for _ in range(80)]
    words += [r.choice(sorted(neighbours(w))) for w in words for _ in range(3)]
    rows = [(i, " ".join(r.choice(words).title() if r.random() < 0.2 else r.choice(words) for _ in range(90)) + "7x") for i in range(40)]
    long = "ab" * 300
    rows += [(50, f"{long} {long} {long} {long}x {long}x {long}x {long}x {long}x {long}x {'z' * 40} "), (51, None), (None, None), (None, "éééééé " * 5), (52, ""), (53, "1 2 3 -- ×÷×÷× ×÷×÷× ×÷×÷×")]
    rows += [(60, "aaaaa " * 4), (60, "aaaaa " * 4), (60, "aaaaaa " * 40), (61, "aaaaaaa " * 200), (62, "ab")]
    return rows


@pytest.mark.parametrize("options", [{}, {"filter_bytes": 64, "held": 20}, {"every": 3}])
def test_against_brute_force(spark, options):
    rows = hostile()
    df = spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in rows], KIND)
    want = brute(rows, options.get("every", 97))
    got = spelling.variants(df, **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert any(x[1] and x[1] != x[2] for x in want)


def test_filters_miss_no_word_and_rounds_hold_the_bound():
    rounds = list(spelling._rounds({5: 100, 6: 100_000, 7: 3}, 4096))
    sizes = [s for r, _ in rounds for s in r.items()]
    assert all(sum(r.values()) * 8 <= 4096 for r, _ in rounds) and len(sizes) == len({k for k, _ in sizes})
    assert sum(b for (n, _), b in sizes if n == 6) * 64 >= 100_000 * spelling.BITS
    keys = spelling.hashes([f"{chr(97 + i % 26)}word{chr(97 + i // 26)}" for i in range(600)])
    block, bits = spelling._bits(keys, 30)
    have = spelling._Filters({6: 1})
    have.filters[6, 0] = np.zeros(30, np.uint64)
    np.bitwise_or.at(have.filters[6, 0], block, bits)
    assert have.passed(6, keys).all() and not have.passed(7, keys).any()


def test_edits_have_the_hash_of_their_strings():
    for w in ("aabca", "ÿàabc", "zzzzz"):
        places = spelling._values([w])
        got = sorted(int(k) for _, _, key in spelling._edits(places, 0, len(w)) for k in key)
        cut = {w[:i] + w[i + 1 :] for i in range(len(w))}
        less = {w[:i] + a + w[i + 1 :] for i in range(len(w)) for a in LETTERS if LETTERS.index(a) < LETTERS.index(w[i])}
        assert got == sorted(int(k) for k in spelling.hashes(sorted(cut)).tolist() + spelling.hashes(sorted(less)).tolist())


def test_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registered_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, registry.op13_spelling_variants(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute([tuple(x) for x in docs.collect()])
