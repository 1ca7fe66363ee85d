"""Words whose polynomial hashes collide for every odd base, and phrases of a frequent
line in ever other surroundings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa

from tidemark.llm import jaccard, phrases, wordhash


def thue_morse(n):
    t = "a"
    while len(t) < n:
        t += t.translate(str.maketrans("ab", "ba"))
    return t


X = thue_morse(2048)
Y = X.translate(str.maketrans("ab", "ba"))


def test_words_that_collide_are_told_apart(spark):
    own = "one {} two three four five " + " ".join(f"w{i}" for i in range(55))
    df = spark.createDataFrame([(1, own.format(X)), (2, own.format(Y)[: own.format(Y).index("w0")] + "tail"), (3, f"{Y} " * 50)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in phrases.digests(df).collect()}
    assert got == {1: 0, 2: 0, 3: 0}
    small = spark.createDataFrame([(1, f"one {X} two three four five"), (2, f"one {Y} two three four five")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.linked(small).collect()} == {1: 1, 2: 2}
    fifty = " ".join(f"v{i}" for i in range(30))
    windows = spark.createDataFrame([(1, f"{fifty} {X} {fifty}"), (2, f"{fifty} {Y} {fifty}")], "doc_id long, text string")
    assert {r.n_removed for r in phrases.digests(windows).collect()} == {0}


def test_hashes_of_words():
    r = random.Random(1)
    words = sorted({"".join(r.choice("ab\x00ü") for _ in range(r.randrange(1, 14))) for _ in range(3000)} | {X, Y, "a" * 7, "a" * 8})
    (_, w), = wordhash.chunks(pa.array([" ".join(words)]), size=1 << 30)
    assert len(w.hash) == len(words) == len(np.unique(w.hash))
    long = [i for i, x in enumerate(words) if len(x.encode()) > 7]
    assert all(int(w.hash[i]) == int.from_bytes(hashlib.blake2b(words[i].encode(), digest_size=8).digest(), "little") for i in long)


def test_phrases_of_a_frequent_line_grow_with_its_passages(spark, monkeypatch):
    """Pairs of copies around one line: phrases are dealt out to the groups that have
    them, so twice the documents give about twice the rows."""
    dealt = []
    own = phrases._dealt

    def counted(windows):
        out = own(windows).persist()
        dealt.append(out.count())
        return out

    monkeypatch.setattr(phrases, "_dealt", counted)
    for n in (100, 200):
        r = random.Random(n)
        line = " ".join(f"l{i}" for i in range(40))
        texts = []
        for _ in range(n // 2):
            a, b = (" ".join(f"x{r.randrange(9999)}" for _ in range(60)) for _ in "ab")
            texts += [f"{a} {line} {b}"] * 2
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = phrases.digests(df, many=8).collect()
        assert sum(x.n_removed for x in got) == sum(x.n_words for x in got) / 2
    assert 0 < dealt[1] <= 2.2 * dealt[0]
