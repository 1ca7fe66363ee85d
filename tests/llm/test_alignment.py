"""Alignment of two tokenizers against brute force over whole texts' token bytes."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment, registry

KIND = "doc_id long, text string, row string, pair string, n string, pairs string"


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(alignment.BYTE_BPE)
    a.encode_special_tokens = True
    names = {i: t for t, i in a.get_vocab().items()}
    byte = alignment.byte_of()
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL)

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    return a, b, lambda i: bytes(byte[c] for c in names[i]), of_b


def brute(rows, tokenizers):
    a, b, of_a, of_b = tokenizers
    per = []
    for i, t in rows:
        groups = []
        if t:
            ids_a, ids_b, raw = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t), (" " + t).encode()
            if b"".join(map(of_a, ids_a)) == raw == b"".join(map(of_b, ids_b)):
                at_a = {s: k for k, s in enumerate(_sums(map(of_a, ids_a)), 1)}
                at_b = {s: k for k, s in enumerate(_sums(map(of_b, ids_b)), 1)}
                p = q = 0
                for c in sorted(set(at_a) & set(at_b)):
                    groups.append((ids_a[p : at_a[c]], ids_b[q : at_b[c]]))
                    p, q = at_a[c], at_b[c]
        per.append((i, groups, Counter((x, y) for u, v in groups for x in u for y in v)))
    n = Counter(k for _, _, links in per for k in links)
    best = defaultdict(int)
    for (x, _), c in n.items():
        best[x] = max(best[x], c)
    out = []
    for i, groups, links in per:
        text = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in groups)
        n_best = sum(c for k, c in links.items() if n[k] == best[k[0]])
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((i, sum(len(u) for u, _ in groups), sum(len(v) for _, v in groups), len(groups), sum(links.values()), n_best, sum(c * n[k] for k, c in links.items()), sha))
    return sorted(out, key=str)


def _sums(parts):
    total = 0
    for p in parts:
        total += len(p)
        yield total


ALPHABET = ["a", "b", "é", "ü", "日", "本", "𓀀", "🎉", " ", "  ", "\n", "\t", " ", "　", "̀", "‍", "\x00", "\x1c", "\x85", "᠎", "<|endoftext|>", "</s>", "<0x0A>", "1", "'s", ".", "ß", "ﬁ", "Ａ", "﻿", "\r\n", "中", "ä", "�"]


def hostile():
    r = random.Random(2)
    rows = [(i, "".join(r.choice(ALPHABET) for _ in range(r.randrange(0, 30)))) for i in range(2500)]
    rows += [(i, "".join(r.choice([*ALPHABET, "▁"]) for _ in range(r.randrange(0, 9)))) for i in range(500)]
    rows += [(1, None), (None, None), (None, "x y"), (7, "x y"), (7, "x y"), (8, ""), (8, " "), (9, "a" * 20000), (10, "日本" * 3000), (11, "𓀀" * 2000), (12, " ".join(["foo"] * 3000))]
    return rows


@pytest.mark.parametrize("options", [{}, {"frequent": 50}])
def test_against_brute_force(spark, tokenizers, options):
    rows = hostile()
    df = spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in rows], KIND)
    assert sorted(map(tuple, alignment.digests(df, **options).collect()), key=str) == brute(rows, tokenizers)


def test_coarse_cuts_are_refined():
    """Some bytes of one character in both tokenizers: cuts inside the character."""
    al = alignment.aligner(alignment.BYTE_BPE, alignment.MODEL)
    found = alignment.learn(al, ["𓀀", "x"])
    assert found.numbers[0, 2] > 2 and found.numbers[1].tolist() == [1, 1, 1, 1]
    assert " ".join(al.units("a b  c\n d ")) == "a b  c\n d " and len(al.units("a b  c\n d ")) == 3


def test_memory_of_units_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "HELD", 10)
    known = alignment.Memory(alignment.BYTE_BPE, alignment.MODEL)
    for i in range(30):
        units = [f"w{i}", f"v{i}", "x" * 100, "a▁b"]
        known.know(units)
        assert set(units) <= set(known.place) and len(known.place) <= 10
        known.seen[[known.place[u] for u in units]] = known.now
        assert known.numbers[known.place["a▁b"], 0] == -1
        fresh = alignment.learn(known.aligner, [units[0]])
        k = known.place[units[0]]
        assert known.texts[k] == fresh.texts[0] and known.numbers[k].tolist() == fresh.numbers[0].tolist()
        assert known.links[known.first[k] : known.first[k + 1]].tolist() == fresh.links.tolist()


def test_empty_table(spark):
    assert alignment.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registered_query(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, registry.op12_tokenizer_alignment(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute([tuple(x) for x in docs.collect()], tokenizers)
