"""Operator 13, spelling variants by Bloom-guided neighbourhoods.

1. Words.  Runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts, A-Z lower-cased.  Each
   run takes the crc32 of ``<doc_id>:<run>``; where ``EVERY`` divides it, the code
   point at crc32 % length goes.  A task counts what it reads in a dictionary of at
   most ``HELD`` words, so words are counted before the shuffle.  The vocabulary is
   the words of ``SHORTEST`` code points or more, seen ``LEAST`` times or more.
2. Filters.  A blocked Bloom filter (a word sets ``PROBES`` bits of one 64-bit block)
   for each length, its blocks or-ed by a shuffle.  Filters are broadcast in rounds of
   at most ``FILTER_BYTES``; a length that exceeds this is cut by hash into more
   filters.  So the bits of a word, and the share of false positives, are the same at
   every size.
3. Edits.  Of two near words the longer one deletes a code point, or one of them
   replaces a code point by a smaller one; these edits alone are generated, as hashes
   in arrays, and probed.  Only hashes that pass go on.
4. Exact join.  The passed hashes meet the vocabulary on the hash, and the words that
   meet are near if their edit distance is one: this removes every false positive.
5. Roots.  Counts at least double along forms, so there are no circles.  Roots go
   down from words without form to the words whose form they are, a join for each
   level; a word is the form of no more than its near words, so no key is hot.

Defined results: a null text has no words; a null id is the empty string in the
crc32; repeated rows count each; an empty table gives no rows; other columns are
ignored.  Long words are only ever shuffled once for each near word, never once for
each edit.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .wordhash import mix

SHORTEST, LEAST, EVERY = 5, 3, 97
#: Words that a task counts at a time.
HELD = 400_000
#: Bits of a filter for each of its words, of which a word sets ``PROBES``.
BITS, PROBES = 24, 5
#: Bytes of filters that are broadcast at a time.
FILTER_BYTES = 32 << 20
#: Edits that are probed at a time.
EDITS = 1 << 20

_RUN = re.compile("[a-zÀ-ÿ]+")
_U = np.uint64
#: Place of a code point in the alphabet a-z, U+00C0 to U+00FF.
_PLACE = np.zeros(256, dtype=np.int64)
_PLACE[97:123] = np.arange(26)
_PLACE[192:256] = np.arange(26, 90)
_VALUE = mix(np.arange(1, 91, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_BASE = 0xD6E8FEB86659FD93


def variant(doc_id: str, run: str, every: int = EVERY) -> str:
    """The run of a document, without a code point where ``every`` divides its hash."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    k = h % len(run)
    return run[:k] + run[k + 1 :] if h % every == 0 else run


def _counted(shortest: int, every: int, held: int):
    def out(counts: Counter) -> Iterator[pa.RecordBatch]:
        words = list(counts)
        for lo in range(0, len(words), 1 << 14):
            part = words[lo : lo + (1 << 14)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[w] for w in part], pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for i, text in zip(batch["id"], batch["text"], strict=True):
                if not text.is_valid:
                    continue
                # of bytes, only A-Z are lower-cased
                lower = text.as_py().encode().lower().decode()
                begin = zlib.crc32((i.as_py() + ":").encode())
                for w, n in Counter(_RUN.findall(lower)).items():
                    h = zlib.crc32(w.encode(), begin)
                    if h % every == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1 :]
                    if len(w) >= shortest:
                        counts[w] += n
                if len(counts) > held:
                    yield from out(counts)
                    counts = Counter()
        yield from out(counts)

    return run


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE`` and its inverse modulo 2**64, to the powers 0 to n - 1."""
    both = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, b, dtype=_U)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def _values(words: list[str]) -> np.ndarray:
    """The places in the alphabet of words of one length, a row for each."""
    return _PLACE[np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)].reshape(len(words), -1)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, indices) of the words, some of one length at a time."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        step = max(1, (1 << 18) // n)
        for lo in range(0, len(at), step):
            yield n, at[lo : lo + step]


def hashes(words: list[str]) -> np.ndarray:
    """A 64-bit polynomial over each word's code points."""
    out = np.zeros(len(words), dtype=_U)
    for n, at in _by_length(words):
        out[at] = (_VALUE[_values([words[i] for i in at])] * _powers(n)[0]).sum(axis=1, dtype=_U)
    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words = b["word"].to_pylist()
        keys = hashes(words).view(np.int64)
        yield pa.RecordBatch.from_arrays([b["word"], b["n"], pa.array(keys), pa.array([len(w) for w in words], pa.int32())], names=["word", "n", "key", "length"])


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY, held: int = HELD) -> DataFrame:
    """``(word, n, key, length)`` of the words of all texts; ``key`` is their hash."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("string").alias("text"))
    some = texts.filter("text is not null").mapInArrow(_counted(shortest, every, held), "word string, n long")
    counted = some.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return stored(counted.mapInArrow(_hashed, "word string, n long, key long, length int"), "vocabulary")


def _shard_of(h: np.ndarray, parts: int) -> np.ndarray:
    return (h % _U(parts)).astype(np.int64)


def _bits(key: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and bits of each key in a filter of ``blocks`` blocks."""
    h = mix(key)
    block = (h >> _U(32)) * _U(blocks) >> _U(32)
    h = mix(h + _U(0x9E3779B97F4A7C15))
    bits = np.zeros(len(key), dtype=_U)
    for i in range(PROBES):
        bits |= _U(1) << (h >> _U(6 * i) & _U(63))
    return block.astype(np.int64), bits


def _blocks(sizes: dict[tuple[int, int], int], parts: dict[int, int]):
    """``(length, part, block, bits)`` of each word whose filter is in ``sizes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, length = b["key"].to_numpy().view(np.uint64), b["length"].to_numpy()
            for n in np.unique(length).tolist():
                if n not in parts:
                    continue
                own = key[length == n]
                part = _shard_of(mix(own), parts[n])
                for p in np.unique(part).tolist():
                    if (n, p) not in sizes:
                        continue
                    block, bits = _bits(own[part == p], sizes[n, p])
                    k = len(block)
                    cols = [np.full(k, n, np.int32), np.full(k, p, np.int32), block, bits.view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["length", "part", "block", "bits"])

    return run


class _Filters:
    """The filters of a round, by length of word and part."""

    def __init__(self, parts: dict[int, int]) -> None:
        self.parts, self.filters = parts, {}

    def passed(self, length: int, key: np.ndarray) -> np.ndarray:
        """Whether each key may be a word of this length."""
        out = np.zeros(len(key), dtype=bool)
        if length not in self.parts:
            return out
        part = _shard_of(mix(key), self.parts[length]) if self.parts[length] > 1 else None
        for p in range(self.parts[length]):
            f = self.filters.get((length, p))
            if f is not None:
                at = slice(None) if part is None else np.flatnonzero(part == p)
                block, bits = _bits(key[at], len(f))
                out[at] = f[block] & bits == bits
        return out


def _edits(values: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row, key) of the edits at places lo to hi - 1 of words of one
    length: deletions, and replacements by a smaller code point."""
    n = values.shape[1]
    up, down = _powers(n + 1)
    terms = _VALUE[values] * up[:n]
    sums = np.zeros((len(values), n + 1), dtype=_U)
    np.cumsum(terms, axis=1, out=sums[:, 1:])
    whole = sums[:, -1:]
    inverse = down[1]
    # of equal code points in a row the first goes: each deletion is there once
    new = np.ones(values.shape, dtype=bool)
    new[:, 1:] = values[:, 1:] != values[:, :-1]
    row, at = np.nonzero(new[:, lo:hi])
    at = at + lo
    yield n - 1, row, sums[row, at] + (whole[row, 0] - sums[row, at + 1]) * inverse
    smaller = values[:, lo:hi].ravel()
    total = int(smaller.sum())
    if total:
        cell = np.repeat(np.arange(len(smaller)), smaller)
        by = np.arange(total) - np.repeat(np.cumsum(smaller) - smaller, smaller)
        row, at = cell // (hi - lo), cell % (hi - lo) + lo
        yield n, row, whole[row, 0] + (_VALUE[by] - _VALUE[values[row, at]]) * up[at]


def _probed(filters):
    """``(key, edit)``: the hashes of words and of those of their edits that pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: _Filters = filters.value
        for b in batches:
            words, key = b["word"].to_pylist(), b["key"].to_numpy()
            for n, at in _by_length(words):
                if not {n, n - 1} & set(have.parts):
                    continue
                rows = max(1, EDITS // (n * 30))
                places = max(1, EDITS // 90)
                for x in range(0, len(at), rows):
                    some = at[x : x + rows]
                    values = _values([words[i] for i in some])
                    for lo in range(0, n, places):
                        for length, row, edit in _edits(values, lo, min(n, lo + places)):
                            ok = have.passed(length, edit)
                            if ok.any():
                                yield pa.RecordBatch.from_arrays([pa.array(key[some[row[ok]]]), pa.array(edit[ok].view(np.int64))], names=["key", "edit"])

    return run


def _rounds(lengths: dict[int, int], most: int) -> Iterator[tuple[dict[tuple[int, int], int], dict[int, int]]]:
    """The filters of each round, ``{(length, part): blocks}``, and the parts of
    each length, so that the filters of a round have ``most`` bytes at most."""
    sizes: dict[tuple[int, int], int] = {}
    parts: dict[int, int] = {}
    total = 0
    for n, words in sorted(lengths.items()):
        blocks = -(-words * BITS // 64)
        k = max(1, -(-blocks * 8 // max(8, most // 2)))
        for p in range(k):
            each = -(-blocks // k)
            if sizes and total + each * 8 > most:
                yield sizes, parts
                sizes, parts, total = {}, {}, 0
            sizes[n, p], parts[n] = each, k
            total += each * 8
    if sizes:
        yield sizes, parts


def near_words(vocab: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``(word, n, near, near_n)`` of all words of a ``vocabulary`` and their near words,
    both ways."""
    spark = vocab.sparkSession
    # a row for each length of word
    lengths = {r.length: r.k for r in vocab.groupBy("length").agg(F.count("*").alias("k")).collect()}
    found = None
    for sizes, parts in _rounds(lengths, filter_bytes):
        blocks = vocab.mapInArrow(_blocks(sizes, parts), "length int, part int, block long, bits long")
        filters = _Filters(parts)
        filters.filters = {k: np.zeros(v, dtype=_U) for k, v in sizes.items()}
        # at most as many rows as the filters of a round have blocks
        rows = blocks.groupBy("length", "part", "block").agg(F.bit_or("bits").alias("bits")).toArrow()
        length, part, block, bits = (rows[c].to_numpy() for c in ("length", "part", "block", "bits"))
        for n, p in sizes:
            own = (length == n) & (part == p)
            filters.filters[n, p][block[own]] = bits[own].view(np.uint64)
        shared = spark.sparkContext.broadcast(filters)
        passed = stored(vocab.mapInArrow(_probed(shared), "key long, edit long"), "passed-edits")
        shared.unpersist()
        found = passed if found is None else found.unionByName(passed)
    if found is None:
        return spark.createDataFrame([], "word string, n long, near string, near_n long")
    # the false positives go at the first join; what is left has the form of a near word
    near = vocab.select(F.col("key").alias("edit"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = found.join(near.hint("merge"), "edit").join(vocab.select("key", "word", "n").hint("merge"), "key")
    pairs = pairs.filter(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")
    both = F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return pairs.select(both.alias("x")).select("x.*")


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` with ``root``: from ``word`` along ``form`` to the last."""
    forms = stored(forms, "forms")
    below = forms.filter("form is not null")
    top = forms.filter("form is null").withColumn("root", F.col("word"))
    out, level = top, top
    while True:
        above = level.select(F.col("word").alias("_above"), F.col("root"))
        level = stored(below.join(above, F.col("form") == F.col("_above")).drop("_above"), "roots")
        if not level.limit(1).count():
            return out
        out = out.unionByName(level)


def variants(docs: DataFrame, filter_bytes: int = FILTER_BYTES, **options: int) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word: its form is the near
    word of largest n (the first of these), if this is at least twice its own."""
    vocab = vocabulary(docs, **options)
    near = near_words(vocab, filter_bytes)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    # a word has at most 90 (2 length + 1) near words; a pair may be there twice where hashes collide
    each = near.groupBy(F.col("word").alias("_word")).agg(F.size(F.collect_set("near")).cast("long").alias("n_near"), best)
    joined = vocab.select("word", "n").join(each.hint("merge"), F.col("word") == F.col("_word"), "left")
    is_form = -F.col("best.less") >= 2 * F.col("n")
    form = [F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")]
    return with_roots(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), *form)).select("word", "form", "root", "n", "n_near", "form_n")
