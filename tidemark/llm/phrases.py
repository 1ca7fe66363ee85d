"""Operator 2, substring dedup with repeated-phrase automata.

A window is ``WINDOW`` consecutive words of a document.  Every word goes that a
window covers whose word sequence also starts in a document of smaller id; all
windows are judged on the input.

1. Find.  Of a window's runs of ``GRAM`` words the one of least hash (the first of
   equal ones) is its anchor, so equal windows have equal anchors.  Neighbouring
   windows of one anchor form a passage, about twenty windows in one row.
   Passages stay if their anchor occurs in two documents.
2. Confirm.  Equal passages are one, owned by their smallest document, and only
   owners give up the words themselves.  Where an anchor has more than ``MANY``
   different passages (a frequent line, in ever other surroundings), its windows
   are counted too, and those in two passages or documents are the phrases;
   elsewhere a group's windows are.
3. Locate.  Passages are dealt out by anchor (those of a frequent anchor in groups
   of about ``MANY``, each with all phrases of it).  A task compiles the phrases of
   a bounded number of groups to an Aho-Corasick automaton over words, which knows
   the smallest document of each phrase, and streams the groups' passages through
   it.  What it finds holds for every copy of a passage: spans go back to all
   documents by a join on the passage's hashes.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Defined results: a null or blank text
has no words; texts below ``WINDOW`` words lose none; rows of equal id and text
are one document and all stay; equal ids with different texts are separate rows
of which none is smaller; a row without id loses nothing and removes nothing; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few_rows, free, slices, small, stored
from .wordhash import chunks, mix

WINDOW, GRAM = 50, 12
MANY = 200
#: An automaton is compiled for about so many phrase words at a time.
SHARD_WORDS = 100_000

_SEGMENTS = "doc_id long, tk long, h long, sh long, ats array<int>, m int"


def least_at(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the first minimum of ``values[i:i + width]``."""
    n = len(values) - width + 1
    best, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = best[: len(best) - step], best[step:]
        best, have = np.where(values[b] < values[a], b, a), have + step
    return best[:n]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _passages(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, keys = batch["doc_id"].to_numpy(), batch["tk"].to_numpy()
            for lo, w in chunks(batch["text"]):
                n = len(w.hash)
                if n < window:
                    continue
                row = w.row_of()
                anchor_hash = w.grams(gram)
                at = least_at(anchor_hash, window - gram + 1)
                ok = np.flatnonzero(row[: n - window + 1] == row[window - 1 :])
                if not len(ok):
                    continue
                anchor = at[ok]
                new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[ok[1:]] != row[ok[:-1]])])
                start = ok[new]
                m = np.diff(np.concatenate([np.flatnonzero(new), [len(ok)]]))
                h = anchor_hash[anchor[new]]
                sh = w.runs(start, start + m + window - 1)
                r = row[start]
                # a row for each different passage of a document, with all its places: a text
                # that repeats itself has as few rows as any other
                same = mix(sh + mix(r.astype(np.uint64)))
                order = np.argsort(same, kind="stable")
                head = np.flatnonzero(np.concatenate([[True], same[order[1:]] != same[order[:-1]]]))
                one = order[head]
                places = pa.ListArray.from_arrays(pa.array(np.append(head, len(order)), pa.int32()), pa.array((start - w.first[r])[order], pa.int32()))
                cols = [ids[lo + r[one]], keys[lo + r[one]], _signed(h[one]), _signed(sh[one])]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), places, pa.array(m[one], pa.int32())], names=["doc_id", "tk", "h", "sh", "ats", "m"])

    return run


def _words(window: int, heavy_windows: bool):
    """The words of the passages asked of a document; of frequent anchors' also
    each window by itself, with a hash (``heavy_windows``)."""
    names = ["h", "sh", "wh", "first", "copied", "salts", "text"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            asked = batch["asked"].to_pylist()
            ids = batch["doc_id"].to_pylist()
            out: list[tuple] = []
            size = 0
            for lo, w in chunks(batch["text"]):
                grams = w.grams(window) if heavy_windows else None
                for r in range(w.rows):
                    for x in asked[lo + r]:
                        a = int(w.first[r]) + x["at"]
                        if not heavy_windows:
                            text = w.text(a, a + x["m"] + window - 1)
                            out.append((x["h"], x["sh"], None, ids[lo + r], x["copied"], x["salts"], text))
                            size += len(text)
                        elif x["salts"] > 1:
                            for j in range(a, a + x["m"]):
                                text = w.text(j, j + window)
                                out.append((x["h"], x["sh"], int(_signed(mix(grams[j : j + 1]))[0]), ids[lo + r], x["copied"], x["salts"], text))
                                size += len(text)
                        if size > 1 << 23:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                            out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


_WORDS = "h long, sh long, wh long, first long, copied boolean, salts int, text binary"
_FOUND = "h long, sh long, found array<struct<a: int, b: int, first: bigint>>"


class _Shard:
    """Groups of passages with their phrases; ``locate`` compiles one automaton
    for them and streams the passages through it."""

    def __init__(self, window: int) -> None:
        self.window, self.size = window, 0
        self.number: dict[bytes, int] = {}
        self.phrases: dict[tuple, int] = {}
        self.streams: list[tuple[int, int, tuple]] = []

    def add(self, phrases: list[tuple[bytes, int]], passages: list[tuple[int, int, bytes, int]]) -> None:
        """``phrases`` (words, first document) if they are given apart, and
        ``passages`` (h, sh, words, first document) of one group."""
        number = self.number
        code = lambda text: tuple([number.setdefault(w, len(number)) for w in text.split()])
        coded = [(h, sh, code(text), first) for h, sh, text, first in passages]
        own = [(code(text), first) for text, first in phrases]
        if not own:
            if len(coded) == 1:
                own = [(c, first) for _, _, c, first in coded]
            else:
                n = self.window
                own = [(c[j : j + n], first) for _, _, c, first in coded for j in range(len(c) - n + 1)]
        for c, first in own:
            self.phrases[c] = min(first, self.phrases.get(c, first))
            self.size += len(c)
        self.streams += [x[:3] for x in coded]

    def locate(self) -> Iterator[tuple[int, int, list[dict[str, int]]]]:
        """(h, sh, spans): the windows a to b - 1 of a passage occur in document
        ``first``, and in none before it."""
        machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for c, first in self.phrases.items():
            machine.add_word(c, (len(c), first))
        machine.make_automaton()
        for h, sh, c in self.streams:
            spans: list[list[int]] = []
            for end, (n, first) in machine.iter(c):
                a, b = end + 1 - n, end + 1 - self.window + 1
                if spans and spans[-1][2] == first and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], b)
                else:
                    spans.append([a, b, first])
            if spans:
                yield h, sh, [{"a": a, "b": b, "first": first} for a, b, first in spans]


def _locate(window: int):
    names = ["h", "sh", "found"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("first", pa.int64())]))]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, now = _Shard(window), None
        phrases: list[tuple[bytes, int]] = []
        passages: list[tuple[int, int, bytes, int]] = []
        for batch in slices(batches):
            for h, sh, salt, is_phrase, first, text in zip(*(batch[c].to_pylist() for c in ("h", "sh", "salt", "phrase", "first", "text")), strict=True):
                if (h, salt) != now:
                    shard.add(phrases, passages)
                    phrases, passages, now = [], [], (h, salt)
                    if shard.size > SHARD_WORDS:
                        if rows := list(shard.locate()):
                            yield pack(rows)
                        shard = _Shard(window)
                if is_phrase:
                    phrases.append((text, first))
                else:
                    passages.append((h, sh, text, first))
        shard.add(phrases, passages)
        if rows := list(shard.locate()):
            yield pack(rows)

    return run


def _dealt(windows: DataFrame) -> DataFrame:
    """``(h, salt, first, text)``: the windows of frequent anchors that are in two passages
    or documents, once for each group that has a passage with them."""
    again = (F.max("copied") | (F.min("sh") < F.max("sh"))).alias("again")
    at = F.collect_set(F.pmod("sh", "salts").cast("int")).alias("at")
    phrases = windows.groupBy("h", "wh").agg(F.min("first").alias("first"), again, F.min("text").alias("text"), at).filter("again")
    return phrases.select("h", F.explode("at").alias("salt"), "first", "text")


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, many: int = MANY) -> DataFrame:
    """``(doc_id, tk, a, b)``: words a to b - 1 of a document are covered by
    windows that occur in a smaller one.  ``tk`` is xxhash64 of the text."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tk"), F.col("text").cast("string").alias("text")).filter("doc_id is not null and text is not null")
    found = base.mapInArrow(_passages(window, gram), _SEGMENTS)
    recurring = found.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("h")
    with few_rows(docs.sparkSession):
        passages = stored(found.join(recurring, "h", "left_semi"), "passages")
    owned = passages.select("h", "sh", "doc_id", "tk", F.element_at("ats", 1).alias("at"), "m")
    # an owner also says whether another document has the passage
    copied = (F.min("doc_id") < F.max("doc_id")).alias("copied")
    owned = owned.groupBy("h", "sh").agg(F.min(F.struct("doc_id", "tk", "at", "m")).alias("o"), copied).select("h", "sh", "o.*", "copied")
    owned = stored(owned, "passage-owners")
    salts = F.ceil(F.count("*") / many).cast("int").alias("salts")
    frequent = stored(owned.groupBy("h").agg(salts).filter("salts > 1"), "frequent-anchors")
    asked = owned.join(small(frequent), "h", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    asked = asked.groupBy("doc_id", "tk").agg(F.collect_list(F.struct("h", "sh", "at", "m", "copied", "salts")).alias("asked"))
    asked = stored(asked, "passages-asked")
    texts = base.join(small(asked.select("doc_id").distinct()), "doc_id", "left_semi").dropDuplicates(["doc_id", "tk"])
    texts = texts.join(asked, ["doc_id", "tk"]).select("doc_id", "text", "asked")
    streams = texts.mapInArrow(_words(window, False), _WORDS)
    streams = streams.select("h", "sh", F.pmod("sh", "salts").cast("int").alias("salt"), F.lit(False).alias("phrase"), "first", "text")
    if frequent.limit(1).count():
        phrases = _dealt(texts.filter(F.exists("asked", lambda x: x["salts"] > 1)).mapInArrow(_words(window, True), _WORDS))
        streams = streams.unionByName(phrases.select("h", F.lit(0).cast("long").alias("sh"), "salt", F.lit(True).alias("phrase"), "first", "text"))
    dealt = streams.repartition("h", "salt").sortWithinPartitions("h", "salt")
    with few_rows(docs.sparkSession):
        spans = stored(dealt.mapInArrow(_locate(window), _FOUND), "phrase-spans")
    # one row for each passage of a document, as each passage has one list of spans
    hits = passages.join(spans, ["h", "sh"]).select("doc_id", "tk", "ats", F.filter("found", lambda x: x["first"] < F.col("doc_id")).alias("found"))
    each = hits.withColumn("x", F.explode("found")).withColumn("at", F.explode("ats"))
    return each.select("doc_id", "tk", (F.col("at") + F.col("x.a")).alias("a"), (F.col("at") + F.col("x.b") + (window - 1)).alias("b"))


def _kept(words: list[bytes], spans: list[dict] | None) -> list[bytes]:
    if not spans:
        return words
    out = np.zeros(len(words) + 1, np.int32)
    for x in spans:
        out[x["a"]] += 1
        out[x["b"]] -= 1
    return [w for w, n in zip(words, np.cumsum(out[:-1]).tolist(), strict=True) if not n]


def with_spans(docs: DataFrame, name: str, **options: int) -> DataFrame:
    """All rows and columns of ``docs``, and the spans to remove as ``name``."""
    d, k = free("_d", docs), free("_k", docs)
    spans = repeated_spans(docs, **options).distinct()
    per = stored(spans.groupBy("doc_id", "tk").agg(F.collect_list(F.struct("a", "b")).alias("_spans")), "spans")
    # a merge join at every size: the spans grow with the documents
    side = per.select(F.col("doc_id").alias(d), F.col("tk").alias(k), F.col("_spans").alias(name)).hint("merge")
    return docs.join(side, (F.col("doc_id").cast("long") == F.col(d)) & (F.xxhash64("text") == F.col(k)), "left").drop(d, k)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        n, gone, sha = [], [], []
        for text, spans in zip(b["text"].cast(pa.large_binary()).to_pylist(), b["_spans"].to_pylist(), strict=True):
            words = (text or b"").split()
            kept = _kept(words, spans)
            n.append(len(words))
            gone.append(len(words) - len(kept))
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def digests(docs: DataFrame, **options: int) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of each row; the digest is of
    the kept words joined by one space."""
    rows = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "_spans", **options)
    return rows.mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _rewrite(names: list[str], spans_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = []
            for text, spans in zip(b["text"].cast(pa.large_binary()).to_pylist(), b[spans_name].to_pylist(), strict=True):
                texts.append(b" ".join(_kept(text.split(), spans)) if spans else text)
            own = {"text": pa.array(texts, pa.binary()).cast(pa.string())}
            yield pa.RecordBatch.from_arrays([own.get(c, b[c]) for c in names], names=names)

    return run


def without_repeats(docs: DataFrame, **options: int) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text``; a text that loses
    none is unchanged, any other is its kept words joined by one space."""
    name = free("_spans", docs)
    return with_spans(docs, name, **options).mapInArrow(_rewrite(docs.columns, name), docs.schema)
