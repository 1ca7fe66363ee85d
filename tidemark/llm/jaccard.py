"""Operator 6, n-gram Jaccard join with prefix trees.

A document's set is that of its distinct word shingles (lower-cased A-Z).  Two
documents link if ``den * |A & B| >= num * |A | B|``; the result is the component
of each document.  All links count: none is lost to a cap or a sample.

1. Equal sets are one class, represented by its smallest document.
2. Classes that share a part signature (see ``setparts``) form a group; the
   elements of frequent passages are counted first, so that these do not make
   groups.  Groups of
   up to ``ALL_PAIRS`` classes give all their pairs, larger ones pair their first
   member with the others.
3. Pairs that differ in too many bits of a 1024-bit parity sketch go: each element
   flips one bit, so the sets differ in at least as many elements.
4. The others are verified on the texts' own sets.  The sets paired with one class
   are kept in a prefix tree in the global order of n-grams (by hash); the class
   walks down the tree, overlaps of shared paths are counted once, and a subtree
   is left as soon as the rest of either set is too short to reach the overlap.
5. Links make components.  In a larger group whose members are not in one
   component yet, every member outside the most common one is compared with all
   members of other components (sketch, then tree), in blocks of both.  Members of one
   component need no comparison, so a group of thousands of near copies costs
   about one comparison per member, and the result is exact.

Defined results: a text of fewer words than a shingle has its whole sequence as
its one shingle; a null or blank text has an empty set, links with nothing and is
its own component; rows with equal sets are one class; repeated rows all stay; a
null id stays, its component is that of its set (null if no other row has it); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, small, stored
from .setparts import LESS_ONE, PART, WHOLE, Classes, digest, row_sets, signatures
from .wordhash import chunks, mix

SHINGLE, SIMILAR = 4, (85, 100)
ALL_PAIRS = 16
#: Sets of one tree, and members of a larger group compared in one block.
TREE, MEMBERS = 256, 4096
SKETCH = 1024
#: Buckets of signatures: so many at least, and one for so many elements of different sets.
BUCKETS, BUCKET_ELEMENTS = 512, 500_000
#: Sets whose signatures a task remembers to have given.
SEEN = 100_000
#: Elements named as common (see ``setparts``): in so many sets of a batch, at most so many in all.
COMMON_IN, COMMON = 8, 200_000
_U = np.uint64


def need(x: int, y: int, similar: tuple[int, int]) -> int:
    """Least overlap with which sets of x and y elements link."""
    num, den = similar
    return -(-(x + y) * num // (num + den))


def _sets(k: int):
    """Size and digest of each row's set; and rows (``element``) of the elements
    that are in COMMON_IN or more different sets of a batch, with the number."""
    names = ["element", "doc_id", "n", "d1", "d2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, d1, d2 = [], [], []
            seen: set[tuple[int, int]] = set()
            held: list[np.ndarray] = []
            much = 0

            def often() -> pa.RecordBatch:
                e, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, _U), np.zeros(0, np.int64))  # noqa: B023
                e, times = e[times >= COMMON_IN], times[times >= COMMON_IN]
                held.clear()  # noqa: B023
                none = pa.nulls(len(e), pa.int64())
                return pa.RecordBatch.from_arrays([pa.array(np.ones(len(e), bool)), none, pa.array(times.astype(np.int64)), pa.array(e.view(np.int64)), pa.array(np.zeros(len(e), np.int64))], names=names)

            for _, w in chunks(b["text"], lower=True):
                for s in row_sets(w, k):
                    x = digest(s) if len(s) else (0, 0)
                    n.append(len(s))
                    d1.append(x[0])
                    d2.append(x[1])
                    if len(s) and x not in seen:
                        seen.add(x)
                        held.append(s)
                        much += len(s)
                if much > 2_000_000:
                    yield often()
                    much = 0
            yield often()
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), bool)), b["doc_id"], pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64())], names=names)

    return run


def common_elements(counts: DataFrame, most: int = COMMON) -> np.ndarray:
    """The most frequent elements of ``(d1, n)``, at most ``most``, sorted."""
    counts = stored(counts.groupBy("d1").agg(F.sum("n").alias("n")), "element-counts")
    bins = counts.groupBy(F.floor(F.log2("n") * 8).alias("bin")).agg(F.count("*").alias("n")).collect()  # at most 64 * 8
    total, least = 0, 1 << 62
    for r in sorted(bins, reverse=True):
        total += r.n
        if total > most:
            break
        least = r.bin
    rows = counts.filter(F.floor(F.log2("n") * 8) >= least).select("d1").toArrow()["d1"].to_numpy()
    return np.sort(rows.astype(np.int64).view(_U))


def _signatures(k: int, similar: tuple[int, int], buckets: int, common: np.ndarray):
    """Signatures with the key of their set, as one blob per bucket and kind."""
    names = ["bucket", "kind", "sigs", "keys"]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, seen = Classes(*similar), set()
        sigs: dict[int, list] = {PART: [], WHOLE: [], LESS_ONE: []}
        keys: dict[int, list] = {PART: [], WHOLE: [], LESS_ONE: []}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for kind in sigs:
                if not sigs[kind]:
                    continue
                s = np.concatenate(sigs[kind])
                own = np.repeat(np.array([x for x, _ in keys[kind]], dtype=np.int64), [x for _, x in keys[kind]])
                bucket = (s % _U(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                s, own = s[order], own[order]
                ends = np.cumsum(np.bincount(bucket, minlength=buckets))
                rows = [(i, kind, s[a:b].tobytes(), own[a:b].tobytes()) for i, (a, b) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True)) if b > a]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                sigs[kind], keys[kind] = [], []

        for b in batches:
            for _, w in chunks(b["text"], lower=True):
                for s in row_sets(w, k):
                    if not len(s):
                        continue
                    x = digest(s)
                    if x in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(x)
                    for kind, own in signatures(s, classes, common):
                        sigs[kind].append(own)
                        keys[kind].append((x[0], len(own)))
                        held += len(own)
                if held > 500_000:
                    yield from flush()
                    held = 0
        yield from flush()

    return run


def _groups_of(sig: np.ndarray, key: np.ndarray) -> Iterator[np.ndarray]:
    """Different groups of two or more keys that share a signature."""
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    new = np.ones(len(sig), dtype=bool)
    new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
    sig, key = sig[new], key[new]
    start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, int)
    size = np.diff(np.append(start, len(sig)))
    for a, n in zip(start[size > 1], size[size > 1], strict=True):
        yield key[a : a + n]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partitions are sorted by bucket; a bucket is held at a time."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    now = None

    def flush() -> pa.RecordBatch | None:
        got: dict[int, np.ndarray] = {}
        join = lambda kind: [np.concatenate(x) for x in zip(*held.get(kind, []), strict=True)] if held.get(kind) else [np.zeros(0, _U), np.zeros(0, np.int64)]
        for keys in _groups_of(*join(PART)):
            got[int(mix(keys.view(_U)).sum(dtype=_U).view(np.int64))] = keys
        sig, key = join(WHOLE)
        less, other = join(LESS_ONE)
        order = np.argsort(less, kind="stable")
        less, other = less[order], other[order]
        for s, x, a, b in zip(sig, key, np.searchsorted(less, sig, "left"), np.searchsorted(less, sig, "right"), strict=True):
            for y in np.unique(other[a:b]):
                if x != y:
                    keys = np.array([x, y], dtype=np.int64)
                    got[int(mix(keys.view(_U)).sum(dtype=_U).view(np.int64))] = keys
        held.clear()
        if not got:
            return None
        size = [len(x) for x in got.values()]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(list(got), dtype=np.int64), size)), pa.array(np.concatenate(list(got.values())))], names=["g", "d1"])

    for b in batches:
        for bucket, kind, s, k in zip(*(b[c].to_pylist() for c in ("bucket", "kind", "sigs", "keys")), strict=True):
            if bucket != now and held and (out := flush()) is not None:
                yield out
            now = bucket
            held.setdefault(kind, []).append((np.frombuffer(s, _U), np.frombuffer(k, np.int64)))
    if held and (out := flush()) is not None:
        yield out


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits, same = [], []
            wanted = list(zip(b["d1"].to_pylist(), b["d2"].to_pylist(), strict=True))
            for lo, w in chunks(b["text"], lower=True):
                for i, s in enumerate(row_sets(w, k)):
                    odd = np.bincount((mix(s) % _U(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
                    bits.append(np.packbits(odd.astype(bool)).view(np.int64).tolist())
                    same.append(digest(s) == wanted[lo + i])
            out = pa.RecordBatch.from_arrays([b["r"], b["n"], b["d1"], pa.array(bits, pa.list_(pa.int64())), b["text"]], names=["r", "n", "d1", "bits", "text"])
            yield out.filter(pa.array(same, pa.bool_()))

    return run


def differ(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _may_link(similar: tuple[int, int]) -> Column:
    """Sizes and sketches (of r, o) allow a link."""
    num, den = similar
    least = F.ceil((F.col("n") + F.col("o_n")) * num / (num + den))
    return (F.col("n") * den >= F.col("o_n") * num) & (F.col("o_n") * den >= F.col("n") * num) & (differ(F.col("bits"), F.col("o_bits")) <= F.col("n") + F.col("o_n") - 2 * least)


def overlaps(probe: np.ndarray, sets: list[np.ndarray], similar: tuple[int, int], step: int = 64) -> list[int]:
    """Indexes of the sets that link with ``probe``.  The sorted sets are walked
    as a prefix tree, depth first: ``path[d]`` is the overlap of the first d
    elements of the present path, kept as far as the next set shares it."""
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    out = []
    path = np.zeros(1, dtype=np.int64)
    before = np.zeros(0, dtype=_U)
    for i in order:
        s = sets[i]
        n = min(len(s), len(before), len(path) - 1)
        apart = np.flatnonzero(s[:n] != before[:n])
        depth = int(apart[0]) if len(apart) else n
        path, before = path[: depth + 1], s
        least = need(len(probe), len(s), similar)
        while True:
            seen = int(path[depth])
            left = len(probe) - (int(np.searchsorted(probe, s[depth - 1], "right")) if depth else 0)
            if depth == len(s) or seen + min(len(s) - depth, left) < least:
                break
            part = s[depth : depth + step]
            at = np.minimum(np.searchsorted(probe, part), len(probe) - 1)
            path = np.concatenate([path, seen + np.cumsum(probe[at] == part)])
            depth += len(part)
        if depth == len(s) and int(path[depth]) >= least:
            out.append(i)
    return out


def _verify(k: int, similar: tuple[int, int]):
    """Partitions are sorted by probe and block, the probe's own row first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, probe, ids, sets = None, [], [], []
        links: list[tuple[int, int]] = []

        def flush() -> None:
            for p in probe:
                links.extend((now[0], ids[i]) for i in sorted(overlaps(p, sets, similar)) if len(sets))

        for b in batches:
            rows = list(zip(*(b[c].to_pylist() for c in ("a", "block", "member", "r")), strict=True))
            for lo, w in chunks(b["text"], lower=True):
                for i, s in enumerate(row_sets(w, k)):
                    a, block, member, r = rows[lo + i]
                    if (a, block) != now:
                        if now is not None:
                            flush()
                        now, probe, ids, sets = (a, block), [], [], []
                    if member:
                        ids.append(r)
                        sets.append(s)
                    else:
                        probe.append(s)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], names=["a", "b"])
                links = []
        if now is not None:
            flush()
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], names=["a", "b"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, k: int, similar: tuple[int, int]) -> DataFrame:
    """The pairs ``(a, b)`` that link."""
    texts = sets.select("r", "text")
    blocks = pairs.groupBy("a").agg(F.ceil(F.count("*") / TREE).cast("int").alias("blocks"))
    dealt = pairs.join(blocks, "a").select("a", F.pmod(F.xxhash64("b"), "blocks").cast("int").alias("block"), F.col("b").alias("r"))
    members = dealt.join(texts, "r").select("a", "block", F.lit(1).alias("member"), "r", "text")
    probes = dealt.select("a", "block").distinct().withColumn("r", F.col("a")).join(texts, "r").select("a", "block", F.lit(0).alias("member"), "r", "text")
    rows = members.unionByName(probes).repartition("a", "block").sortWithinPartitions("a", "block", "member", "r")
    return rows.mapInArrow(_verify(k, similar), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``(r, c)``: the smallest node that each node of ``(a, b)`` reaches.  Labels
    move along links and then jump to their own label, so long chains take few
    rounds; each round's labels are a stored table."""
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("r")).agg(F.least(F.min("b"), F.min("a")).alias("c")), "labels")
    while True:
        near = both.join(labels.select(F.col("r").alias("b"), "c"), "b").groupBy(F.col("a").alias("r")).agg(F.min("c").alias("m"))
        step = labels.join(near, "r").select("r", "c", F.least("c", "m").alias("m"))
        jump = labels.select(F.col("r").alias("m"), F.col("c").alias("j"))
        new = stored(step.join(jump, "m").select("r", F.least("m", "j").alias("c"), (F.col("c") != F.least("m", "j")).alias("moved")), "labels")
        labels = new.select("r", "c")
        if not new.filter("moved").limit(1).count():
            return labels


def _across(similar: tuple[int, int]):
    """Pairs of a group's members in different components that may link."""
    num, den = similar

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, odd = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if not rows or not odd:
                return
            r, c, n = (np.array([x[i] for x in rows], dtype=np.int64) for i in range(3))
            bits = np.array([x[3] for x in rows], dtype=np.int64).view(_U)
            for at in range(0, len(odd), 16):
                part = odd[at : at + 16]
                r2, c2, n2 = (np.array([x[i] for x in part], dtype=np.int64)[:, None] for i in range(3))
                bits2 = np.array([x[3] for x in part], dtype=np.int64).view(_U)
                apart = np.bitwise_count(bits2[:, None, :] ^ bits[None, :, :]).sum(2)
                both = n[None, :] + n2
                least = -(-both * num // (num + den))
                fine = (c2 != c[None, :]) & (n[None, :] * den >= n2 * num) & (n2 * den >= n[None, :] * num) & (apart <= both - 2 * least)
                i, j = np.nonzero(fine)
                if len(i):
                    x, y = r2[i, 0], r[j]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

        for b in batches:
            for g, salt, block, stray, *row in zip(*(b[c].to_pylist() for c in ("g", "salt", "block", "stray", "r", "c", "n", "bits")), strict=True):
                if (g, salt, block) != now:
                    yield from flush()
                    now, rows, odd = (g, salt, block), [], []
                (odd if stray else rows).append(row)
        yield from flush()

    return run


def _dealt(split: DataFrame) -> DataFrame:
    """The members of split groups in blocks of about MEMBERS (``salt``), the strays
    also in theirs (``block``): each block of strays meets each block of members."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("r"), n).cast("int")
    stray = split.filter("c != main").withColumn("block", own("blocks")).withColumn("salt", every("salts")).withColumn("stray", F.lit(True))
    whole = split.withColumn("salt", own("salts")).withColumn("block", every("blocks")).withColumn("stray", F.lit(False))
    return whole.unionByName(stray).select("g", "salt", "block", "stray", "r", "c", "n", "bits")


def linked(docs: DataFrame, k: int = SHINGLE, similar: tuple[int, int] = SIMILAR, buckets: int | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of each row of ``(doc_id, text)``."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = stored(base.mapInArrow(_sets(k), "element boolean, doc_id long, n long, d1 long, d2 long"), "shingle-sets")
    sets = first.filter("not element").drop("element")
    common = common_elements(first.filter("element").select("d1", "n"))
    classes = stored(sets.filter("n > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("r"), F.min("n").alias("n")), "set-classes")
    if buckets is None:  # a bucket is held by one task, so their number grows with the sets
        buckets = max(BUCKETS, -(-(classes.agg(F.sum("n")).first()[0] or 0) // BUCKET_ELEMENTS))
    blobs = base.filter("doc_id is not null").select("text").mapInArrow(_signatures(k, similar, buckets, common), "bucket int, kind int, sigs binary, keys binary")
    groups = blobs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_groups, "g long, d1 long").distinct()
    groups = stored(groups.join(classes, "d1").select("g", "r"), "signature-groups")
    wanted = classes.join(groups.select("r").distinct(), "r", "left_semi")
    sketched = small(wanted).join(base, F.col("r") == F.col("doc_id")).select("r", "n", "d1", "d2", "text").mapInArrow(_sketches(k), "r long, n long, d1 long, bits array<long>, text string")
    sketched = stored(sketched.dropDuplicates(["r", "d1"]), "sketches")
    bits = sketched.select("r", "n", "bits")
    other = bits.select(F.col("r").alias("o"), F.col("n").alias("o_n"), F.col("bits").alias("o_bits"))

    sizes = groups.groupBy("g").agg(F.count("*").alias("size"), F.min("r").alias("lead"))
    rows = groups.join(sizes, "g")
    few = rows.filter(F.col("size") <= ALL_PAIRS)
    pairs = few.select("g", F.col("r").alias("o")).join(few.select("g", "r"), "g").filter("o < r").select("o", "r")
    pairs = pairs.unionByName(rows.filter((F.col("size") > ALL_PAIRS) & (F.col("r") != F.col("lead"))).select(F.col("lead").alias("o"), "r")).distinct()
    pairs = pairs.join(bits, "r").join(other, "o").filter(_may_link(similar)).select(F.col("o").alias("a"), F.col("r").alias("b")).distinct()
    links = stored(verified(stored(pairs, "set-pairs"), sketched, k, similar), "set-links")
    labels = components(links)

    large = rows.filter(F.col("size") > ALL_PAIRS).select("g", "r", "size").join(labels, "r", "left").withColumn("c", F.coalesce("c", "r"))
    by = large.groupBy("g", "c").agg(F.count("*").alias("m"))
    main = by.groupBy("g").agg(F.max(F.struct("m", "c")).alias("top"), F.count("*").alias("parts")).filter("parts > 1").select("g", F.col("top.c").alias("main"), F.col("top.m").alias("most"))
    split = large.join(main, "g").join(bits, "r")
    blocks = [F.ceil(n / MEMBERS).cast("int").alias(c) for c, n in (("salts", F.col("size")), ("blocks", F.col("size") - F.col("most")))]
    split = stored(split.select("*", *blocks), "split-groups")
    if split.limit(1).count():
        dealt = _dealt(split).repartition("g", "salt", "block").sortWithinPartitions("g", "salt", "block")
        more = dealt.mapInArrow(_across(similar), "a long, b long").distinct()
        more = stored(verified(stored(more, "cross-pairs"), sketched, k, similar), "cross-links")
        if more.limit(1).count():
            labels = components(links.unionByName(more))
    named = classes.join(labels, "r", "left").select("d1", "d2", F.coalesce("c", "r").alias("component"))
    out = sets.join(named.withColumnRenamed("d1", "_1").withColumnRenamed("d2", "_2"), (F.col("d1") == F.col("_1")) & (F.col("d2") == F.col("_2")) & (F.col("n") > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, k: int, similar: tuple[int, int]) -> DataFrame:
    """The rows of ``docs`` that are the smallest document of their component
    (all rows with an empty set or without id, and once each id), all columns."""
    found = linked(docs, k, similar)
    d = free("_d", docs)
    keep = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(d)).distinct()
    return docs.join(keep, F.col("doc_id").cast("long") == F.col(d), "left_semi").unionByName(docs.filter("doc_id is null"))
