"""Operator 11, suffix-array dedup by distributed prefix doubling.

Texts are UTF-8 bytes.  A window is ``WINDOW`` bytes of one text; every byte goes that
a window covers which also starts at any other place of any text.

1. Positions.  Of the ``GRAM``-byte strings at ``GAP`` neighbouring places the one of
   least hash (the first of equal ones) is an anchor, and a window's anchor is that of
   its first places: equal windows have equal anchors.  Only anchors, one in about
   ``GAP`` / 2 bytes, are positions to sort.  From an anchor a chain goes on: the next
   link is the anchor of the following place, so a chain depends on what follows alone.
2. Doubling.  The first rank of a position is that of its link's bytes.  In each round
   the pairs (rank of a position, rank of the position 2^k links on) are sorted by
   Spark over ranges; equal pairs get the place of the first as their new rank.  A
   position goes when its rank is its own alone, and is past the threshold when twice
   the links would leave the bytes that all windows of its anchor have.
3. Contexts.  What is past the threshold shares a rank with others.  The bytes of all
   windows of such an anchor are one string; these are sorted in the same way, by digests
   of the bytes that all windows of an anchor have and of the string.  Windows of equal
   strings are repeated.
4. Windows.  Where strings differ but share the bytes that all windows have, each gives
   its windows, one string of equal ones, and the windows are sorted by digest (128 bits
   of all their bytes): equal neighbours are repeated.

A sort deals out rows by range of (key, row, place), so equal keys, however many, spread
over tasks; ranks go on over a task's end by a table with one row for each task.
Texts meet their positions by row number; a task holds one text at a time and streams
the rest.

Defined results: a null text is empty; texts below ``WINDOW`` bytes lose nothing;
repeated rows are texts of their own, so equal texts of ``WINDOW`` bytes or more lose
all; ids may be null or equal; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucketed, dropped, stored
from .wordhash import _BYTE_VALUE, _prefix, mix

WINDOW, GAP, GRAM = 400, 124, 16
#: Texts are cut into positions some at a time, of about so many bytes.
CHUNK_BYTES = 1 << 18
#: Of a longer text so many bytes are cut into positions at a time.
LONG_BYTES = 1 << 23
#: Fields of a place: position, doublings, bytes to the link, and bytes back to the first
#: and the last window of the anchor (``NO_WINDOW``: it has none).
FIELDS = {"at": 27, "k": 23, "to": 14, "lo": 7, "hi": 0}
NO_WINDOW = 127
#: Anchors are found in blocks of so many places; the low bits of a hash give way to its
#: place in the block.
BLOCK, PLACE_BITS = 1 << 15, 16

_U = np.uint64
_PLACE = _U((1 << PLACE_BITS) - 1)
_PLACES = np.arange(1 << PLACE_BITS, dtype=_U)


def _field(place: Column, name: str) -> Column:
    bits = {"at": 31, "k": 4, "to": 9, "lo": 7, "hi": 7}[name]
    return F.shiftright(place, FIELDS[name]).bitwiseAND((1 << bits) - 1)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(texts):
        hi = min(len(texts), max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES))))
        yield lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def _anchors(sums: np.ndarray, down: np.ndarray, gap: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The places from which on the anchor is another one, and these anchors.  Hashes are
    compared by the bits above ``PLACE_BITS``, the first of equal ones is least; a block of
    places at a time, as it then stays in the processor's cache."""
    starts, anchors, n = [], [], len(sums) - gram - gap + 1
    for lo in range(0, n, BLOCK):
        m = min(n, lo + BLOCK) - lo
        end = lo + m + gap - 1
        best = mix((sums[lo + gram : end + gram] - sums[lo:end]) * down[lo:end]) & ~_PLACE | _PLACES[: end - lo]
        have = 1
        while have < gap:
            step = min(have, gap - have)
            best = np.minimum(best[:-step], best[step:])
            have += step
        best = (best & _PLACE).view(np.int64)
        new = np.concatenate([[0], np.flatnonzero(best[1:] != best[:-1]) + 1])
        starts.append(new + lo)
        anchors.append(best[new] + lo)
    starts, anchors = np.concatenate(starts), np.concatenate(anchors)
    # an anchor may go on in the next block
    new = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    return starts[new], anchors[new]


def positions(data: np.ndarray, offsets: np.ndarray, window: int, gap: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, name) of the anchors of some texts; ``name`` is a hash of the bytes
    of an anchor's link."""
    need = gap + gram - 1
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none, none, none
    sums, down = _prefix(_BYTE_VALUE[data], "byte")
    first, at = _anchors(sums, down, gap, gram)
    last = np.append(first[1:], len(data) - need + 1) - 1
    # an anchor is that of places of its own text
    row = np.searchsorted(offsets, at, "right") - 1
    first, last = np.maximum(first, offsets[row]), np.minimum(last, offsets[row + 1] - need)
    ok = np.flatnonzero((first <= last) & (np.diff(offsets)[row] >= window))
    if not len(ok):
        return none, none, none
    first, last, at, row = first[ok], last[ok], at[ok], row[ok]
    end = offsets[row + 1]
    last = np.minimum(last, end - window)
    # the link: the anchor of the following place
    link = np.full(len(at), -1)
    ok = np.flatnonzero(at + 1 + need <= end)
    link[ok] = np.searchsorted(first, at[ok] + 1, "right") - 1
    to = np.where(link >= 0, at[link], at)
    # doublings: the last of 2^k links must begin where all windows know what follows
    k = np.where(link >= 0, 0, -1)
    room = window - gap + 1 - need - 1
    jump, tail = link, at
    for step in range(15):
        s = np.flatnonzero(k == step)
        u = jump[s]
        s = s[(k[u] >= step) & (tail[u] - at[s] <= room)]
        if not len(s):
            break
        u = jump[s]
        jump, tail, old_jump, old_tail = np.full(len(at), -1), at.copy(), jump, tail
        jump[s], tail[s] = old_jump[u], old_tail[u]
        k[s] = step + 1
    keep = np.flatnonzero(k >= 0)
    row, at, first, last, to, k = row[keep], at[keep], first[keep], last[keep], to[keep], k[keep]
    name = mix((sums[to] - sums[at]) * down[at] + (to - at).astype(_U))
    lo = np.where(first <= last, at - first, NO_WINDOW)
    hi = np.where(first <= last, at - last, 0)
    place = (at - offsets[row]) << FIELDS["at"] | k << FIELDS["k"] | (to - at) << FIELDS["to"] | lo << FIELDS["lo"] | hi
    return row, place, name.view(np.int64)


def _stretches(data: np.ndarray, offsets: np.ndarray, window: int, gap: int, gram: int, most: int = LONG_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``positions``, those of a very long text some at a time: what an anchor needs lies
    less than ``gap`` before and less than two windows and a gap after it."""
    n, lo = len(data), 0
    if n <= most + 4 * window or len(offsets) > 2:
        found = positions(data, offsets, window, gap, gram)
        if len(found[0]):
            yield found
        return
    while lo < n:
        hi = lo + most if n - lo > most + 4 * window else n
        begin = max(0, lo - gap)
        part = data[begin : min(n, hi + 3 * window)]
        row, place, name = positions(part, np.array([0, len(part)]), window, gap, gram)
        at = (place >> FIELDS["at"]) + begin
        own = (at >= lo) & (at < hi)
        if own.any():
            yield row[own], place[own] + (begin << FIELDS["at"]), name[own]
        lo = hi


def _positions(window: int, gap: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["row"].to_numpy()
            for lo, data, offsets in _chunks(batch["text"]):
                for row, place, name in _stretches(data, offsets, window, gap, gram):
                    yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(ids[lo + row]), pa.array(place)], names=["k1", "row", "place"])

    return run


def _ranks(keys: list[str], classes: int):
    """Sorted rows in; out each row that shares its keys with a neighbour, with the
    place of the first of these in the task (``start``).  Of others only those at a
    task's ends come out, as their neighbours may be in the next task; with
    ``classes``, also those whose first ``classes`` keys others have.  ``head`` is the
    first row of equal keys, ``several`` says that its class has other keys too (or
    may have, at a task's ends).  A last row describes the task."""

    names = ["row", "place", "start", "task", "single", "head", "several", "task_ends"]

    def pack(task: int, row, place, start, single, head, several) -> pa.RecordBatch:
        n = len(row)
        cols = [pa.array(row), pa.array(place), pa.array(start), pa.array(np.full(n, task, np.int32)), pa.array(single), pa.array(head), pa.array(several)]
        return pa.RecordBatch.from_arrays([*cols, pa.nulls(n, pa.list_(pa.int64()))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        base = size = first_size = 0
        first_key = key = held = None
        start = class_start = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            k = np.stack([batch[c].to_numpy() for c in keys])
            row, place = batch["row"].to_numpy(), batch["place"].to_numpy()
            before = np.concatenate([k[:, :1] if key is None else key[:, None], k[:, :-1]], axis=1)
            differs = k != before
            new, new_class = differs.any(axis=0), differs[: max(classes, 1)].any(axis=0)
            if key is None:
                new[0] = new_class[0] = True
                first_key = k[:, 0]
            idx = base + np.arange(n)
            starts = np.maximum.accumulate(np.where(new, idx, start))
            class_starts = np.maximum.accumulate(np.where(new_class, idx, class_start))
            heads = np.flatnonzero(new)
            # the head of the last group so far waits until its group ends
            if held is not None and len(heads):
                size += int(heads[0])
                single = size == 1
                several = start > class_start or not new_class[heads[0]] or class_start == 0
                if start == 0:
                    first_size = size
                if not single or start == 0 or (classes and several):
                    yield pack(task, *([x] for x in held), [single], [True], [several])
            elif held is not None:
                size += n
            if len(heads):
                ends = np.append(heads[1:], n)
                sizes = ends - heads
                h = heads[:-1]
                if heads[0] == 0 and base == 0 and len(h):
                    first_size = int(sizes[0])
                single = sizes[:-1] == 1
                several = (starts[h] > class_starts[h]) | ~new_class[heads[1:]] | (class_starts[h] == 0)
                out = ~single | (idx[h] == 0) | (several if classes else False)
                h, single, several = h[out], single[out], several[out]
                if len(h):
                    yield pack(task, row[h], place[h], starts[h], single, np.ones(len(h), bool), several)
                t = heads[-1]
                held = (row[t], place[t], starts[t])
                size = n - int(t)
            rest = np.flatnonzero(~new)
            if len(rest):
                no = np.zeros(len(rest), bool)
                yield pack(task, row[rest], place[rest], starts[rest], no, no, no)
            start, class_start, key, base = int(starts[-1]), int(class_starts[-1]), k[:, -1], base + n
        if held is not None:
            if start == 0:
                first_size = size
            yield pack(task, *([x] for x in held), [size == 1], [True], [True])
            ends = [base, first_size, start, size, *map(int, first_key), *map(int, key)]
            nothing = [pa.nulls(1, pa.int64())] * 3
            flags = [pa.nulls(1, pa.bool_())] * 3
            yield pa.RecordBatch.from_arrays([*nothing, pa.array([task], pa.int32()), *flags, pa.array([ends], pa.list_(pa.int64()))], names=names)

    return run


#: One row for each task of a sort, an Arrow table as it needs no Python tasks.
_ENDS = pa.schema([("task", pa.int32()), *((c, pa.int64()) for c in ("offset", "first", "last", "last_start")), *((c, pa.bool_()) for c in ("first_alone", "last_alone"))])


def ranked(rows: DataFrame, keys: list[str], name: str, classes: int = 0) -> tuple[DataFrame, DataFrame]:
    """``rows`` of ``keys``, ``row`` and ``place`` sorted by all of these; those that
    share their keys with another: ``(row, place, rank, single, head, several)``, with the
    place in the order of the first of equal keys as their rank; and the stored table
    behind them.  With ``classes`` also single rows that share their first ``classes``
    keys (see ``_ranks``)."""
    spark = rows.sparkSession
    order = [*keys, "row", "place"]
    kind = "row long, place long, start long, task int, single boolean, head boolean, several boolean, task_ends array<bigint>"
    local = rows.select(order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_ranks(keys, classes), kind)
    local = stored(local, name)
    # one row for each task of the sort
    tasks = sorted((r.task, r.task_ends) for r in local.filter("task_ends is not null").select("task", "task_ends").collect())
    offset, table, totals = 0, [], {}
    last_key = last_rank = None
    m = len(keys)
    for task, (n, first_size, last_start, last_size, *both) in tasks:
        first = last_rank if both[:m] == last_key else offset
        last = first if last_start == 0 else offset + last_start
        totals[first] = totals.get(first, 0) + first_size
        if last_start:
            totals[last] = totals.get(last, 0) + last_size
        table.append((task, offset, first, last, last_start))
        last_key, last_rank, offset = both[m:], last, offset + n
    table = [(*t, totals[t[2]] == 1, totals[t[3]] == 1) for t in table]
    ends = spark.createDataFrame(pa.Table.from_pylist([dict(zip(_ENDS.names, t, strict=True)) for t in table], _ENDS))
    found = local.filter("task_ends is null").join(F.broadcast(ends), "task")
    at_first, at_last = F.col("start") == 0, F.col("start") == F.col("last_start")
    rank = F.when(at_first, F.col("first")).when(at_last, F.col("last")).otherwise(F.col("offset") + F.col("start"))
    alone = F.when(at_first, F.col("first_alone")).when(at_last, F.col("last_alone")).otherwise(F.col("single"))
    found = found.select("row", "place", rank.alias("rank"), alone.alias("single"), "head", "several")
    return found if classes else found.filter("not single"), local


def _pairs(step: int):
    """``(row, place, rank)`` by row and place; out the ranks of each position and of
    the one 2^step links on, with the place's link doubled."""

    def split(row, place, rank, done: int):
        at = place >> FIELDS["at"]
        to = place >> FIELDS["to"] & 511
        number = np.cumsum(np.concatenate([[0], row[1:] != row[:-1]]))
        key = number << 32 | at
        s = np.flatnonzero((place >> FIELDS["k"] & 15) > step)
        s = s[s < done] if done < len(row) else s
        u = np.searchsorted(key, key[s] + to[s])
        ok = (u < len(key)) & (key[np.minimum(u, len(key) - 1)] == key[s] + to[s])
        s, u = s[ok], u[ok]
        goes_on = (place[s] >> FIELDS["k"] & 15) > step + 1
        doubled = np.where(goes_on, to[s] + to[u], 0)
        new = place[s] & ~np.int64(511 << FIELDS["to"]) | doubled << FIELDS["to"]
        return pa.RecordBatch.from_arrays([pa.array(rank[s]), pa.array(rank[u]), pa.array(row[s]), pa.array(new)], names=["k1", "k2", "row", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            cols = [np.concatenate([old, batch[c].to_numpy()]) for old, c in zip(rest, ("row", "place", "rank"), strict=True)]
            row, place, _ = cols
            if not len(row):
                continue
            # links lead on by few bytes: positions whose link may come wait
            at = place >> FIELDS["at"]
            waits = (row == row[-1]) & (at + (place >> FIELDS["to"] & 511) > at[-1])
            done = int(np.flatnonzero(waits)[0]) if waits.any() else len(row)
            if done:
                yield split(*cols, done)
            rest = [c[done:] for c in cols]
        if len(rest[0]):
            yield split(*rest, len(rest[0]))

    return run


def repeated_anchors(base: DataFrame, window: int = WINDOW, gap: int = GAP, gram: int = GRAM) -> tuple[DataFrame, list[DataFrame]]:
    """``(row, place)`` of the anchors with windows whose links others have too, and the
    stored tables that hold them."""
    rows = stored(base.mapInArrow(_positions(window, gap, gram), "k1 long, row long, place long"), "positions")
    keys, found, step, tables = ["k1"], None, 0, []
    while True:
        alike, table = ranked(rows, keys, f"ranks-{step}")
        if not step:
            dropped(rows)
        tables.append(table)
        past = alike.filter((_field(F.col("place"), "k") == step) & (_field(F.col("place"), "lo") != NO_WINDOW))
        past = past.select("row", "place", F.lit(0).cast("long").alias("mark"))
        found = past if found is None else found.unionByName(past)
        more = alike.filter(_field(F.col("place"), "k") > step)
        if not more.limit(1).count():
            return found, tables
        # the positions that others lead to have as many doublings as this round
        own = alike.select("row", "place", "rank").repartition("row").sortWithinPartitions("row", "place")
        rows = own.mapInArrow(_pairs(step), "k1 long, k2 long, row long, place long")
        keys, step = ["k1", "k2"], step + 1


def _digested(window: int, gap: int, each: bool):
    """Digests of the bytes of the anchors asked of a text: of those that all windows of
    such an anchor have, and of all bytes of its windows; or of ``each`` window by itself,
    whose place says whether its string is there once."""
    names = ["k1", "k2", "row", "place"] if each else ["class", "k1", "k2", "row", "place"]
    blake2b, core = hashlib.blake2b, window - gap + 1

    def keys(digests: list[bytes]) -> list[np.ndarray]:
        return list(np.frombuffer(b"".join(digests), np.int64).reshape(len(digests), -1).T)

    def of(i: int, view: memoryview, place: np.ndarray, mark: np.ndarray) -> list[np.ndarray]:
        at = place >> FIELDS["at"]
        lo, hi = at - (place >> FIELDS["lo"] & 127), at - (place & 127)
        if not each:
            known = [blake2b(view[a : a + core], digest_size=8).digest() for a in at.tolist()]
            whole = [blake2b(view[a:b], digest_size=16).digest() for a, b in zip(lo.tolist(), (hi + window).tolist(), strict=True)]
            return [*keys(known), *keys(whole), np.full(len(place), i), place]
        n = hi - lo + 1
        p = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        digests = [blake2b(view[a : a + window], digest_size=16).digest() for a in p.tolist()]
        return [*keys(digests), np.full(len(p), i), p << 1 | np.repeat(mark, n)]

    def pack(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            for row, text, asked in zip(batch["row"], batch["text"].cast(pa.large_binary()), batch["asked"], strict=True):
                i, view = row.as_py(), memoryview(text.as_buffer())
                places, marks = (asked.values.field(c).to_numpy() for c in ("place", "mark"))
                for some in range(0, len(places), 256):
                    parts.append(of(i, view, places[some : some + 256], marks[some : some + 256]))
                    size += len(parts[-1][0])
                    if size > 1 << 15:
                        yield pack(parts)
                        parts, size = [], 0
        if parts:
            yield pack(parts)

    return run


def _asked(base: DataFrame, places: DataFrame) -> DataFrame:
    """Texts with the ``(row, place, mark)`` that are asked of them; these grow with the texts."""
    lists = places.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("place", "mark")).alias("asked"))
    return base.join(lists.hint("merge"), F.col("row") == F.col("_row")).select("row", "text", "asked")


def numbered_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row: ``(row, doc_id, text)``, dealt out by the
    number, so that texts are moved once and positions go to them."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bucketed(stored(rows, "texts"), "row", "texts-by-row")


def repeated_spans(base: DataFrame, window: int = WINDOW, gap: int = GAP, gram: int = GRAM) -> DataFrame:
    """``(row, spans)``: the bytes a to b - 1 of each span of a row are covered by repeated
    windows."""
    if not gap + gram <= (window - gap + 1) or gap >= NO_WINDOW:
        raise ValueError("a window must hold the places of its anchor and of the next link")
    anchors, tables = repeated_anchors(base, window, gap, gram)
    strings = stored(_asked(base, anchors).mapInArrow(_digested(window, gap, False), "class long, k1 long, k2 long, row long, place long"), "contexts")
    dropped(*tables)
    alike, table = ranked(strings, ["class", "k1", "k2"], "context-ranks", classes=1)
    dropped(strings)
    at = _field(F.col("place"), "at")
    whole = alike.filter("not single").select("row", (at - _field(F.col("place"), "lo")).alias("a"), (at - _field(F.col("place"), "hi") + window).alias("b"))
    apart = alike.filter("several and (single or head)").select("row", "place", F.col("single").cast("long").alias("mark"))
    windows = _asked(base, apart).mapInArrow(_digested(window, gap, True), "k1 long, k2 long, row long, place long")
    again, more = ranked(windows, ["k1", "k2"], "window-ranks")
    p = F.shiftright("place", 1)
    spans = whole.unionByName(again.filter(F.col("place").bitwiseAND(1) == 1).select("row", p.alias("a"), (p + window).alias("b")))
    spans = stored(spans.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "byte-spans")
    dropped(table, more)
    return spans


def runs(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The maximal runs that the spans from a to b cover, in order."""
    if not len(a):
        return []
    order = np.argsort(a, kind="stable")
    a, reach = a[order], np.maximum.accumulate(b[order])
    new = np.flatnonzero(np.concatenate([[True], a[1:] > reach[:-1]]))
    ends = reach[np.append(new[1:], len(a)) - 1]
    return list(zip(a[new].tolist(), np.minimum(ends, n).tolist(), strict=True))


def _spans(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x in lists:
        yield tuple(x.values.field(c).to_numpy() for c in "ab") if x.is_valid else (np.zeros(0, np.int64),) * 2


def _kept(text: bytes, removed: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in removed:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def _result(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                texts = [t or b"" for t in b["text"].cast(pa.large_binary()).to_pylist()]
                removed = [runs(*s, len(t)) for s, t in zip(_spans(b["_spans"]), texts, strict=True)]
                kept = [_kept(t, r) for t, r in zip(texts, removed, strict=True)]
                if digest:
                    last = {"kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in kept])}
                else:
                    last = {"removed": pa.array([[{"a": a, "b": e} for a, e in r] for r in removed], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), "kept": pa.array(kept, pa.binary())}
                sizes = {"n_bytes": [len(t) for t in texts], "n_removed": [sum(e - a for a, e in r) for r in removed], "n_spans": [len(r) for r in removed]}
                cols = {"doc_id": b["doc_id"]} | {c: pa.array(v, pa.int64()) for c, v in sizes.items()} | last
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def _with_spans(docs: DataFrame, **options: int) -> DataFrame:
    base = numbered_texts(docs)
    # a merge join at every size: the spans grow with the texts
    side = repeated_spans(base, **options).select(F.col("row").alias("_row"), F.col("spans").alias("_spans")).hint("merge")
    return base.join(side, F.col("row") == F.col("_row"), "left").select("doc_id", "text", "_spans")


def without_repeats(docs: DataFrame, **options: int) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, removed, kept)`` of each row: the removed
    runs, and the bytes that are kept (they may be cut inside a character)."""
    kind = "doc_id long, n_bytes long, n_removed long, n_spans long, removed array<struct<a: bigint, b: bigint>>, kept binary"
    return _with_spans(docs, **options).mapInArrow(_result(False), kind)


def digests(docs: DataFrame, **options: int) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of each row."""
    return _with_spans(docs, **options).mapInArrow(_result(True), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
