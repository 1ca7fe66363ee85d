"""Operator 5, exact top-k search with multi-resolution segment statistics.

Vectors are quantised to integers and cut into segments.  With mean m and
deviation s of a segment of length L, Cauchy and Schwarz give

    q . x  <=  sum over segments of  L * (mq * mx + sq * sx)

(the same bound, turned round, is a lower bound of the Euclidean distance).  It
is evaluated coarse to fine for each pair: a few long segments first, then short ones for
what is left, then exact inner products for the survivors.  A candidate goes only if
its bound is below the query's k-th best score so far, so the result is exact.

Queries and rows are packed into blocks.  Query blocks are copied once to each of
``groups`` groups of candidate blocks and meet them in an equi-join; a task holds
one pair of blocks and the best k of one query block at a time.  Each group
returns at most k rows per query, which are ranked once more.

Defined results: vectors that are null, or hold a null, NaN or infinite
component, and rows without id take no part; vectors of unequal length do not
meet; a row never meets a row of its own id; of query rows with the same id the
smallest vector counts; equal candidate rows are all ranked; score ties go to the
smaller id; an empty table gives no rows.  Scores outside the range of a long are
clipped to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024
#: Segments of the levels, coarse to fine.
LEVELS = (4, 16, 32)
#: Share of a block's pairs up to which survivors are scored one query at a time.
FEW = 0.125
#: Groups of candidates: so many at least, and one for so many rows.
GROUPS, GROUP_ROWS = 32, 64 * BLOCK
_BLOCKS = "dim int, wide boolean, ids binary, vecs binary"
_HITS = "query_id long, vec_id long, score long"
_MAX = float(1 << 53)


def _packed(scale: float):
    whole = Fraction(scale)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}

        def out(dim: int, rows: list) -> pa.RecordBatch:
            ids = np.array([r[0] for r in rows], dtype=np.int64)
            m = np.stack([r[1] for r in rows]) if dim else np.zeros((len(rows), 0))
            wide = bool(m.size) and not float(np.abs(m).max()) * scale < 2**30
            if wide:  # exact, as the scaled value may be no double
                body = "\n".join(" ".join(str(math.floor(Fraction(x) * whole)) for x in r) for r in m.tolist()).encode()
            else:
                body = np.floor(m * scale).astype(np.int32).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([wide]), pa.array([ids.tobytes()], pa.binary()), pa.array([body], pa.binary())], names=["dim", "wide", "ids", "vecs"])

        for batch in batches:
            ids, lists = batch["vec_id"], batch["embedding"]
            offsets = lists.offsets.to_numpy()
            values = lists.values
            flat = values.cast(pa.float64()).to_numpy(zero_copy_only=False)
            fine = np.isfinite(flat) & np.asarray(values.is_valid())
            flat = np.where(fine, flat, 0.0)
            bad = np.concatenate([[0], np.cumsum(~fine)])
            there = np.asarray(lists.is_valid()) & np.asarray(ids.is_valid())
            for i, vid in enumerate(ids.to_pylist()):
                a, b = offsets[i], offsets[i + 1]
                if there[i] and bad[b] == bad[a]:
                    rows = kept.setdefault(int(b - a), [])
                    rows.append((vid, flat[a:b]))
                    if len(rows) == BLOCK:
                        yield out(int(b - a), kept.pop(int(b - a)))
        for dim, rows in kept.items():
            yield out(dim, rows)

    return pack


def _unpack(dim: int, wide: bool, ids: bytes, vecs: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, dtype=np.int64)
    if wide:  # integers beyond 2**31, kept exact as Python integers
        m = np.array([[int(x) for x in r.split()] for r in vecs.split(b"\n")], dtype=object).reshape(len(i), dim)
    else:
        m = np.frombuffer(vecs, dtype=np.int32).reshape(len(i), dim).astype(np.float64)
    return i, m


def _bounds(m: np.ndarray, segments: int) -> np.ndarray:
    """Scaled means and deviations: a product of two rows of them bounds the
    inner product of the vectors from above."""
    parts = np.array_split(np.asarray(m, dtype=np.float64), min(segments, max(1, m.shape[1])), axis=1)
    root = [np.sqrt(p.shape[1]) for p in parts]
    return np.column_stack([r * p.mean(1) for r, p in zip(root, parts, strict=True)] + [r * p.std(1) for r, p in zip(root, parts, strict=True)])


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products as int64 (clipped)."""
    if q.dtype == object or c.dtype == object or np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1] >= _MAX:
        whole = lambda m: m if m.dtype == object else m.astype(np.int64).astype(object)
        out = whole(q) @ whole(c).T
        return np.clip(out, -(1 << 63), (1 << 63) - 1).astype(np.int64)
    return (q @ c.T).astype(np.int64)


class _Best:
    """The best k of each query of one block, over the blocks seen so far."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, k: int, levels: tuple[int, ...]) -> None:
        self.ids, self.m, self.k, self.levels = ids, m, k, levels
        self.score: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.stats = [_bounds(m, s) for s in levels] if m.shape[1] and m.dtype != object else []

    def floor(self) -> np.ndarray:
        return np.array([float(s[-1][0]) * -1 if len(s) == self.k else -np.inf for s in self.score])

    def add(self, ids: np.ndarray, m: np.ndarray) -> None:
        rows = np.arange(len(ids))
        floor = self.floor()
        active = np.ones((len(self.ids), len(rows)), dtype=bool)
        # integers beyond the range of a double have no bounds
        if np.isfinite(floor).any() and m.dtype != object:
            for mine, level in zip(self.stats, self.levels, strict=False):
                theirs = _bounds(m[rows], level)
                bound = mine @ theirs.T
                slack = 1e-6 + 1e-9 * np.abs(bound)
                active = active & (bound + slack >= floor[:, None])
                alive = active.any(0)
                rows, active = rows[alive], active[:, alive]
                if not len(rows):
                    return
        # one product of the blocks is cheaper than many small ones until few pairs are left
        few = active.mean() <= FEW
        scores = None if few else _exact(self.m, m[rows])
        got = ids[rows]
        for i in np.flatnonzero(active.any(1)):
            at = np.flatnonzero(active[i] & (got != self.ids[i]))
            own = _exact(self.m[i : i + 1], m[rows[at]])[0] if few else scores[i][at]
            if np.isfinite(floor[i]):
                at, own = at[own >= floor[i]], own[own >= floor[i]]
            if len(at) > self.k:
                cut = np.partition(own, len(at) - self.k)[len(at) - self.k]
                at, own = at[own >= cut], own[own >= cut]
            if len(at):
                new = [(-int(s), int(v)) for s, v in zip(own, got[at], strict=True)]
                self.score[i] = sorted(self.score[i] + new)[: self.k]

    def out(self) -> pa.RecordBatch | None:
        rows = [(int(q), v, -s) for q, best in zip(self.ids, self.score, strict=True) for s, v in best]
        if not rows:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["query_id", "vec_id", "score"])


def _search(k: int, levels: tuple[int, ...]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                x = {n: batch[n][r].as_py() for n in batch.schema.names}
                if x["q_ids"] != now:
                    if best is not None and (b := best.out()) is not None:
                        yield b
                    now, best = x["q_ids"], _Best(*_unpack(x["dim"], x["q_wide"], x["q_ids"], x["q_vecs"]), k, levels)
                best.add(*_unpack(x["dim"], x["wide"], x["ids"], x["vecs"]))
        if best is not None and (b := best.out()) is not None:
            yield b

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, levels: tuple[int, ...] = LEVELS, groups: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` over ``(vec_id, embedding)``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    if groups is None:
        groups = max(GROUPS, -(-rows.count() // GROUP_ROWS))
    queries = vectors.filter(is_query).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    usable = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    queries = queries.filter(usable).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    pack = _packed(scale)
    q = queries.mapInArrow(pack, _BLOCKS).select("dim", F.col("wide").alias("q_wide"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"))
    q = q.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    c = rows.mapInArrow(pack, _BLOCKS).withColumn("g", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
    met = q.hint("merge").join(c, ["dim", "g"]).select("dim", "q_wide", "q_ids", "q_vecs", "wide", "ids", "vecs")
    hits = met.mapInArrow(_search(k, levels), _HITS)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
