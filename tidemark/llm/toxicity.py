"""Operator 3, toxicity by cumulative-link ordinal regression.

Features are sparse and binary: the words of a text and their prefixes of four
and five letters.  With one weight vector w shared by all grades and ordered
thresholds t1 < t2 < ..., the model is

    P(grade >= k) = sigmoid(w . x - t_k)

and the output is the expected severity, the sum of these probabilities.

It is fitted on a bounded sample of labelled documents (``SAMPLE``, the first by
a hash of their id; each class has half of it, or all its documents if they are
fewer, and what one class leaves goes to the other): term counts by class, the ``TERMS`` terms that tell the
classes apart best, then the regression.  Labels say only whether a document is
toxic, so the severity grade of a toxic one is the third it falls into by the
number of telling terms that it has.  A document is toxic from the severity on
that separates the sample best.

Every document is scored, on its whole text.  Defined results: a null or empty
text has no features, and the severity of none; without labels of both classes,
or terms that tell them apart, severity is 0 and nothing is toxic; a document labelled twice counts once, with
the larger label; null ids are scored but never train; repeated rows stay; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

SAMPLE = 12_000
TERMS = 2_000
LEAST_DOCS = 5
#: Least standard score of a term's log odds; what differs by chance only is left out.
LEAST_Z = 3.0
GRADES = 3
PREFIXES = (4, 5)
MEMO = 50_000


def features(word: bytes) -> tuple[str, ...]:
    w = "".join(c for c in word.decode("utf-8", "replace").lower() if c.isalnum())
    return (w, *(w[:n] + "*" for n in PREFIXES if len(w) > n)) if w else ()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class Model:
    terms: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cut: float = float("inf")

    def severity(self, active: list[int]) -> float:
        if not len(self.thresholds):
            return 0.0
        return round(float(_sigmoid(self.weights[active].sum() - self.thresholds).sum()), 6)


class _Finder:
    """Indexes of a text's known terms; remembers up to ``MEMO`` words."""

    def __init__(self, terms: dict[str, int]) -> None:
        self.terms, self.memo = terms, {}

    def __call__(self, text: bytes | None) -> list[int]:
        found: set[int] = set()
        if len(self.memo) > MEMO:
            self.memo.clear()
        for w in set((text or b"").split()):
            got = self.memo.get(w)
            if got is None:
                got = self.memo[w] = tuple(i for f in features(w) if (i := self.terms.get(f)) is not None)
            if got:
                found.update(got)
        return sorted(found)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        terms = list(set(seen[0]) | set(seen[1]))
        out = pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([seen[0][t] for t in terms], pa.int64()), pa.array([seen[1][t] for t in terms], pa.int64())], names=["term", "clean", "toxic"])
        for s in seen:
            s.clear()
        return out

    for batch in slices(batches):
        for text, y in zip(batch["text"].cast(pa.large_binary()).to_pylist(), batch["toxic"].to_pylist(), strict=True):
            seen[y].update({f for w in set((text or b"").split()) for f in features(w)})
            if len(seen[0]) + len(seen[1]) > MEMO:
                yield flush()
    yield flush()


def _active(terms: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _Finder(terms)
        for batch in slices(batches):
            rows = [find(t) for t in batch["text"].cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], pa.array(rows, pa.list_(pa.int32()))], names=["doc_id", "toxic", "terms"])

    return run


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, n_terms: int, steps: int = 400, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the whole sample's mean
    log-likelihood; the gaps between thresholds are exponentials, so they stay
    ordered."""
    n, top = len(rows), int(grades.max())
    doc = np.repeat(np.arange(n), [len(r) for r in rows])
    term = np.array([t for r in rows for t in r], dtype=np.int64)
    p = np.concatenate([np.zeros(n_terms), [0.0], np.zeros(top - 1)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    at = np.arange(n)
    for step in range(1, steps + 1):
        w, gaps = p[:n_terms], np.exp(p[n_terms + 1 :])
        t = p[n_terms] + np.concatenate([[0.0], np.cumsum(gaps)])
        f = np.bincount(doc, weights=w[term], minlength=n)
        above = np.column_stack([np.ones(n), _sigmoid(f[:, None] - t), np.zeros(n)])  # P(grade >= k)
        slope = above * (1 - above)
        prob = np.maximum(above[at, grades] - above[at, grades + 1], 1e-12)
        df = -(slope[at, grades] - slope[at, grades + 1]) / prob / n
        dt = np.zeros((n, top + 2))
        dt[at, grades] += slope[at, grades] / prob / n
        dt[at, grades + 1] -= slope[at, grades + 1] / prob / n
        dt = dt.sum(0)[1:-1]
        g = np.concatenate([np.bincount(term, weights=df[doc], minlength=n_terms) + decay * w, [dt.sum()], gaps * np.cumsum(dt[::-1])[::-1][1:]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    t = p[n_terms] + np.concatenate([[0.0], np.cumsum(np.exp(p[n_terms + 1 :]))])
    return p[:n_terms], t


def best_cut(scores: np.ndarray, toxic: np.ndarray) -> float:
    """Score from which on a document is toxic: best balanced accuracy, in the
    middle of the gap there."""
    order = np.argsort(scores, kind="stable")
    s, y = scores[order], toxic[order].astype(float)
    below = np.concatenate([[0.0], np.cumsum(1 - y)]) / max(1.0, (1 - y).sum())
    missed = np.concatenate([[0.0], np.cumsum(y)]) / max(1.0, y.sum())
    edges = np.concatenate([[s[0] - 1.0], s, [s[-1] + 1.0]])
    free = edges[1:] > edges[:-1]
    worth = np.where(free, below - missed, -np.inf)
    i = int(np.lexsort((edges[1:] - edges[:-1], np.round(worth, 9)))[-1])
    return float((edges[i] + edges[i + 1]) / 2)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: int = TERMS) -> Model:
    """The model from ``(doc_id, text)`` and ``(doc_id, toxic)``."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    known = stored(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labelled")
    # at most ``sample`` rows of each class
    clean, bad = ([tuple(r) for r in known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()] for y in (0, 1))
    bad = bad[: max(sample // 2, sample - len(clean))]
    picked = docs.sparkSession.createDataFrame(bad + clean[: sample - len(bad)], "doc_id long, toxic int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    # one text for each labelled id, however often its row is repeated
    texts = texts.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("k"), "text")).alias("x")).select("doc_id", "toxic", "x.text")
    size = {r.toxic: r["count"] for r in picked.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return Model()
    counts = texts.select("text", "toxic").mapInArrow(_term_counts, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    odds = F.log(t / (size[1] + 1 - t)) - F.log(c / (size[0] + 1 - c))
    z = odds / F.sqrt(1 / t + 1 / c)
    telling = counts.filter(F.col("c") + F.col("t") >= LEAST_DOCS).filter((t < size[1] + 1) & (c < size[0] + 1))
    telling = telling.select("term", F.round(z, 6).alias("z")).filter(F.abs("z") >= LEAST_Z).orderBy(F.desc(F.abs("z")), "term").limit(terms).collect()
    index = {r.term: i for i, r in enumerate(telling)}
    strong = np.array([r.z > 0 for r in telling], dtype=bool)
    found = texts.select("doc_id", "text", "toxic").mapInArrow(_active(index), "doc_id long, toxic int, terms array<int>").collect()
    found = sorted((r.doc_id, r.toxic, list(r.terms)) for r in found)
    toxic = np.array([r[1] for r in found])
    if len(set(toxic.tolist())) < 2 or not index:
        return Model()
    hits = np.array([int(strong[r[2]].sum()) for r in found])
    steps = np.quantile(hits[toxic == 1], [i / GRADES for i in range(1, GRADES)])
    grades = np.where(toxic == 1, 1 + (hits[:, None] > steps).sum(1), 0)
    grades = np.unique(grades, return_inverse=True)[1]  # a grade that no document has is left out
    weights, thresholds = fit_ordinal([r[2] for r in found], grades, len(index))
    model = Model(index, weights, thresholds)
    model.cut = best_cut(np.array([model.severity(r[2]) for r in found]), toxic)
    return model


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _Finder(model.terms)
        for batch in slices(batches):
            s = [model.severity(find(t)) for t in batch["text"].cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(s, pa.float64()), pa.array([x >= model.cut for x in s], pa.bool_())], names=["doc_id", "severity", "toxic"])

    return run


def severities(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, severity, toxic)`` of each row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, severity double, toxic boolean")


def _keep(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _Finder(model.terms)
        for batch in slices(batches):
            s = [model.severity(find(t)) < model.cut for t in batch["text"].cast(pa.large_binary()).to_pylist()]
            yield batch.filter(pa.array(s, pa.bool_()))

    return run


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose severity is below the cut, all columns."""
    return docs.mapInArrow(_keep(model), docs.schema)
