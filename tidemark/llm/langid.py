"""Operator 7, language identification with a bidirectional gated recurrent
network over bytes, trained in numpy by backpropagation through time.

A text is cut into blocks of ``BLOCK`` bytes.  A gated recurrent unit runs over
each block from either end; the two states of a position give the language
probabilities of that position, and a document's probabilities are their mean
over all positions of all blocks.  Gates use x / (1 + |x|) in place of tanh.

The net learns from a bounded sample: per language the first ``SAMPLE`` documents
by a hash of their id, among those that may train.  Every text is labelled whole.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text if nothing may train; ties go to the language first by name;
repeated rows and null ids stay (a null id is not held out and never trains); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HIDDEN = 8
BLOCK = 256
SAMPLE = 400
#: At most so many bytes, from random places, are learned from a sampled document.
EXCERPTS, EXCERPT = 8, 96
STEPS, BATCH, RATE = 300, 256, 0.02
UNKNOWN = "und"
#: Blocks that a task labels at a time.
TOGETHER = 2048


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) + np.float32(0.5) * _soft(x)


def _slope(y: np.ndarray) -> np.ndarray:
    """Derivative of ``_soft`` where it has the value y."""
    return np.square(1 - np.abs(y))


class Net:
    def __init__(self, n_out: int, hidden: int = HIDDEN, seed: int = 1) -> None:
        r = np.random.default_rng(seed)
        draw = lambda *s, scale: r.normal(0, scale, s).astype(np.float32)
        self.h = hidden
        self.p = {"out": draw(2 * hidden, n_out, scale=0.3), "bias": np.zeros(n_out, np.float32)}
        for d in "fb":
            self.p |= {f"in_{d}": draw(256, 3 * hidden, scale=0.5), f"re_{d}": draw(hidden, 3 * hidden, scale=0.3)}

    def _run(self, x: np.ndarray, there: np.ndarray, d: str, keep: bool = False):  # noqa: ANN202
        """States (time, block, hidden) of one direction; x and there are (time, block)."""
        n, h = self.h, np.zeros((x.shape[1], self.h), np.float32)
        w_in, w_re = self.p[f"in_{d}"], self.p[f"re_{d}"]
        states, tape = np.empty((*x.shape, n), np.float32), []
        full = there.all(1)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            a, b = w_in[x[t]], h @ w_re
            g = _gate(a[:, : 2 * n] + b[:, : 2 * n])
            z, r = g[:, :n], g[:, n:]
            c = _soft(a[:, 2 * n :] + r * b[:, 2 * n :])
            new = c + z * (h - c)
            if not full[t]:
                new = np.where(there[t][:, None], new, h)
            if keep:
                tape.append((t, h, z, r, c, b[:, 2 * n :]))
            states[t] = h = new
        return states, tape

    def positions(self, x: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Language probabilities of every position, (time, block, language)."""
        s = np.concatenate([self._run(x, there, d)[0] for d in "fb"], axis=2)
        e = s @ self.p["out"] + self.p["bias"]
        e = np.exp(e - e.max(2, keepdims=True))
        return e / e.sum(2, keepdims=True)

    def gradients(self, x: np.ndarray, there: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of all positions, by backpropagation through time."""
        n, g = self.h, {k: np.zeros_like(v) for k, v in self.p.items()}
        runs = {d: self._run(x, there, d, keep=True) for d in "fb"}
        s = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        e = s @ self.p["out"] + self.p["bias"]
        e = np.exp(e - e.max(2, keepdims=True))
        e /= e.sum(2, keepdims=True)
        e[:, np.arange(x.shape[1]), y] -= 1
        e *= (there / max(1, there.sum()))[:, :, None].astype(np.float32)
        g["out"], g["bias"] = np.tensordot(s, e, ((0, 1), (0, 1))), e.sum((0, 1))
        ds = e @ self.p["out"].T
        for k, d in enumerate("fb"):
            dh = np.zeros((x.shape[1], n), np.float32)
            re = self.p[f"re_{d}"]
            for t, h, z, r, c, bc in reversed(runs[d][1]):
                on = there[t][:, None].astype(np.float32)
                total = dh + ds[t, :, k * n : (k + 1) * n]
                dnew, held = total * on, total * (1 - on)
                dc = dnew * (1 - z) * _slope(c)
                dz = dnew * (h - c) * np.float32(0.5) * _slope(2 * z - 1)
                dr = dc * bc * np.float32(0.5) * _slope(2 * r - 1)
                da = np.concatenate([dz, dr, dc], axis=1)
                db = np.concatenate([dz, dr, dc * r], axis=1)
                np.add.at(g[f"in_{d}"], x[t], da)
                g[f"re_{d}"] += h.T @ db
                dh = held + dnew * z + db @ re.T
        return g

    def fit(self, blocks: np.ndarray, there: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 2) -> None:
        """Adam, with batches that draw the languages evenly."""
        r = np.random.default_rng(seed)
        own = [np.flatnonzero(y == k) for k in range(int(y.max()) + 1)]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        for step in range(1, steps + 1):
            at = np.concatenate([r.choice(o, max(1, batch // len(own))) for o in own if len(o)])
            g = self.gradients(blocks[at].T, there[at].T, y[at])
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, x in g.items():
                x = x * np.float32(min(1.0, 1.0 / (norm + 1e-9)))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.999 * v[k] + 0.001 * x * x
                self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, may_train: Column, size: int = SAMPLE) -> list[tuple[str, bytes]]:
    """Excerpts ``(lang, bytes)`` of at most ``size`` documents per language."""
    rows = docs.filter(may_train & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", "text")
    # one text for each (id, language), however often its row is repeated
    ids = rows.groupBy(F.col("doc_id").alias("_d"), F.col("lang").alias("_l")).agg(F.min(F.xxhash64("text")).alias("_t"))
    ids = ids.withColumn("_h", F.xxhash64(F.col("_d").cast("string")))
    # the first of each part of a language, and of these the first of all: no task holds a language
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ids = ids.withColumn("_p", F.pmod("_h", F.lit(parts)))
    for group in (["_l", "_p"], ["_l"]):
        order = Window.partitionBy(*group).orderBy("_h", "_d")
        ids = ids.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= size).drop("_n")
    same = (F.col("doc_id") == F.col("_d")) & (F.col("lang") == F.col("_l")) & (F.xxhash64("text") == F.col("_t"))
    # at most ``size`` ids for each language
    chosen = rows.join(F.broadcast(ids.select("_d", "_l", "_t")), same).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for d, lang, text in zip(b["doc_id"].to_pylist(), b["lang"].to_pylist(), b["text"].cast(pa.large_binary()).to_pylist(), strict=True):
                r = np.random.default_rng(abs(int(d)))
                for at in sorted(r.integers(0, max(1, len(text) - EXCERPT), EXCERPTS)) if len(text) > EXCERPT else [0]:
                    out.append((d, lang, int(at), text[at : at + EXCERPT]))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate((pa.int64(), pa.string(), pa.int64(), pa.binary()))], names=["doc_id", "lang", "at", "text"])

    got = chosen.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").mapInArrow(cut, "doc_id long, lang string, at long, text binary")
    # at most size * EXCERPTS excerpts of EXCERPT bytes per language reach the driver
    return [(r.lang, bytes(r.text)) for r in sorted(got.collect(), key=lambda r: (r.lang, r.doc_id, r.at, bytes(r.text)))]


def train(excerpts: list[tuple[str, bytes]]) -> tuple[list[str], Net | None]:
    langs = sorted({x for x, _ in excerpts})
    if not langs:
        return [], None
    blocks = np.zeros((len(excerpts), EXCERPT), np.uint8)
    there = np.zeros((len(excerpts), EXCERPT), bool)
    for i, (_, text) in enumerate(excerpts):
        blocks[i, : len(text)] = np.frombuffer(text, np.uint8)
        there[i, : len(text)] = True
    net = Net(len(langs))
    net.fit(blocks, there, np.array([langs.index(x) for x, _ in excerpts]))
    return langs, net


def pooled(net: Net, texts: list[bytes]) -> np.ndarray:
    """Mean language probabilities of each text (all of its positions)."""
    total = np.zeros((len(texts), len(net.p["bias"])))
    cuts = [(i, a) for i, t in enumerate(texts) for a in range(0, len(t), BLOCK)]
    for lo in range(0, len(cuts), TOGETHER):
        part = cuts[lo : lo + TOGETHER]
        whole = b"".join(texts[i][a : a + BLOCK].ljust(BLOCK, b"\0") for i, a in part)
        size = np.array([min(BLOCK, len(texts[i]) - a) for i, a in part])
        x = np.frombuffer(whole, np.uint8).reshape(len(part), BLOCK)[:, : size.max()]
        there = np.arange(x.shape[1]) < size[:, None]
        p = np.einsum("tbl,tb->bl", net.positions(np.ascontiguousarray(x.T), np.ascontiguousarray(there.T)), there.T.astype(np.float32))
        np.add.at(total, [i for i, _ in part], p)
    return total / np.maximum(1, [[len(t)] for t in texts])


def _predict(langs: list[str], net: Net | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].cast(pa.large_binary()).to_pylist()
            use = [i for i, ok in enumerate(b["letters"].to_pylist()) if ok and net is not None]
            names, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            lo = 0
            while lo < len(use):  # by about TOGETHER blocks at a time
                hi, n = lo, 0
                while hi < len(use) and (hi == lo or n < TOGETHER * BLOCK):
                    n += len(texts[use[hi]])
                    hi += 1
                p = np.round(pooled(net, [texts[i] for i in use[lo:hi]]), 6)
                for i, k in zip(use[lo:hi], p.argmax(1), strict=True):
                    names[i] = langs[k]
                for i, s in zip(use[lo:hi], p.max(1), strict=True):
                    score[i] = float(min(1.0, s))
                lo = hi
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, langs: list[str], net: Net | None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of each row of ``(doc_id, text)``."""
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"), letters.alias("letters"))
    return rows.mapInArrow(_predict(langs, net), "doc_id long, held_out boolean, lang_pred string, score double")
