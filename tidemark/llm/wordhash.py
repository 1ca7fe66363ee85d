"""Words and word-run hashes of a batch of texts, as flat numpy arrays.

A word is a maximal run of bytes other than space, tab, newline, vertical tab,
form feed and carriage return, that is ``[^\\x20\\x09-\\x0D]+`` (all separators
are ASCII, so splitting the UTF-8 bytes and splitting the text agree).

Hashes are 64-bit: of a word of up to seven bytes its bytes and length themselves,
mixed by a bijection, of a longer one BLAKE2b of its bytes; and polynomials over runs of
word hashes modulo 2**64.  (A polynomial over bytes would not do: the words of Thue and
Morse and their complements have one value for every odd base.  Runs are far shorter
than such words.)  They depend on the words alone, so they agree between tasks,
executors and runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are hashed in chunks of about so many bytes (one long text may exceed it).
CHUNK_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_U = np.uint64
_BASES = {"byte": 0x9E3779B97F4A7C15, "gram": 0xD6E8FEB86659FD93, "run": 0xC2B2AE3D27D4EB4F}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads close values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=_U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, b, dtype=_U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS = {k: _Powers(b) for k, b in _BASES.items()}


def _prefix(values: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    up, down = _POWERS[kind].to(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


class _Long(dict):
    """Hashes of words of more than ``SHORT`` bytes, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            if len(self) >= 100_000:
                self.clear()
            self[word] = h
        return h


_LONG = _Long()
SHORT = 7


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words ``data[start[i]:end[i]]``."""
    if not len(start):
        return np.zeros(0, dtype=_U)
    size = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[start]
    value = np.ascontiguousarray(eight).view("<u8").ravel()
    kept = np.minimum(size, SHORT).astype(_U)
    out = mix(value & ((_U(1) << kept * _U(8)) - _U(1)) | kept << _U(56))
    long = np.flatnonzero(size > SHORT)
    if len(long):
        raw = data.tobytes()
        words = map(raw.__getitem__, map(slice, start[long].tolist(), end[long].tolist()))
        out[long] = np.fromiter(map(_LONG.__getitem__, words), _U, len(long))
    return out


class Words:
    """The words of a chunk of rows.  Row ``r`` has words ``first[r]`` to
    ``first[r + 1]``; word ``w`` is ``data[start[w]:end[w]]`` and hashes to
    ``hash[w]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool) -> None:
        self.data = _LOWER[data] if lower else data
        n = len(data)
        solid = ~_SPACE[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = solid[:-1]
        self.start = np.flatnonzero(solid & (~before | edge[:n]))
        after = np.empty(n, dtype=bool)
        if n:
            after[-1] = False
            after[:-1] = solid[1:]
        self.end = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = word_hashes(self.data, self.start, self.end)

    @property
    def rows(self) -> int:
        return len(self.first) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.first))

    def grams(self, k: int, kind: str = "gram") -> np.ndarray:
        """Hash of the ``k`` words from each word on (runs may cross rows)."""
        if len(self.hash) < k:
            return np.zeros(0, dtype=_U)
        sums, down = _prefix(self.hash, kind)
        return mix((sums[k:] - sums[:-k]) * down[: len(self.hash) - k + 1])

    def runs(self, lo: np.ndarray, hi: np.ndarray, kind: str = "run") -> np.ndarray:
        """Hash of the words ``lo[i]`` to ``hi[i]`` (exclusive)."""
        sums, down = _prefix(self.hash, kind)
        return mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(_U))

    def text(self, lo: int, hi: int) -> bytes:
        """Words ``lo`` to ``hi`` (exclusive), joined by one space."""
        return self.data[self.start[lo] : self.end[hi - 1]].tobytes() if hi > lo else b""


def chunks(texts: pa.Array, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[tuple[int, Words]]:
    """(first row, words) of consecutive rows; a null text has no words."""
    texts = texts.cast(pa.large_string())
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    valid = np.asarray(texts.is_valid())
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size)))
        hi = min(hi, len(texts))
        part = data[offsets[lo] : offsets[hi]]
        words = Words(part, offsets[lo : hi + 1] - offsets[lo], lower)
        if not valid[lo:hi].all():  # a null may still span bytes
            keep = np.repeat(valid[lo:hi], np.diff(words.first))
            counts = np.where(valid[lo:hi], np.diff(words.first), 0)
            words.start, words.end, words.hash = words.start[keep], words.end[keep], words.hash[keep]
            words.first = np.concatenate([[0], np.cumsum(counts)])
        yield lo, words
        lo = hi
