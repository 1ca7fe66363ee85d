"""Shingle sets of texts, and signatures that two similar sets must share.

Sets of x <= y elements whose Jaccard similarity is num / den or more differ in
at most ``(x + y) * (den - num) / (den + num)`` elements, and x >= y * num / den.
If all elements are dealt out to more parts than they differ in, by a hash of the
element, some part is the same in both sets; the sum of a part's hashes is its
signature.  So similar sets share a signature, whatever the data (no sampling).

The number of parts depends on the size, so sizes are put into classes that grow
by den / num: two similar sets are of one class or of neighbouring ones, and a
set gives signatures for its own class and the one below.  Weak parts say little:
an empty part is shared by most sets.  There are ``spare`` parts
more than differences; a set with at most so many weak parts leaves these out,
since more than ``spare`` parts are shared.  A set with more weak parts deals its
elements out once more with another seed; after the last seed it keeps all parts.
A shared part is weak in both sets, so a pair is found at the first seed at which
either of the two stops.  Elements of frequent passages may be named as common:
a part counts by its other elements only.  Any choice of them gives right results
if all sets use the same; a good one keeps groups small.

Small sets that can differ in one element only give the set itself and the set
less each element instead: one set is then the other less one element.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from .wordhash import Words, mix

_U = np.uint64
SEEDS = 5

PART, WHOLE, LESS_ONE = 0, 1, 2


def row_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each row; a row of fewer
    words has its whole sequence, one without words nothing."""
    grams = words.grams(k)
    first = words.first
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < k))
    whole = dict(zip(short.tolist(), words.runs(first[short], first[short + 1]), strict=True))
    for r in range(words.rows):
        n = counts[r]
        if n >= k:
            yield np.unique(grams[first[r] : first[r + 1] - k + 1])
        else:
            yield np.array([whole[r]], dtype=_U) if n else np.zeros(0, dtype=_U)


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name the set, as two signed longs."""
    a, b = mix(s).sum(dtype=_U), mix(s ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=_U)
    two = mix(np.array([a, b], dtype=_U) + _U(len(s))).view(np.int64)
    return int(two[0]), int(two[1])


class Classes:
    """Size classes for similarity num / den."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        self.edges: list[int] = [1]  # edges[j]: least size of class j, ceil((den / num) ** j)
        a = b = 1
        while self.edges[-1] < 1 << 40:
            a, b = a * den, b * num
            self.edges.append(-(-a // b))
        x = 1
        while all(self.most(x, y) <= 1 for y in range(x, x * den // num + 1)):
            x += 1
        #: Sets of up to ``small`` elements differ from similar larger ones in at most one element.
        self.small = x - 1

    def most(self, x: int, y: int) -> int:
        """Elements in which similar sets of x and y elements may differ."""
        need = -(-(x + y) * self.num // (self.num + self.den))
        return x + y - 2 * need

    def of(self, n: int) -> int:
        return bisect_right(self.edges, n) - 1

    @lru_cache(maxsize=None)  # noqa: B019
    def parts(self, j: int) -> tuple[int, int]:
        """(parts, spare) of the scheme for classes j and j + 1."""
        x = max(self.edges[j], self.edges[j + 1] - 1)
        differ = (x + x * self.den // self.num) * (self.den - self.num) // (self.den + self.num)
        low = self.edges[j]
        for spare in range(2 * differ + 3):
            n = differ + 1 + spare
            p = math.exp(-0.85 * low / n)  # of a part without an element that counts
            if spare >= n * p + 1.5 * math.sqrt(n * p):
                break
        return differ + 1 + spare, spare


def signatures(s: np.ndarray, classes: Classes, common: np.ndarray | None = None) -> list[tuple[int, np.ndarray]]:
    """``(kind, signatures)`` of a sorted set; ``common`` is sorted."""
    n = len(s)
    own = np.ones(n, dtype=bool)
    if common is not None and len(common):
        own = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] != s
    out: list[tuple[int, np.ndarray]] = []
    if n * classes.num <= classes.small * classes.den and n > 1:
        values = mix(s)
        total = values.sum(dtype=_U)
        out += [(WHOLE, mix(np.array([total], dtype=_U))), (LESS_ONE, mix(total - values))]
    if n <= classes.small:
        return out
    c = classes.of(n)
    for j in (c, c - 1):
        m, spare = classes.parts(j)
        for seed in range(SEEDS):
            salt = mix(np.array([(j + 1) * 1000 + seed], dtype=_U))[0]
            values = mix(s ^ salt)
            part = (values % _U(m)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            size = np.bincount(part, minlength=m)
            sums = np.concatenate([[_U(0)], np.cumsum(mix(values)[order], dtype=_U)])
            ends = np.cumsum(size)
            sig = mix((sums[ends] - sums[ends - size]) + mix(np.arange(m, dtype=_U) + salt))
            strong = np.bincount(part[own], minlength=m) > 0
            last = seed == SEEDS - 1
            enough = m - int(strong.sum()) <= spare
            out.append((PART, sig if last and not enough else sig[strong]))
            if enough:
                break
    return out
