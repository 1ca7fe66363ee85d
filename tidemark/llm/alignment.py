"""Operator 12, alignment of the tokens of two tokenizers.

Tokenizer A is a byte-level BPE (library ``tokenizers``), B a BPE of pieces with byte
fallback (library ``sentencepiece``, which puts a space before a text).  Both give the
span of each token in the text; tokens are joined into groups at the places where both
end.

* A text, with a space before it, is cut into units where a space follows a character
  that is no white space.  There both tokenizers begin anew: A splits at such a place
  before it merges, and no piece of B has a space after another character (checked
  when it is loaded; if one has, a text is one unit).  So a worker tokenizes units that
  it does not know, some at a time, and remembers them up to a bound.
* Coarse cuts of a unit are the ends of spans that both have, A's character offsets and
  B's offset mapping (which took the place of the immutable proto in the installed
  version; the spans are the same).  A token of A whose span overlaps the next one, and
  a byte token of B with an empty span, end inside a character and give no coarse cut.
* Between two coarse cuts where both have such tokens the cuts are refined: the bytes
  that each token decodes to are added up, and the sums that both reach are cuts too.
* The bytes of all tokens must be those of the unit.

Pairs of ids that share a group are counted by document, map-side first; at most
``FREQUENT`` counts are broadcast to the documents, and the pairs of the others, which
are in few documents each, meet their counts in a shuffle.  The largest count of an id
of A is a table bounded by its vocabulary.

Defined results: a null or empty text, or one that its tokens do not spell (as with
U+2581), has no tokens, no groups and no links; special tokens in texts are plain text;
repeated rows and rows of equal or null id are documents of their own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .lattice import frequent_from
from .pieces import MODEL, SPACE

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
#: Units and links that a worker remembers.
HELD, HELD_LINKS = 600_000, 1 << 23
#: Characters of the texts that are aligned at a time (one long text may exceed it).
CHUNK = 1 << 17
#: Counts of pairs that may be broadcast.
FREQUENT = 300_000


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


_WHITE = re.compile(r"[\s\u180e]")
#: A space that follows white space, or ends or begins a text.
_NO_CUT = re.compile(r"(?:\A|[\s\u180e]) | \Z")


def _piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace(SPACE, " ").encode()


class Aligner:
    """The two tokenizers and the bytes of their tokens."""

    def __init__(self, a: str, b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        decoded = byte_of()
        names = self.a.get_vocab(with_added_tokens=True)
        plain = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = {i: bytes(decoded[c] for c in t) if t in plain and all(c in decoded for c in t) else t.encode() for t, i in names.items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        size = self.b.get_piece_size()
        self.byte_ids = {i for i in range(size) if self.b.is_byte(i)}
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [_piece_bytes(p, i in self.byte_ids) for i, p in enumerate(pieces)]
        self.is_byte = np.array([i in self.byte_ids for i in range(size)])
        self.length_a = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)])
        self.length_b = np.array([len(x) for x in self.b_bytes])
        # a space after another character, in a piece that a text can have
        special = {i for i in range(size) if self.b.is_control(i) or self.b.is_unknown(i)}
        self.cuts = not any(SPACE in p.lstrip(SPACE) for i, p in enumerate(pieces) if i not in special)

    def units(self, text: str) -> list[str]:
        """The text without the space before it, as units without theirs."""
        if not self.cuts:
            return [text]
        parts = text.split(" ")
        if not _NO_CUT.search(text):
            return parts
        ends = lambda p: p and not _WHITE.match(p[-1])
        out, open_ = [], None
        for p in parts:
            open_ = p if open_ is None else f"{open_} {p}"
            if ends(p):
                out.append(open_)
                open_ = None
        if open_ == "" and out:
            # a space at the end of a text is no unit: B gives nothing for an empty one
            return [*out[:-1], out[-1] + " "]
        return out if open_ is None else [*out, open_]

    def spans(self, text: str) -> tuple[np.ndarray, ...]:
        """Ids, begins and ends of the tokens of A and of B of a text with a space
        before it; places are characters."""
        a = self.a.encode(" " + text, add_special_tokens=False)
        b = self.b.encode(text, return_type="offset_mapping")
        # the space before a text is not in B's text
        return np.array(a.ids, np.int64), *_columns(a.offsets), np.array(b["ids"], np.int64), *(x + 1 for x in _columns(b["offsets"]))

    def cuts_of(self, ids_a, begin_a, end_a, ids_b, begin_b, end_b) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens of A and of B are before each cut, from none to all."""
        whole_a = np.append(end_a[:-1] <= begin_a[1:], True)
        whole_b = ~(self.is_byte[ids_b] & (begin_b == end_b))
        at_a, at_b = np.flatnonzero(whole_a), np.flatnonzero(whole_b)
        # two tokens of B may end at one place, where the first is the space: the last counts
        last = np.append(end_b[at_b][1:] != end_b[at_b][:-1], True)
        at_b = at_b[last]
        common = np.intersect1d(end_a[at_a], end_b[at_b], assume_unique=True)
        i = np.append(0, at_a[np.searchsorted(end_a[at_a], common)] + 1)
        j = np.append(0, at_b[np.searchsorted(end_b[at_b], common)] + 1)
        if whole_a.all() or whole_b.all():
            return i, j
        # refine, by the bytes of tokens, what lies between two cuts and has tokens of both that end inside a character
        inner_a, inner_b = np.append(0, np.cumsum(~whole_a)), np.append(0, np.cumsum(~whole_b))
        inside = (np.diff(inner_a[i]) > 0) & (np.diff(inner_b[j]) > 0)
        bytes_a, bytes_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        tokens_a = np.flatnonzero(np.repeat(inside, np.diff(i)))
        tokens_b = np.flatnonzero(np.repeat(inside, np.diff(j)))
        _, x, y = np.intersect1d(bytes_a[tokens_a], bytes_b[tokens_b], assume_unique=True, return_indices=True)
        return np.union1d(i, tokens_a[x] + 1), np.union1d(j, tokens_b[y] + 1)

    def spells(self, text: str, ids_a: np.ndarray, ids_b: np.ndarray) -> bool:
        """Whether the tokens' bytes are those of the text and the space before it."""
        raw = (" " + text).encode()
        return b"".join(map(self.a_bytes.__getitem__, ids_a.tolist())) == raw == b"".join(map(self.b_bytes.__getitem__, ids_b.tolist()))


def _columns(pairs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.fromiter(itertools.chain.from_iterable(pairs), np.int64, 2 * len(pairs))
    return flat[::2], flat[1::2]


@functools.lru_cache(maxsize=2)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


@dataclass
class Learnt:
    """What is known of some units: tokens of A and B, groups and links of each, its
    groups as a text, and its links (ids of A above bit 32) from ``first`` on.  A unit
    that its tokens do not spell has -1 tokens."""

    numbers: np.ndarray
    texts: list[str]
    first: np.ndarray
    links: np.ndarray


def learn(al: Aligner, units: list[str]) -> Learnt:
    """Aligns units, as one text if its tokens spell it, else each by itself.  Of
    several units none ends in white space."""
    text = " ".join(units)
    ids_a, begin_a, end_a, ids_b, begin_b, end_b = spans = al.spans(text)
    if not al.spells(text, ids_a, ids_b):
        if len(units) > 1:
            each = [learn(al, [u]) for u in units]
            first = np.append(0, np.cumsum([len(x.links) for x in each]))
            return Learnt(np.concatenate([x.numbers for x in each]), [x.texts[0] for x in each], first, np.concatenate([x.links for x in each]))
        return Learnt(np.full((1, 4), -1), [""], np.zeros(2, np.int64), np.zeros(0, np.int64))
    i, j = al.cuts_of(*spans)
    # every unit ends at a cut
    ends = np.cumsum([len(u) + 1 for u in units])
    unit_a = np.append(0, np.searchsorted(end_a, ends, "right"))
    of_unit = np.searchsorted(i, unit_a)
    if not np.array_equal(i[of_unit], unit_a):
        raise ValueError("a unit does not end at a cut")
    n_a, n_b = np.diff(i), np.diff(j)
    links_before = np.append(0, np.cumsum(n_a * n_b))
    numbers = np.stack([np.diff(unit_a), np.diff(j[of_unit]), np.diff(of_unit), np.diff(links_before[of_unit])], axis=1)
    # tokens in the order of groups, those of A first; a unit's last one ends its line
    order = np.concatenate([np.repeat(np.arange(len(n_a)) * 2, n_a), np.repeat(np.arange(len(n_b)) * 2 + 1, n_b)])
    marks = np.concatenate([np.where(np.isin(np.arange(1, len(ids_a) + 1), i), 1, 0), np.where(np.isin(np.arange(1, len(ids_b) + 1), j), 2, 0)])
    marks[len(ids_a) + j[of_unit[1:]] - 1] = 3
    names, signs = np.concatenate([ids_a, ids_b]), np.array([",", "|", ";", "\n"], object)
    put = np.argsort(order, kind="stable")
    pieces = [""] * (2 * len(put))
    pieces[::2], pieces[1::2] = map(str, names[put].tolist()), signs[marks[put]].tolist()
    texts = "".join(pieces).split("\n")[:-1]
    return Learnt(numbers, texts, links_before[of_unit], _links(ids_a, ids_b, i, j, n_a, n_b))


def _links(ids_a, ids_b, i, j, n_a, n_b) -> np.ndarray:
    """The linked ids of all groups, in their order."""
    each = n_a * n_b
    total = int(each.sum())
    if total == len(each):  # one token of each
        return ids_a[i[:-1]] << 32 | ids_b[j[:-1]]
    group = np.repeat(np.arange(len(each)), each)
    at = np.arange(total) - np.repeat(np.cumsum(each) - each, each)
    return ids_a[i[group] + at // n_b[group]] << 32 | ids_b[j[group] + at % n_b[group]]


class Memory:
    """What a worker knows of units, ``HELD`` and ``HELD_LINKS`` at most.  When it is full
    it forgets those that were not seen again after they were learnt, and all if these
    are few."""

    def __init__(self, a: str, b: str) -> None:
        self.aligner, self.now = aligner(a, b), 0
        self._start()

    def _start(self) -> None:
        self.place: dict[str, int] = {}
        self.numbers = np.zeros((1024, 4), np.int64)
        self.texts: list[str] = []
        self.first = np.zeros(1025, np.int64)
        self.links = np.zeros(4096, np.int64)
        #: when a unit was learnt and last seen, in chunks of texts
        self.learnt, self.seen = np.zeros(1024, np.int64), np.zeros(1024, np.int64)

    def forget(self) -> None:
        n = len(self.place)
        keep = np.flatnonzero(self.seen[:n] > self.learnt[:n])
        sizes = self.first[keep + 1] - self.first[keep]
        if 2 * len(keep) > HELD or 2 * int(sizes.sum()) > HELD_LINKS:
            keep = keep[:0]
        old, units, texts = (self.numbers, self.first, self.links, self.learnt, self.seen), list(self.place), self.texts
        self._start()
        if len(keep):
            sizes = old[1][keep + 1] - old[1][keep]
            ends = np.cumsum(sizes)
            self.numbers, self.learnt, self.seen = old[0][keep], old[3][keep], old[4][keep]
            self.first = np.append(0, ends)
            self.links = old[2][np.arange(int(ends[-1])) + np.repeat(old[1][keep] - (ends - sizes), sizes)]
            self.texts = [texts[i] for i in keep.tolist()]
            self.place = {units[i]: k for k, i in enumerate(keep.tolist())}

    def know(self, units: list[str]) -> None:
        """Learns those of the units, all different, that it does not know."""
        self.now += 1
        new = [u for u in units if u not in self.place]
        if self.place and (len(self.place) + len(new) > HELD or self.first[len(self.place)] > HELD_LINKS):
            self.forget()
            new = [u for u in units if u not in self.place]
        # white space at the end of a unit would meet the space of the next one
        alone = [u for u in new if not u or _WHITE.match(u[-1])]
        new = [u for u in new if u and not _WHITE.match(u[-1])] if alone else new
        for lo in range(0, len(new), 1 << 14):
            self._add(new[lo : lo + (1 << 14)])
        for u in alone:
            self._add([u])

    def _add(self, units: list[str]) -> None:
        found, k = learn(self.aligner, units), len(self.place)
        n, begin = k + len(units), int(self.first[k])
        end = begin + len(found.links)
        self.numbers, self.learnt, self.seen = _room(self.numbers, n), _room(self.learnt, n), _room(self.seen, n)
        self.first = _room(self.first, n + 1)
        self.links = _room(self.links, end)
        self.numbers[k:n], self.first[k + 1 : n + 1], self.links[begin:end] = found.numbers, begin + found.first[1:], found.links
        self.learnt[k:n] = self.seen[k:n] = self.now
        self.texts += found.texts
        self.place.update(zip(units, range(k, n), strict=True))


def _room(x: np.ndarray, n: int) -> np.ndarray:
    """``x`` with room for ``n`` rows."""
    return x if len(x) >= n else np.concatenate([x, np.zeros((max(n, 2 * len(x)) - len(x), *x.shape[1:]), x.dtype)])


@functools.lru_cache(maxsize=2)
def memory(a: str, b: str) -> Memory:
    """The memory of a worker, for all of its tasks."""
    return Memory(a, b)


def _aligned(a: str, b: str):
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    nothing = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))

    def document(units: list[str], known: Memory) -> tuple:
        if not units:
            return nothing
        at = np.fromiter(map(known.place.__getitem__, units), np.int64, len(units))
        known.seen[at] = known.now
        numbers = known.numbers[at]
        if numbers[:, 0].min() < 0:
            return nothing
        sha = hashlib.sha256(";".join(map(known.texts.__getitem__, at.tolist())).encode()).hexdigest()
        first, n = known.first[at], numbers[:, 3]
        links = known.links[np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)]
        pairs, times = np.unique(links, return_counts=True)
        return *numbers.sum(axis=0).tolist(), sha, pairs, times

    def pack(ids: pa.Array, docs: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        cols = [ids, docs, *(pa.array([r[k] for r in rows], pa.int64()) for k in range(4))]
        offsets = pa.array(np.cumsum([0, *(len(r[5]) for r in rows)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([r[k] for r in rows]))) for k in (5, 6)]
        return pa.RecordBatch.from_arrays([*cols, pa.array([r[4] for r in rows], pa.string()), *lists], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = memory(a, b)
        for batch in batches:
            lo = 0
            while lo < batch.num_rows:
                hi, size, split = lo, 0, []
                while hi < batch.num_rows and size < CHUNK:
                    text = batch["text"][hi].as_py()
                    split.append(known.aligner.units(text) if text else [])
                    size += len(text or "")
                    hi += 1
                known.know(list(dict.fromkeys(itertools.chain.from_iterable(split))))
                rows = [document(units, known) for units in split]
                yield pack(batch["row"][lo:hi], batch["doc_id"][lo:hi], rows)
                lo = hi

    return run


def aligned(docs: DataFrame, a: str = BYTE_BPE, b: str = MODEL) -> DataFrame:
    """Each row's tokens, groups and links: ``(row, doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, pairs, times)``; ``row`` is a number of its own, ``pairs`` has the
    linked ids, A's above bit 32, and ``times`` how often each pair is linked."""
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<bigint>, times array<bigint>"
    return stored(own.mapInArrow(_aligned(a, b), kind), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(pair, n, best)``: in how many documents ids are linked, and whether this is
    the most of the pairs of the id of A."""
    counts = stored(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    of_a = F.shiftright("pair", 32)
    # one row for each id of A
    most = counts.groupBy(of_a.alias("_a")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), of_a == F.col("_a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def digests(docs: DataFrame, a: str = BYTE_BPE, b: str = MODEL, frequent: int = FREQUENT) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of
    each row."""
    rows = aligned(docs, a, b)
    counts = stored(pair_counts(rows), "pairs-of-ids")
    least = frequent_from(counts.select(F.col("n").alias("count")), frequent)
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    known = F.broadcast(counts.filter(F.col("n") >= least))
    rare = counts.filter(F.col("n") < least).hint("merge")
    value = [F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    often = each.join(known, "pair").groupBy("row").agg(*value)
    seldom = each.join(known.select("pair"), "pair", "left_anti").join(rare, "pair").groupBy("row").agg(*value)
    scalars = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    own = rows.select("row", *scalars)
    sums = own.unionByName(often.unionByName(seldom), allowMissingColumns=True).groupBy("row")
    total = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return sums.agg(*[F.max(c).alias(c) for c in scalars], *total).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
