"""Operator 10, SentencePiece encoding and decoding on a relational lattice.

The distinct words of all texts are spelt once.  A word, with the word-start mark
before it, is cut where no piece holds both neighbours: every spelling has an end
there, so its segments are spelt apart, each distinct one once.  A segment is
exploded into its substrings of bounded length; an equi-join with the piece table
leaves the edges of its lattice; the edges are folded, in the order of their ends, to
the best spelling of every prefix (Viterbi).  A character that no piece spells gives
one edge of byte pieces.  A segment of more than ``STRETCH`` characters is spelt by a
function that walks it once, as the weights of a path have bounded bits.  The substrings
stay in the partition of their segment and next to each other, so edges are neither
shuffled nor sorted: an Arrow function folds them as they come, many segments at a time.  The segments' ids go back to the
words as words' ids go to texts (below).

Decoding looks the ids up in the model's names, which are broadcast, joins their bytes,
and gives the word.

A text is its words; the words of all texts get their spelling by a join: the
frequent ones, at most ``FREQUENT``, by a broadcast table where the text is, the others
by a shuffle of their occurrences, which no word is frequent enough to make uneven.  The
ids of the others go back to their text and are put at their places among those of the
frequent ones; then the text is decoded from all its ids.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined results: the best spelling has the
highest score, then the fewest pieces, then the longest last piece; a null or
blank text has no words and no pieces; repeated rows and null ids stay; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import dropped, free, slices, stored
from .pieces import MODEL, SPACE, Pieces, best_ids, load

#: Words that may be broadcast with their spelling.
FREQUENT = 200_000
#: Segments that may be: the driver holds the broadcast table several times over.
FREQUENT_SEGMENTS = 50_000
#: Stands for an id where a character is spelt in bytes.
BYTES = (1 << 25) - 1
#: Bits for the pieces of a path; the rest of a long holds its cost.
PIECE_BITS = 20
#: Characters of a segment up to which it is folded: a character costs less than 2^29 and
#: has at most 4 pieces (``piece_table``), so cost and pieces stay below 2^43 and 2^16.
STRETCH = 1 << 14
#: Bits of what each occurrence adds to a text's digest: its sum has room for 2^32 words.
DIGEST = (1 << 31) - 1
#: Distinct words that a task counts at a time, and bytes of a text that it splits at a time.
HELD, STRETCH_BYTES = 250_000, 1 << 20
#: Bytes of a word up to which its spelling is broadcast.
LONGEST_KNOWN = 256
#: Edges that are folded at a time, with those of the segment that goes on.
EDGES = 1 << 17
_SEPARATOR = re.compile(rb"[\x20\x09-\x0D]")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")


def _edge(cost: int, n: int, length: int, code: int) -> int:
    """An edge in one number: cost, pieces, length, and id or ``BYTES``."""
    return cost << 34 | n << 31 | length << 25 | code


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    worst = 4 * pieces.byte_score, *pieces.scores.values()
    if pieces.longest > 63 or max(pieces.ids.values(), default=0) >= BYTES or min(worst) <= -(1 << 29):
        raise ValueError("the model's pieces do not fit the form of an edge")
    rows = [(p, _edge(-s, 1, len(p), pieces.ids[p])) for p, s in pieces.scores.items()]
    return spark.createDataFrame(rows, "p string, edge long").select(F.xxhash64("p").alias("h"), "p", "edge")


def piece_names(pieces: Pieces) -> list[bytes]:
    """The UTF-8 bytes of every id, at its place."""
    names = [b""] * (max([*pieces.ids.values(), *pieces.byte_ids], default=-1) + 1)
    for p, i in pieces.ids.items():
        names[i] = p.encode()
    for b, i in enumerate(pieces.byte_ids):
        names[i] = bytes([b])
    return names


def _bytes(char: Column, first: int) -> Column:
    """Ids of the byte pieces of a character (byte ids follow one another)."""
    h = F.hex(F.encode(char, "UTF-8"))
    pairs = F.sequence(F.lit(1), (F.length(h) / 2).cast("int"))
    return F.transform(pairs, lambda i: F.conv(F.substring(h, i * 2 - 1, F.lit(2)), 16, 10).cast("int") + first)


def _stretches(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, those of about ``STRETCH_BYTES`` at a time."""
    lo = 0
    while lo < len(text):
        cut = _SEPARATOR.search(text, lo + STRETCH_BYTES) if len(text) > lo + STRETCH_BYTES else None
        hi = cut.start() if cut else len(text)
        # the six separators of a word are those that this method splits at
        yield text[lo:hi].split()
        lo = hi


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    for x in column.cast(pa.large_binary()):
        yield x.as_py()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, count)`` of the words of the texts, of at most about ``HELD`` words at a time."""

    def out(counts: Counter) -> Iterator[pa.RecordBatch]:
        words = list(counts)
        for lo in range(0, len(words), 1 << 14):
            part = words[lo : lo + (1 << 14)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()).cast(pa.string()), pa.array([counts[w] for w in part], pa.int64())], names=["word", "count"])

    counts: Counter = Counter()
    for batch in slices(batches):
        for text in _texts(batch["text"]):
            for words in _stretches(text or b""):
                counts.update(words)
                if len(counts) > HELD:
                    yield from out(counts)
                    counts = Counter()
    yield from out(counts)


def _placed(shared):
    """Each text's ids as far as its words are frequent, with the sums over these words;
    and its other words, with their places and the number of ids before them."""
    names = ["row", "doc_id", "n_words", "n_exact", "ids_digest", "known", "words", "places", "before"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, x, h, ids, ends = shared.value
        known = dict(zip(words, range(len(words)), strict=True))
        sizes = np.diff(ends)
        rows: list[tuple] = []
        size = 0

        def pack() -> pa.RecordBatch:
            cols = [pa.array([r[c] for r in rows], pa.int64()) for c in range(5)]
            cols.append(pa.array([r[5] for r in rows], pa.binary()))
            lists = [pa.array([r[6] for r in rows], pa.list_(pa.binary())).cast(pa.list_(pa.string())), *(pa.array([r[c] for r in rows], pa.list_(pa.int64())) for c in (7, 8))]
            return pa.RecordBatch.from_arrays([*cols, *lists], names=names)

        for batch in slices(batches):
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], _texts(batch["text"]), strict=True):
                n = pieces = exact = digest = 0
                spelt: list[bytes] = []
                rare: list[bytes] = []
                places: list[int] = []
                before: list[int] = []
                for own in _stretches(text or b""):
                    if not own:
                        continue
                    at = np.fromiter(map(known.get, own, itertools.repeat(-1)), np.int64, len(own))
                    there = np.flatnonzero(at >= 0)
                    i, at_place = at[there], n + there + 1
                    of_word = np.zeros(len(own), np.int64)
                    of_word[there] = sizes[i]
                    to = np.cumsum(of_word)
                    # the ids of a word lie together in ``ids``
                    spelt.append(ids[np.arange(int(to[-1])) + np.repeat(ends[i] - (to - of_word)[there], sizes[i])].tobytes())
                    exact += int(x[i].sum())
                    digest += int((at_place * h[i] & DIGEST).sum())
                    other = np.flatnonzero(at < 0)
                    rare += map(own.__getitem__, other.tolist())
                    places += (n + other + 1).tolist()
                    before += (pieces + to[other]).tolist()
                    pieces += int(to[-1])
                    n += len(own)
                rows.append((row.as_py(), doc_id.as_py(), n, exact, digest, b"".join(spelt), rare, places, before))
                size += len(rare) + pieces // 8 + 16
                if size > 1 << 16:
                    yield pack()
                    rows, size = [], 0
        if rows:
            yield pack()

    return run


def _whole(shared, wide: str):
    """The ids of each text with those of its other words put at their places, and the
    digest of the text that they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(shared.value, pa.binary())
        for batch in slices(batches):
            texts = []
            for known, rest in zip(batch["known"], batch["rest"], strict=True):
                own = np.frombuffer(known.as_py(), wide)
                if rest.is_valid and len(rest.values):
                    parts = rest.values
                    n = pc.list_value_length(parts.field("ids")).to_numpy(zero_copy_only=False)
                    own = np.insert(own, np.repeat(parts.field("before").to_numpy(), n), parts.field("ids").flatten().to_numpy())
                texts.append(own)
            ends = np.append(0, np.cumsum([len(t) for t in texts]))
            ids = pa.array(np.concatenate([*texts, np.empty(0, wide)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
            raw = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, names.take(ids)), b"")
            hashes = [hashlib.sha256(decoded_text(t.as_py())).hexdigest() for t in raw]
            own = batch.drop_columns(["known", "rest"])
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(hashes, pa.string()), lists], names=[*own.schema.names, "decoded_sha256", "ids"])

    return run


def decoded_text(joined: bytes) -> bytes:
    """The text of the joined names of its ids: each mark is a space, but the first."""
    return joined.replace(SPACE.encode(), b" ")[1:]


def _split(pairs: frozenset[str]):
    """``(word, count)`` in, with the segments of the marked word out: it is cut
    where no piece holds both neighbours, so every spelling has an end there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word in batch["word"].to_pylist():
                t = SPACE + word
                cuts = [0, *(i for i in range(1, len(t)) if t[i - 1 : i + 1] not in pairs), len(t)]
                out.append([t[a:b] for a, b in itertools.pairwise(cuts)])
            yield pa.RecordBatch.from_arrays([batch["word"], batch["count"], pa.array(out, pa.list_(pa.string()))], names=["word", "count", "segments"])

    return run


def _weights(edge: np.ndarray) -> np.ndarray:
    """Cost and pieces of edges in one number that adds up along a path; less is
    better: cost first, then pieces."""
    return edge >> 34 << PIECE_BITS | edge >> 31 & 7


def _best_paths(edge: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of the best path of each segment, in order, with the end above bit 31;
    and how many each has.  ``heads`` are the first edges of the segments, whose edges
    come by end, then by length, and each end has one of length 1.

    All segments are folded at once, an end at a time: the least weight of a prefix comes
    from those of the prefixes that its edges go on from."""
    length = edge >> 25 & 63
    first = np.flatnonzero(length == 1)
    before = np.searchsorted(first, heads)
    if len(heads) == 0 or heads[0] != 0 or not np.array_equal(first[before], heads):
        raise ValueError("the edges of a segment are not together")
    ends = np.diff(np.append(before, len(first)))
    # a segment has a place for its empty prefix, and one for each end
    begin = before + np.arange(len(heads))
    own = np.repeat(np.arange(len(heads)), ends)
    end = np.arange(len(first)) - before[own] + 1
    place = begin[own] + end
    count = np.diff(np.append(first, len(edge)))
    weight = _weights(edge)
    best = np.zeros(len(first) + len(heads), np.int64)
    chosen = np.zeros(len(best), np.int64)
    by_end = np.argsort(end.astype(np.int32), kind="stable")
    stops = np.cumsum(np.bincount(end)[1:])
    for nodes in np.split(by_end, stops[:-1]):
        n = count[nodes]
        starts = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(first[nodes] - starts, n)
        total = best[np.repeat(place[nodes], n) - length[at]] + weight[at]
        least = np.minimum.reduceat(total, starts)
        best[place[nodes]] = least
        # of equal ones the longest, which is the last
        chosen[place[nodes]] = np.maximum.reduceat(np.where(total == np.repeat(least, n), at, -1), starts)
    segments, left, steps = np.arange(len(heads)), ends, []
    while len(segments):
        e = edge[chosen[begin[segments] + left]]
        steps.append((segments, left << 31 | e & (1 << 31) - 1))
        left = left - (e >> 25 & 63)
        segments, left = segments[left > 0], left[left > 0]
    of, piece = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.lexsort((piece, of))
    return piece[order], np.bincount(of, minlength=len(heads))


def _by_segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(segment, edge)`` in, ``(segment, path)`` out: the pieces of the best path
    through each segment's edges.

    The edges come as they were exploded: segment by segment, by end, then by
    length.  The first of a segment alone names it.
    """
    held: list[pa.Table] = []
    size = 0
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size < EDGES:
                continue
        if not size:
            return
        rows = pa.concat_tables(held).combine_chunks()
        heads = np.flatnonzero(rows["segment"].is_valid().to_numpy())
        # the last segment may go on in the next batch
        done = rows.num_rows if batch is None else (int(heads[-1]) if len(heads) else 0)
        held, size = [rows.slice(done)], rows.num_rows - done
        if not done:
            continue
        heads = heads[heads < done]
        path, n = _best_paths(rows["edge"].to_numpy()[:done], heads)
        named = rows["segment"].take(pa.array(heads)).combine_chunks()
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(path))
        yield pa.RecordBatch.from_arrays([named.chunk(0) if isinstance(named, pa.ChunkedArray) else named, lists], ["segment", "path"])


def spell_segments(segments: DataFrame, pieces: Pieces) -> DataFrame:
    """``(segment, uses, ids)`` of ``(segment, uses)`` with distinct segments."""
    most = pieces.longest
    text = segments.select("segment", "uses", F.explode(F.sequence(F.lit(1), F.char_length("segment"))).alias("e"))
    own = text.select("segment", "uses", "e", F.substring(F.col("segment"), F.greatest(F.col("e") - most, F.lit(0)) + 1, F.least(F.col("e"), F.lit(most))).alias("t"))
    cuts = own.select("segment", "uses", "e", "t", F.explode(F.sequence(F.lit(1), F.char_length("t"))).alias("l"))
    cuts = cuts.select("segment", "uses", "e", "l", F.substring(F.col("t"), -F.col("l"), F.col("l")).alias("piece"))
    # the piece table is bounded by the model; its key is a hash that is faster to look up
    table = F.broadcast(piece_table(segments.sparkSession, pieces))
    found = cuts.join(table, (F.xxhash64("piece") == F.col("h")) & (F.col("piece") == F.col("p")), "left").filter("edge is not null or l = 1")
    spelt = F.octet_length("piece").cast("long")
    in_bytes = F.shiftleft(spelt * -pieces.byte_score, 34).bitwiseOR(F.shiftleft(spelt, 31)).bitwiseOR(F.lit(_edge(0, 0, 1, BYTES)))
    named = F.when(F.col("e") == 1, F.struct("segment", "uses"))
    rows = found.select(named.alias("segment"), F.coalesce("edge", in_bytes).alias("edge"))
    paths = rows.mapInArrow(_by_segment, "segment struct<segment:string,uses:bigint>, path array<bigint>").select("segment.*", "path")
    first = pieces.byte_ids[0] if pieces.byte_ids else 0

    def ids(p: Column) -> Column:
        code = p.bitwiseAND((1 << 25) - 1).cast("int")
        return F.when(code != BYTES, F.array(code)).otherwise(_bytes(F.substring(F.col("segment"), F.shiftright(p, 31).cast("int"), F.lit(1)), first))

    plain = F.transform("path", lambda p: p.bitwiseAND((1 << 25) - 1).cast("int"))
    each = F.when(F.exists("path", lambda p: p.bitwiseAND((1 << 25) - 1) == BYTES), F.flatten(F.transform("path", ids))).otherwise(plain)
    return paths.select("segment", "uses", each.alias("ids"))


def _walked(pieces: Pieces):
    """``(segment, uses)`` in, ``(segment, uses, ids)`` out, one segment at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, uses in zip(batch["segment"].to_pylist(), batch["uses"].to_pylist(), strict=True):
                ids = pa.array([best_ids(segment, pieces)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([segment]), pa.array([uses], pa.int64()), ids], names=["segment", "uses", "ids"])

    return run


def spell(vocabulary: DataFrame, pieces: Pieces, frequent: int) -> tuple[DataFrame, list[DataFrame]]:
    """``(word, count, ids)`` of ``(word, count)`` with distinct words, and the stored
    tables behind it.  Each distinct segment of the words is spelt once."""
    pairs = frozenset(p[i : i + 2] for p in pieces.scores for i in range(len(p) - 1))
    cut = stored(vocabulary.mapInArrow(_split(pairs), "word string, count long, segments array<string>"), "segments", "zstd")
    used = cut.select(F.explode("segments").alias("segment")).groupBy("segment").agg(F.count("*").alias("uses"))
    is_long = lambda c: F.char_length(c) > STRETCH
    if cut.filter(F.exists("segments", is_long)).limit(1).count():
        long = used.filter(is_long("segment")).mapInArrow(_walked(pieces), "segment string, uses long, ids array<int>")
        found = spell_segments(used.filter(~is_long("segment")), pieces).unionByName(long)
    else:
        found = spell_segments(used, pieces)
    spelt = stored(found, "segment-spellings", "zstd")
    least = frequent_from(spelt.select(F.col("uses").alias("count")), min(frequent, FREQUENT_SEGMENTS))
    known = F.broadcast(spelt.filter(F.col("uses") >= least).select("segment", "ids"))
    rare = spelt.filter(F.col("uses") < least).select("segment", "ids").hint("merge")

    def met(rows: DataFrame) -> DataFrame:
        placed = rows.join(known, "segment", "left")
        missing = placed.filter("ids is null").drop("ids").join(rare, "segment")
        return placed.filter("ids is not null").unionByName(missing)

    # a word of one segment needs no shuffle of its parts, and is the segment less its mark
    single = met(cut.filter(F.size("segments") == 1).select(F.col("segments")[0].alias("segment"), "count"))
    single = single.select(F.expr(f"substring(segment, {len(SPACE) + 1})").alias("word"), "count", "ids")
    many = met(cut.filter(F.size("segments") > 1).select("word", "count", F.posexplode("segments").alias("at", "segment")))
    put = many.groupBy("word", "count").agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("parts"))
    put = put.select("word", "count", F.flatten(F.transform("parts", lambda x: x["ids"])).alias("ids"))
    return single.unionByName(put), [cut, spelt]


def _joined(shared, name: str):
    """The rows with the joined names of their ``ids`` as a further column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(shared.value, pa.binary())
        for batch in batches:
            ids = batch["ids"]
            ends = pc.cumulative_sum(pc.list_value_length(ids).fill_null(0)).to_numpy()
            each = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), names.take(ids.flatten()))
            yield batch.append_column(name, pc.binary_join(each, b""))

    return run


def decode(spelt: DataFrame, pieces: Pieces) -> DataFrame:
    """``spelt`` with ``decoded``: the word that its ``ids`` spell.  The names are broadcast:
    a constant of the plan is in each of its descriptions, which the driver keeps."""
    raw = free("raw", spelt)
    shared = spelt.sparkSession.sparkContext.broadcast(piece_names(pieces))
    kind = StructType([*spelt.schema.fields, StructField(raw, BinaryType())])
    named = spelt.mapInArrow(_joined(shared, raw), kind)
    return named.withColumn("decoded", F.regexp_replace(F.decode(raw, "UTF-8"), "^" + SPACE, "")).drop(raw)


def occurrences(docs: DataFrame) -> DataFrame:
    """``(doc_id, tk, pos, word)`` of every word; ``tk`` is a hash of the text."""
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tk"), words(F.col("text").cast("string")).alias("w"))
    return split.select("doc_id", "tk", F.posexplode("w").alias("pos", "word"))


def frequent_from(counts: DataFrame, most: int) -> int:
    """Least count that at most ``most`` words have; counts are put into bins, of
    which there are at most 64 * 8."""
    edge = F.ceil(F.pow(F.lit(2.0), F.floor(F.log2("count") * 8) / 8)).cast("long")
    bins = sorted(((r.edge, r.n) for r in counts.groupBy(edge.alias("edge")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, least = 0, 1 << 62
    for e, n in bins:
        total += n
        if total > most:
            break
        least = e
    return least


def spellings(docs: DataFrame, pieces: Pieces, frequent: int = FREQUENT) -> DataFrame:
    """The spelling of every distinct word, ``(word, count, ids, exact)`` (exact: it
    decodes to the word), stored."""
    some = docs.select(F.col("text").cast("string").alias("text")).filter("text is not null").mapInArrow(_counted, "word string, count long")
    counted = some.groupBy("word").agg(F.sum("count").alias("count"))
    words, tables = spell(counted, pieces, frequent)
    spelt = stored(decode(words, pieces).select("word", "count", "ids", (F.col("decoded") == F.col("word")).alias("exact")), "spellings", "zstd")
    dropped(*tables)
    return spelt


def encode(docs: DataFrame, model: str = MODEL, frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """The spelling of every distinct word (``spellings``), and of every word of every
    text, ``(doc_id, tk, pos, ids, exact)``."""
    spelt = spellings(docs, load(model), frequent)
    least = frequent_from(spelt, frequent)
    known = F.broadcast(spelt.filter(F.col("count") >= least).select("word", "ids", "exact"))
    rare = spelt.filter(F.col("count") < least).select("word", "ids", "exact").hint("merge")
    often = occurrences(docs).join(known, "word")
    other = occurrences(docs).join(known.select("word"), "word", "left_anti").join(rare, "word")
    cols = ["doc_id", "tk", "pos", "ids", "exact"]
    return spelt, often.select(cols).unionByName(other.select(cols))


def digests(docs: DataFrame, model: str = MODEL, frequent: int = FREQUENT) -> DataFrame:
    """``(doc_id, n_words, n_pieces, n_exact, ids_digest, decoded_sha256, ids)`` of each row:
    its words, their pieces, the words that decode to themselves, the sum over words of the
    low bits of place (from 1) times a hash of the ids, the digest of the text that the ids
    decode to (words with a space between), and the ids of the text in order.

    Texts are read once: the frequent words are spelt where the text is, and only the other
    words meet their spelling in a shuffle."""
    spark, pieces = docs.sparkSession, load(model)
    names = piece_names(pieces)
    wide = "<u2" if len(names) <= 1 << 16 else "<u4"
    spelt = spellings(docs, pieces, frequent)
    short = F.octet_length("word") <= LONGEST_KNOWN
    least = frequent_from(spelt, frequent)
    value = spelt.select("word", "count", "ids", F.col("exact").cast("long").alias("x"), F.xxhash64("ids").bitwiseAND(DIGEST).alias("h"))
    is_known = (F.col("count") >= least) & short
    # at most ``frequent`` words of at most ``LONGEST_KNOWN`` bytes
    known = value.filter(is_known).select(F.col("word").cast("binary").alias("word"), "x", "h", "ids").toArrow().combine_chunks()
    lists = known["ids"].combine_chunks()
    ends = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))).astype(np.int64)
    shared = spark.sparkContext.broadcast((known["word"].to_pylist(), known["x"].to_numpy(), known["h"].to_numpy(), lists.flatten().to_numpy(zero_copy_only=False).astype(wide), ends))
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sums = ["n_exact", "ids_digest"]
    kind = "row long, doc_id long, n_words long, n_exact long, ids_digest long, known binary, words array<string>, places array<long>, before array<long>"
    placed = stored(own.mapInArrow(_placed(shared), kind), "placed-words", "zstd")
    each = placed.select("row", F.explode(F.arrays_zip("words", "places", "before")).alias("o")).select("row", F.col("o.words").alias("word"), F.col("o.places").alias("place"), F.col("o.before").alias("before"))
    rare = value.filter(~is_known).drop("count").hint("merge")
    digest = (F.col("place") * F.col("h")).bitwiseAND(DIGEST)
    rest = F.sort_array(F.collect_list(F.struct("place", "before", "ids"))).alias("rest")
    met = stored(each.join(rare, "word").groupBy("row").agg(F.sum("x").alias("_x"), F.sum(digest).alias("_d"), rest), "met-words", "zstd")
    dropped(spelt)
    both = placed.drop("words", "places", "before").join(met.hint("merge"), "row", "left")
    more = {"n_exact": F.col("n_exact") + F.coalesce("_x", F.lit(0)), "ids_digest": F.col("ids_digest") + F.coalesce("_d", F.lit(0))}
    both = both.withColumns(more).select("doc_id", "n_words", *sums, "known", "rest")
    kind = "doc_id long, n_words long, n_exact long, ids_digest long, decoded_sha256 string, ids array<int>"
    whole = both.mapInArrow(_whole(spark.sparkContext.broadcast(names), wide), kind)
    return whole.select("doc_id", "n_words", F.size("ids").cast("long").alias("n_pieces"), *sums, "decoded_sha256", "ids")
