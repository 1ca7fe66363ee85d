"""Operator 4, chat formatting by schema fingerprinting.

Records come in many layouts: a row per turn, a list of messages, a prompt and
its response, an instruction with an input.  The nested field paths of a layout
are hashed; the fingerprint selects a declarative mapping that says where the
conversation id, the roles and the texts are, and the mapping is compiled to
Spark expressions that give canonical turns ``(conv_id, turn, role, text)``.  Where a
table has the fields of several layouts, each row is read by the one whose fields it
fills: most filled fields, then fewest empty ones, then the order of ``LAYOUTS``.

A template then marks the turns.  Control characters inside roles and texts are
escaped, so the marks never occur in them and the formatted text reads back
exactly.  The formatted text stays a row per turn (a conversation is the
concatenation of its pieces by ``turn``), so no conversation, however long, is
held in memory.

Defined results: a null text is empty; a null role is empty and never under the
loss mask; a null conversation id forms a conversation of its own (null); equal
turn numbers are ordered by role, then text, repeated rows all stay; a null turn
number comes first; a null or empty list of turns has no turns, so it gives no rows;
nor does a row of a table of several layouts that fills no field of any; empty tables
give no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN_OPEN, ROLE_END, TURN_CLOSE = "### ", ": ", " </turn>\n"
#: An escaped text has none of these bare, so it holds no mark of the template.
CONTROL = r"([\\#<])"
ROLE_CONTROL = r"([\\#<:])"
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Nested paths of the leaves, as ``messages[].role``."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


@dataclass(frozen=True)
class Layout:
    """``id``: the conversation's id.  One of: ``row`` (turn, role and text
    fields of a row that is one turn), ``items`` (a list field, and the role and
    text fields of its items), ``parts`` (role and text field per turn; several
    text fields of a turn are joined by a blank line, null ones left out)."""

    id: str
    row: tuple[str, str, str] | None = None
    items: tuple[str, str, str] | None = None
    parts: tuple[tuple[str, tuple[str, ...]], ...] | None = None

    def paths(self) -> list[str]:
        if self.row:
            return [self.id, *self.row]
        if self.items:
            name, role, text = self.items
            return [self.id, f"{name}[].{role}", f"{name}[].{text}"]
        return [self.id, *(f for _, fields in self.parts or () for f in fields)]


LAYOUTS = (
    Layout("conv_id", row=("turn", "role", "text")),
    Layout("conv_id", items=("messages", "role", "content")),
    Layout("conv_id", items=("conversations", "from", "value")),
    Layout("conv_id", parts=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("conv_id", parts=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("conv_id", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
)


def choose(schema: T.StructType, layouts: tuple[Layout, ...] = LAYOUTS) -> Layout:
    """The layout whose fingerprint is that of the schema, or of the part of the
    schema that the layout knows (most fields first), so extra columns do not
    matter.  No such layout: ValueError."""
    paths = set(field_paths(schema))
    by_print = {fingerprint(x.paths()): x for x in layouts}
    if found := by_print.get(fingerprint(list(paths))):
        return found
    for x in sorted(layouts, key=lambda x: -len(x.paths())):
        if fingerprint([p for p in paths if p in x.paths()]) == fingerprint(x.paths()):
            return x
    raise ValueError(f"no layout for fields {sorted(paths)}")


def known(schema: T.StructType, layouts: tuple[Layout, ...] = LAYOUTS) -> list[Layout]:
    """The layouts whose fields the schema has, without those that are a part of
    another; one alone is that of ``choose``."""
    paths = set(field_paths(schema))
    has = [x for x in layouts if paths.issuperset(x.paths())]
    return [x for x in has if not any(set(x.paths()) < set(y.paths()) for y in has)] or [choose(schema, layouts)]


def _filled(x: Layout) -> tuple[Column, int]:
    """Fields of the layout that a row fills (the id apart), and how many there are."""
    if x.items:
        name, *fields = x.items
        there = [F.exists(F.col(f"`{name}`").getField(f), lambda v: v.isNotNull()) for f in fields]
    else:
        there = [F.col(f"`{f}`").isNotNull() for f in x.paths()[1:]]
    return sum((F.coalesce(c, F.lit(False)).cast("int") for c in there), F.lit(0)), len(there)


def _role(c: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in ROLE_NAMES.items() for x in kv])
    return F.coalesce(names[c], c, F.lit(""))


def to_turns(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Canonical turns ``(conv_id long, turn long, role string, text string)``."""
    found = known(df.schema, layouts)
    if len(found) == 1:
        return _turns(df, found[0])
    # most filled fields, fewest empty ones, the first
    rank = [F.struct(n.alias("n"), (n - size).alias("full"), F.lit(-i).alias("i")) for i, (n, size) in enumerate(map(_filled, found))]
    best = F.greatest(*rank)
    parts = [_turns(df.filter((best["n"] > 0) & (best["i"] == -i)), x) for i, x in enumerate(found)]
    return reduce(DataFrame.unionByName, parts)


def _turns(df: DataFrame, x: Layout) -> DataFrame:
    """The turns of rows of one layout."""
    ref = lambda name: F.col(f"`{name}`")
    conv = ref(x.id).cast("long").alias("conv_id")
    if x.row:
        turn, role, text = x.row
        return df.select(conv, ref(turn).cast("long").alias("turn"), _role(ref(role)).alias("role"), F.coalesce(ref(text), F.lit("")).alias("text"))
    if x.items:
        name, role, text = x.items
        rows = df.select(conv, F.posexplode(ref(name)).alias("turn", "m"))
        return rows.select("conv_id", F.col("turn").cast("long"), _role(F.col("m").getField(role)).alias("role"), F.coalesce(F.col("m").getField(text), F.lit("")).alias("text"))
    turns = F.array(
        *[F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *[ref(f) for f in fields]).alias("text")) for role, fields in x.parts or ()]
    )
    rows = df.select(conv, F.posexplode(turns).alias("turn", "m"))
    return rows.select("conv_id", F.col("turn").cast("long"), "m.role", "m.text")


def format_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role_rank, piece, mask_start, mask_chars)``: the
    formatted piece of each turn, and the span of it that is under the loss mask
    (code points; an assistant's escaped text).  ``ord_*`` columns break ties."""
    role = F.regexp_replace("role", ROLE_CONTROL, r"\\$1")
    body = F.regexp_replace("text", CONTROL, r"\\$1")
    head = F.concat(F.lit(TURN_OPEN), role, F.lit(ROLE_END))
    mine = F.col("role") == "assistant"
    return turns.select(
        "conv_id",
        "turn",
        F.concat(head, body, F.lit(TURN_CLOSE)).alias("piece"),
        F.when(mine, F.char_length(head)).otherwise(0).cast("int").alias("mask_start"),
        F.when(mine, F.char_length(body)).otherwise(0).cast("int").alias("mask_chars"),
    )


_PIECE = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*) </turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_back(piece: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    m = _PIECE.fullmatch(piece)
    if m is None:
        raise ValueError(f"not a formatted turn: {piece[:80]!r}")
    return unescape(m[1]), unescape(m[2])


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partitions are sorted by conversation and turn: hashes are carried on, and
    a row leaves when the conversation changes."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    done: list[tuple] = []
    conv: object = _digests
    turns = loss = None
    n = chars = size = 0
    for batch in batches:
        for cid, piece, start, span in zip(*(batch[c].to_pylist() for c in ("conv_id", "piece", "mask_start", "mask_chars")), strict=True):
            if cid != conv or turns is None:
                if turns is not None:
                    done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
                conv, turns, loss, n, chars, size = cid, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            role, text = read_back(piece)
            turns.update(f"{role}\n{text}\n".encode())
            masked = unescape(piece[start : start + span])
            loss.update(masked.encode())
            n, chars, size = n + 1, chars + len(masked), size + len(piece)
        if len(done) >= 10_000:
            yield pack(done)
            done = []
    if turns is not None:
        done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
    if done:
        yield pack(done)


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted pieces: number of turns,
    digest of roles and texts, code points and digest of the text under the loss
    mask, formatted length.  A digest over a conversation is sequential: its rows
    stream through one task in order, and only the hash states are held."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return format_turns(ordered).mapInArrow(_digests, DIGEST_SCHEMA)
