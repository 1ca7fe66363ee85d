"""Operator 8, benchmark decontamination by size-partitioned MinHash containment.

An item is contained in a document if at least ``threshold`` of the item's
distinct word shingles occur in it, whatever the document's length.  Items are
partitioned by the size of their shingle set (powers of two).  An item's MinHash
sketch is its ``size - ceil(threshold * size) + 1`` first shingle hashes in an order of
all hashes: a document that contains the item must have at least one of them, so no
contained item is missed.  The order puts the shingles that more than ``COMMON`` items
hold last, then goes by hash, so boilerplate brings no item and document together as
long as the item has words of its own.  Within a size partition all sketch values but
common ones lie below a common bound; a document offers to a partition only its shingle
hashes below that bound (and, where sketches have common ones, all), joined by equality.  What meets is verified by exact shingle containment on the
shingles themselves.

Only DataFrame functions run, no Python.

Words are lower-cased runs of letters and digits.  Defined results: a null or
empty text, or one of fewer than ``words`` words, contains nothing and, as an
item, is contained in nothing; equal items are all reported; a repeated document
row is reported once per (doc_id, item_id), with the largest containment; null
ids take no part; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, small, stored

WORDS = 5
THRESHOLD = (80, 100)
#: Items that may hold a shingle before it is common.
COMMON = 8


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def _runs(w: Column, k: int, make) -> Column:  # noqa: ANN001
    """``make(words, i)`` for each run of k words; null without one."""
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: make(w, i)))


def hashes(w: Column, k: int = WORDS) -> Column:
    return _runs(w, k, lambda w, i: F.xxhash64(*[F.element_at(w, (i + j).cast("int")) for j in range(k)]))


def shingles(w: Column, k: int = WORDS) -> Column:
    return F.array_distinct(_runs(w, k, lambda w, i: F.concat_ws(" ", *[F.element_at(w, (i + j).cast("int")) for j in range(k)])))


def sketches(items: DataFrame, k: int, threshold: tuple[int, int]) -> DataFrame:
    """``(item_id, part, h, common)``: the first hashes of each item."""
    num, den = threshold
    split = items.select("item_id", words(F.col("text")).alias("w"))
    sets = split.select("item_id", F.array_distinct(hashes(F.col("w"), k)).alias("h")).filter("h is not null")
    each = stored(sets.select("item_id", F.size("h").alias("n"), F.explode("h").alias("h")), "item-shingles")
    often = each.groupBy("h").agg(F.count_distinct("item_id").alias("items")).filter(F.col("items") > COMMON).select(F.col("h").alias("_h"))
    marked = each.join(often, F.col("h") == F.col("_h"), "left").select("item_id", "n", F.struct(F.col("_h").isNotNull().alias("common"), "h").alias("s"))
    # an item is a short text: its shingles are one list
    lists = marked.groupBy("item_id", "n").agg(F.array_sort(F.collect_list("s")).alias("s"))
    keep = F.col("n") - F.ceil(F.col("n") * num / den).cast("int") + 1
    part = F.floor(F.log2("n")).cast("int")
    return lists.select("item_id", part.alias("part"), F.explode(F.slice("s", F.lit(1), keep)).alias("s")).select("item_id", "part", "s.h", "s.common")


def contained(docs: DataFrame, items: DataFrame, k: int = WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, shared, size)`` of every item contained in a document:
    ``shared`` of the item's ``size`` shingles occur in it."""
    num, den = threshold
    docs = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    items = items.select("item_id", "text").filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    sketch = stored(sketches(items, k, threshold), "sketches")
    # one number per size partition, of which there are at most 31
    bounds = {r.part: r.h for r in sketch.filter("not common").groupBy("part").agg(F.max("h").alias("h")).collect()}
    # the words are a column of their own: as part of the lambda they would be split anew for each shingle
    offered = docs.select("doc_id", words(F.col("text")).alias("w")).select("doc_id", F.explode(hashes(F.col("w"), k)).alias("h"))
    limit = F.create_map(*[F.lit(x) for kv in sorted(bounds.items()) for x in kv]) if bounds else None
    meets = sketch.withColumnRenamed("h", "item_h")
    met = offered.filter(F.col("h") <= max(bounds.values(), default=-(1 << 63))).join(small(meets.filter("not common")), F.col("h") == F.col("item_h"))
    if limit is not None:
        met = met.filter(F.col("h") <= limit[F.col("part")])
    if sketch.filter("common").limit(1).count():
        # an item with few words of its own
        met = met.unionByName(offered.join(small(meets.filter("common")), F.col("h") == F.col("item_h")))
    pairs = stored(met.select("doc_id", "item_id").distinct(), "leak-pairs")
    ids = small(pairs.select(F.col("doc_id").alias("_d")).distinct())
    texts = docs.join(ids, F.col("doc_id") == F.col("_d"), "left_semi").select("doc_id", words(F.col("text")).alias("w"))
    wanted = items.select("item_id", words(F.col("text")).alias("w")).select("item_id", shingles(F.col("w"), k).alias("wanted"))
    both = pairs.join(wanted, "item_id").join(texts.select("doc_id", shingles(F.col("w"), k).alias("s")), "doc_id")
    shared, size = F.size(F.array_intersect("wanted", "s")), F.size("wanted")
    rows = both.select("doc_id", "item_id", shared.alias("shared"), size.alias("size")).filter(F.col("shared") * den >= F.col("size") * num)
    return rows.groupBy("doc_id", "item_id").agg(F.max("shared").cast("long").alias("shared"), F.max("size").cast("long").alias("size"))


def without_items(docs: DataFrame, items: DataFrame, k: int = WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns."""
    d = free("_d", docs)
    leaks = contained(docs, items, k, threshold).select(F.col("doc_id").alias(d)).distinct()
    return docs.join(small(stored(leaks, "leaks")), F.col("doc_id") == F.col(d), "left_anti")
