"""A number for each different row, for operators that tell documents by id.

Tables may repeat a row, have one id on several texts, or rows without id.
``numbered`` puts a number in place of the id, one for each different (id, text),
so that an operator by id works by row.  The order of ids stays: the first text of
an id (by digest) has the id itself as number; the further texts of ids and the rows
without id, in order of id and digest, have numbers above the largest id.  Where no
room is left there, all are numbered anew, in the same order.  Only rows whose number
is not their id, or that are repeated, are joined; a table without such rows takes no
join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ids import dense_positions

from .common import free, small, stored

LARGEST = (1 << 63) - 1


def digest() -> Column:
    """16 bytes that name a text; null for a null text."""
    return F.unhex(F.md5(F.col("text").cast("string")))


def numbered(docs: DataFrame, largest: int = LARGEST) -> tuple[DataFrame, str, str]:
    """``docs`` with a number as ``doc_id``; and the names of two more columns: the
    id as it was, and whether the row (its id and text) is there more than once."""
    own, copied, t, d, n, i, f = (free(x, docs) for x in ("_own_id", "_copied", "_t", "_d", "_n", "_i", "_f"))
    as_long = F.col("doc_id").cast("long")
    docs = docs.withColumn(own, F.col("doc_id"))
    each = stored(docs.groupBy(as_long.alias(d), digest().alias(t)).agg((F.count("*") > 1).alias(copied)), "rows")
    first = each.filter(F.col(d).isNotNull()).groupBy(F.col(d).alias(i)).agg(F.min(F.struct(F.col(t).isNotNull().alias("s"), F.col(t).alias("t"))).alias("f"), F.count("*").alias("c"))
    # ids with several texts, and their first
    several = stored(first.filter("c > 1").select(i, F.col("f.t").alias(f)), "ids-of-several-texts")
    with_first = each.join(small(several), F.col(d) == F.col(i), "left")
    is_further = F.col(d).isNull() | (F.col(i).isNotNull() & ~F.col(t).eqNullSafe(F.col(f)))
    rows = stored(with_first.select(d, t, copied, is_further.alias("further")).filter(F.col("further") | F.col(copied)), "rows-by-number")
    if not rows.limit(1).count():
        return docs.withColumn("doc_id", as_long).withColumn(copied, F.lit(False)), own, copied
    order = F.struct("further", F.col(d).isNull().alias("n"), F.col(d).alias("d"), F.col(t).isNotNull().alias("s"), F.col(t).alias("t"))
    top = each.agg(F.max(d)).first()[0] or 0
    if top <= largest - rows.filter("further").count():
        further = dense_positions(rows.filter("further").withColumn("_order", order), "_order").withColumn(n, F.col("_pos") + F.lit(top))
        names = further.select(d, t, copied, n).unionByName(rows.filter("not further").select(d, t, copied, F.col(d).alias(n)))
    else:
        every = with_first.select(d, t, copied, is_further.alias("further")).withColumn("_order", order)
        names = dense_positions(every, "_order").select(d, t, copied, F.col("_pos").cast("long").alias(n))
    side = small(stored(names, "row-numbers"))
    named = docs.join(side, as_long.eqNullSafe(F.col(d)) & digest().eqNullSafe(F.col(t)), "left")
    kept = [F.coalesce(F.col(n), as_long).alias("doc_id") if c == "doc_id" else F.col(c) for c in docs.columns]
    return stored(named.select(*kept, F.coalesce(F.col(copied), F.lit(False)).alias(copied)), "numbered"), own, copied


def restored(rows: DataFrame, own: str, like: DataFrame) -> DataFrame:
    """``rows`` with the id as it was, and the columns of ``like``."""
    return rows.select(*[F.col(own).alias(c) if c == "doc_id" else F.col(c) for c in like.columns])
