"""Dense positions (1, 2, 3, ...) in a global order without a single-task window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Here the rows are range-partitioned on the order key and sorted inside each
partition, then checkpointed so partition ids are stable; a row's position is
its partition's offset (a running sum over per-partition counts -- one row per
partition, so that table is bounded by the partition count) plus its index
inside the partition (``monotonically_increasing_id`` low bits).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def dense_positions(df: DataFrame, order_col: str, out: str = "_pos") -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranged = df.repartitionByRange(order_col).sortWithinPartitions(order_col).checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    tagged = ranged.select("*", F.shiftright(mid, 33).alias("_pid"), (mid.bitwiseAND(F.lit(_LOW_BITS))).alias("_idx"))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_off"))
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(out, F.col("_off") + F.col("_idx") + F.lit(1))
        .drop("_pid", "_idx", "_off")
    )
