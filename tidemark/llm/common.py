"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, scratch_dir
from tidemark.sources.storage import delete

#: Rows of two or three short columns that may be broadcast; larger sides take a shuffle join.
BROADCAST_ROWS = 500_000


#: Rows of a batch of texts, where a task holds little else (``few_rows``).
ARROW_ROWS = 1000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Spark's setting that deletes an execution's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def having(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """What is executed has this setting; the session's own is put back."""
    own = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, own)


def shuffles_dropped(spark: SparkSession):
    """The shuffle files of what is executed go when it ends, not when the driver happens
    to collect its garbage."""
    return having(spark, _CLEANUP, "true")


def few_rows(spark: SparkSession):
    """Texts of what is executed go to Python ``ARROW_ROWS`` at a time: the batches are
    memory of an executor outside its heap."""
    own = int(spark.conf.get(_ARROW_ROWS))
    return having(spark, _ARROW_ROWS, str(min(own, ARROW_ROWS) if own > 0 else ARROW_ROWS))


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to a fresh table in the shared scratch folder and read
    back: its lineage is cut, and a lost executor costs no recomputation."""
    path = scratch_dir(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` as a catalog table in the shared scratch folder, dealt out by ``key``: joins
    by it move the other side alone.  ``df`` is a ``stored`` table, which is dropped."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, name)
    table = "tidemark_" + path.rsplit("/", 1)[1].replace("-", "_")
    with shuffles_dropped(spark):
        df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    dropped(df)
    return spark.table(table)


def dropped(*tables: DataFrame) -> None:
    """Deletes ``stored`` tables from which everything wanted has been stored anew."""
    for t in tables:
        delete(t.sparkSession, t.stored_at)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches, some rows at a time, so that a task never holds copies of the texts of
    a whole batch; memory that Arrow keeps for later is given back at the end."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
    pa.default_memory_pool().release_unused()


def free(name: str, df: DataFrame) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to be small; any larger
    ``df`` is left to a shuffle join.  ``df`` should be cheap to count."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


__all__ = ["BROADCAST_ROWS", "bucketed", "dropped", "ensure_checkpoint_dir", "few_rows", "free", "having", "scratch_dir", "shuffles_dropped", "slices", "small", "stored", "table"]
