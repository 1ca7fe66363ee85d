"""Landing zone: raw daily files as rows ``(filename, content, loaded_at)``.

A landing directory holds either flat files (``sec_bhavdata_full_<ddMMyyyy>.csv``)
or Hive-style folders ``filename=<name>/part-*`` as written by
``write_landing``; both read as one row per file (``wholetext``), named by
the folder when present, else by the file.  Reading is file-parallel.

The raw-file table has a key on ``filename``; Spark enforces none, so the
listing of a landing directory is de-duplicated and anti-joined by name against the
table before any file is opened.
"""

from __future__ import annotations

import itertools
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import storage

RAW_COLUMNS = ["filename", "content", "loaded_at"]


_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks for each core; Spark's own number is a task for
    each folder up to 10,000, which takes longer than the listing."""
    before = spark.conf.get(_LISTING_TASKS)
    spark.conf.set(_LISTING_TASKS, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING_TASKS, before)


def landed_name(path: Column, name: Column) -> Column:
    """File name of a landed file: the ``filename=`` folder if present, else
    the file's own name."""
    from_dir = F.regexp_extract(path, r"filename=([^/]+)/[^/]*$", 1)
    return F.when(from_dir != "", F.url_decode(from_dir)).otherwise(name)


def read_landing(spark: SparkSession, landing_dir: str, modified_after: str | None = None) -> DataFrame:
    """Every file in ``landing_dir`` as ``(filename, content)``.  A landing
    directory only grows, so a scheduled run can pass ``modified_after``
    (``yyyy-MM-ddTHH:mm:ss``) to skip older files at listing time instead of
    reading their contents and anti-joining them away."""
    reader = spark.read.option("recursiveFileLookup", True)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    with few_listing_tasks(spark):
        df = reader.text(landing_dir, wholetext=True)
    return df.select(
        landed_name(F.col("_metadata.file_path"), F.col("_metadata.file_name")).alias("filename"),
        F.col("value").alias("content"),
    )


def list_landing(spark: SparkSession, landing_dir: str, modified_after: str | None = None) -> DataFrame:
    """``(path, filename, modified, bytes)`` of the files in ``landing_dir``; what is in
    them is not read, as the content column of this source is pruned."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    with few_listing_tasks(spark):
        files = reader.load(landing_dir)
    return files.select(
        "path",
        landed_name(F.col("_metadata.file_path"), F.col("_metadata.file_name")).alias("filename"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
    )


def new_listing(listing: DataFrame, existing: DataFrame | None) -> DataFrame:
    """The listed files to land under the key on ``filename``: one for each name that
    is not in ``existing``.  Names alone are compared."""
    new = listing.groupBy("filename").agg(F.min("path").alias("path"))
    if existing is not None:
        new = new.join(existing.select("filename").distinct(), "filename", "left_anti")
    return new


def read_files(spark: SparkSession, landing_dir: str, paths: list[str]) -> DataFrame:
    """``(filename, content)`` of some files of a landing directory."""
    if not paths:
        return spark.createDataFrame([], "filename string, content string")
    # names are no patterns
    plain = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]
    # one text for all paths, as a list goes to the JVM by a call for each
    listed = spark.sparkContext._jvm.org.apache.hadoop.util.StringUtils.getStringCollection("\0".join(plain), "\0")
    with few_listing_tasks(spark):
        df = spark.read.text(listed, wholetext=True)
    return df.select(
        landed_name(F.col("_metadata.file_path"), F.col("_metadata.file_name")).alias("filename"),
        F.col("value").alias("content"),
    )


def land_files(
    spark: SparkSession,
    landing_dir: str,
    existing: DataFrame | None = None,
    loaded_at: Column | None = None,
    modified_after: str | None = None,
) -> DataFrame:
    """New raw-file rows from a landing directory (names not yet in ``existing``).

    The directory is listed, the list is compared by name, and only files that are new
    are opened.  The driver holds the new files' paths, as it does for any scan."""
    new = new_listing(list_landing(spark, landing_dir, modified_after), existing)
    rows = read_files(spark, landing_dir, new.select("path").toArrow()["path"].to_pylist())
    return rows.select("filename", "content", (loaded_at if loaded_at is not None else F.current_timestamp()).alias("loaded_at"))


#: Characters that are no part of a folder's name, as Spark's writers have it.
_NOT_IN_NAMES = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def _folder(filename: str | None) -> str:
    """The folder of a landed file (Spark's form, which ``landed_name`` reads)."""
    name = _NOT_IN_NAMES.sub(lambda c: f"%{ord(c[0]):02X}", filename or "")
    return f"filename={name or '__HIVE_DEFAULT_PARTITION__'}"


def _as_files(root: str, run: str):
    """Files written by a task, each under another name until it is whole; a task that is
    tried again puts the same files in their place."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = f"part-{TaskContext.get().partitionId():05d}-{run}.txt", 0
        rows = ((f.as_py(), c.as_py()) for b in batches for f, c in zip(b["filename"], b["content"].cast(pa.large_binary()), strict=True))
        for filename, own in itertools.groupby(rows, lambda r: r[0]):
            folder = f"{root}/{_folder(filename)}"
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/.{part}", "wb") as f:
                f.writelines((content or b"") + b"\n" for _, content in own)
            os.replace(f"{folder}/.{part}", f"{folder}/{part}")
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return write


def write_landing(raw: DataFrame, landing_dir: str) -> None:
    """Write raw files as a landing directory, one folder per file name.  The
    text writer ends each file with a newline, so one trailing newline is
    taken off first and the file reads back exactly.  On a disk that the tasks see, they
    write the files themselves, as Hadoop's local file system starts a process for each
    file to set its mode; other file systems get them from Spark's writer."""
    spark = raw.sparkSession
    body = F.regexp_replace(F.col("content"), r"\n\z", "")
    # Spread files over all cores: each task writes whole files, so an
    # explicit count keeps AQE from packing every file into one writer.  They are not dealt
    # out by the name's own hash: files of one task are of one time, so the shuffle by name
    # of a stream's batch would put them into one task again.
    n = spark.sparkContext.defaultParallelism
    rows = raw.select(F.col("filename").cast("string").alias("filename"), body.alias("content")).repartition(n, F.xxhash64("filename"))
    root = storage.on_disk(spark, landing_dir)
    if root is None:
        rows.write.mode("append").partitionBy("filename").text(landing_dir)
        return
    os.makedirs(root, exist_ok=True)
    rows.sortWithinPartitions("filename").mapInArrow(_as_files(root, uuid.uuid4().hex), "n long").agg(F.sum("n")).collect()


def pending_files(raw: DataFrame, bronze: DataFrame) -> DataFrame:
    """Raw files whose name is not yet a bronze ``_source_file``.  The bronze
    side is reduced to distinct names (partial aggregation) before the anti
    join, so only one row per file crosses the shuffle."""
    done = bronze.select(F.col("_source_file").alias("filename")).distinct()
    return raw.join(done, "filename", "left_anti").select(*raw.columns)
