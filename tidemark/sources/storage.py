"""Files beside the tables: a few calls to the file system that Spark itself uses,
so that they work wherever the tables are."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def on_disk(spark: SparkSession, path: str) -> str | None:
    """The path on a disk that the driver and all tasks see as files; None elsewhere."""
    p, fs = _path(spark, path)
    return p.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, time of change in ms) of what is in a folder; none if it is absent."""
    p, fs = _path(spark, folder)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _path(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a file by one rename; false if there is one of that name already."""
    p, fs = _path(spark, path)
    fs.mkdirs(p.getParent())
    draft = f"{path}.draft-{spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()}"
    write_text(spark, draft, text)
    if fs.exists(p) or not fs.rename(_path(spark, draft)[0], p):
        delete(spark, draft)
        return False
    return True
