"""Session construction and the shared scratch folder.

Intermediate tables and streaming checkpoints go under the folder the cluster
names in ``spark.checkpoint.dir`` (a shared filesystem on a real cluster).  Only
when that setting is absent -- local tests -- do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def get_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app: str = "tidemark",
    driver_memory: str | None = None,
) -> SparkSession:
    """A session configured the way the library is tested (UTC, AQE on, UI off).
    In local mode every task runs inside the driver JVM, so ``driver_memory``
    is its whole heap (Spark's default is 1g)."""
    builder = SparkSession.builder
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = (
        builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder (set on the context for ``checkpoint()``)."""
    conf = spark.sparkContext.getConf()
    path = spark.conf.get(_CKPT_KEY, None) or conf.get(_CKPT_KEY, None)
    if not path:
        # Executors of a cluster do not see a folder of the driver's machine.
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {_CKPT_KEY} to a shared folder on master {spark.sparkContext.master}")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set(_CKPT_KEY, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
