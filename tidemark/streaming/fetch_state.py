"""Strikes and the early stop of fetch runs as state of a stream.

Attempts arrive in batches.  Of each feed the stream keeps the run of empty days, what
was made, where it stopped, and the strikes of its files with the time of their last
change; strikes older than ``keep_days`` before the feed's latest attempt expire, so the
state of a feed has at most one entry for each file of the look-back.  A batch is put
into order by (ts, seq); batches count in the order in which they come.

The rules are those of ``operators.files``: 200 and found-landed (0) end a run of empty
days, other outcomes lengthen it, and a skipped file (NULL) leaves it; from ``limit`` on
nothing more is made.  A 404 is a strike of its file, a 200 clears them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.files import DAYS_BACK, EMPTY_RUN_LIMIT
from tidemark.sources import storage

_STATE = "run int, made long, reached boolean, stop_ts timestamp, stop_seq long, files array<string>, strikes array<int>, seen array<timestamp>"
_ROW = "feed string, rows_made long, reached_limit boolean, stop_ts timestamp, stop_seq long, strikes map<string,int>"


def _step(limit: int, keep_days: int):
    keep = pd.Timedelta(days=keep_days)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            run, made, reached, stop_ts, stop_seq, names, counts, times = state.get
            strikes = {f: (n, t) for f, n, t in zip(names, counts, times, strict=True)}
        else:
            run, made, reached, stop_ts, stop_seq, strikes = 0, 0, False, None, None, {}
        latest = max((t for _, t in strikes.values()), default=None)
        batch = pd.concat(list(parts)).sort_values(["ts", "seq"])
        for ts, seq, name, status in zip(batch["ts"], batch["seq"], batch["filename"], batch["status"], strict=True):
            tried = not pd.isna(status)
            if reached:
                stop_ts, stop_seq = (stop_ts, stop_seq) if stop_ts is not None else (ts, int(seq))
            else:
                made += 1
                if tried:
                    run = 0 if status in (200, 0) else run + 1
                    reached = run >= limit
            if tried and status == 404:
                strikes[name] = (strikes.get(name, (0, ts))[0] + 1, ts)
            elif tried and status == 200:
                strikes.pop(name, None)
            latest = ts if latest is None else max(latest, ts)
        strikes = {f: (n, t) for f, (n, t) in strikes.items() if latest - t <= keep}
        state.update((run, made, reached, stop_ts, stop_seq, list(strikes), [n for n, _ in strikes.values()], [t for _, t in strikes.values()]))
        row = {"feed": [key[0]], "rows_made": [made], "reached_limit": [reached], "stop_ts": [stop_ts], "stop_seq": [stop_seq], "strikes": [{f: n for f, (n, _) in strikes.items()}]}
        yield pd.DataFrame(row).astype({"stop_seq": "Int64", "stop_ts": "datetime64[us]"})

    return step


def fetch_state(attempts: DataFrame, limit: int = EMPTY_RUN_LIMIT, keep_days: int = DAYS_BACK) -> DataFrame:
    """A streaming ``attempts`` (feed, filename, ts, seq, status) to the state of the
    feeds that a batch touches."""
    own = attempts.select("feed", "filename", F.col("ts").cast("timestamp").alias("ts"), F.col("seq").cast("long").alias("seq"), "status")
    return own.groupBy("feed").applyInPandasWithState(_step(limit, keep_days), _ROW, _STATE, "update", GroupStateTimeout.NoTimeout)


def run_fetch_state(spark: SparkSession, log_dir: str, schema: str, out_dir: str, checkpoint_dir: str, **options: int) -> None:
    """Takes up what is new in a folder of attempt logs and stores the state of the
    feeds it touches, a folder for each batch; a batch that is replayed is written anew."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch-{batch_id:012d}")

    log = spark.readStream.schema(schema).parquet(log_dir)
    query = fetch_state(log, **options).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
    query.awaitTermination()


def latest_state(spark: SparkSession, out_dir: str) -> DataFrame:
    """The last state of each feed."""
    found = [n for n, _ in storage.names(spark, out_dir) if n.startswith("batch-")]
    if not found:
        return spark.createDataFrame([], _ROW)
    rows = spark.read.schema(_ROW).parquet(*[f"{out_dir}/{n}" for n in found])
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/batch-(\d+)/", 1)
    cols = ["rows_made", "reached_limit", "stop_ts", "stop_seq", "strikes"]
    last = rows.select("feed", F.struct(number.alias("batch"), F.struct(*cols).alias("s")).alias("x")).groupBy("feed").agg(F.max_by("x.s", "x.batch").alias("s"))
    return last.select("feed", *[F.col(f"s.{c}").alias(c) for c in cols])
