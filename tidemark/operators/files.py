"""Bookkeeping of expected daily files: what to fetch, per-file strikes, and
where a fetch run stops.

The reference does this in a single-machine download loop.  Here the loop's
state is rebuilt from tables: a calendar of expected files, the landed-file
table, a strike table, and a log of fetch attempts.

Attempt log schema: ``feed, filename, ts, seq, status`` where ``status`` is
the HTTP code (200 landed, 404 not found, anything else a failed request),
``-1`` for a request that raised, ``0`` for a file found already landed (no
request), and NULL for a file skipped because of its strikes (no request).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import as_of_date, daily_file_name
from tidemark.session import ensure_checkpoint_dir

# Look-back, strike limit and early-stop length of a run.
DAYS_BACK = 365
MAX_STRIKES = 2
EMPTY_RUN_LIMIT = 5


def expected_calendar(spark, as_of=None, days_back: int = DAYS_BACK) -> DataFrame:
    """Dates ``as_of - i`` for i in 0..days_back-1 with their position ``i``
    (a fixed-size calendar, not data)."""
    d = as_of_date(as_of)
    return spark.range(days_back).select(
        F.col("id").alias("days_back"), F.date_sub(d, F.col("id").cast("int")).alias("file_date")
    )


def missing_files(
    landed: DataFrame,
    strikes: DataFrame | None,
    as_of=None,
    days_back: int = DAYS_BACK,
    max_strikes: int = MAX_STRIKES,
) -> DataFrame:
    """Weekday files in the look-back window that are neither landed nor
    struck out (``strikes >= max_strikes``), in the order they are tried."""
    cal = expected_calendar(landed.sparkSession, as_of, days_back).filter(F.weekday("file_date") < 5)
    cal = cal.withColumn("filename", daily_file_name("file_date"))
    if strikes is not None:
        cal = cal.join(strikes.select("filename", "strikes"), "filename", "left")
    else:
        cal = cal.withColumn("strikes", F.lit(None).cast("int"))
    cal = cal.withColumn("strikes", F.coalesce(F.col("strikes"), F.lit(0)).cast("int"))
    # Strikes are tested before the landed check, as in the download loop.
    cal = cal.filter(F.col("strikes") < max_strikes)
    return cal.join(landed.select("filename").distinct(), "filename", "left_anti").select(
        "days_back", "file_date", "filename", "strikes"
    )


def read_strike_tracker(spark, path: str) -> DataFrame:
    """``(filename, strikes)`` from a JSON object file ``{filename: n}``; an
    absent or unreadable file counts as empty."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "filename string, strikes int")
    m = F.coalesce(F.from_json("value", "map<string,int>"), F.create_map().cast("map<string,int>"))
    return text.select(F.explode(m).alias("filename", "strikes"))


def write_strike_tracker(strikes: DataFrame, path: str) -> None:
    """Write the strike table back as one JSON object.  The table holds at most
    one entry per file of the look-back window, so one object is bounded."""
    obj = strikes.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("filename", "strikes")))).alias("value")
    )
    obj.coalesce(1).write.mode("overwrite").text(path)


def _order(a: DataFrame) -> Column:
    return F.struct("ts", "seq")


def strike_counts(attempts: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Strikes per file: 404s after the file's last 200 (a 200 clears the entry,
    other outcomes leave it unchanged), on top of the ``previous`` ``(filename,
    strikes)`` of a file without a 200.  Files with none are absent.

    Counts per (file, day) are combined map-side; a day after the one of the last
    200 counts whole, and only that one day's 404s are looked at again, so the rows
    of a file with a huge log are never brought together."""
    never = F.lit("0001-01-01").cast("date")
    day = lambda ts: F.coalesce(F.to_date(ts), never)
    tried = attempts.filter(F.col("status").isin(200, 404)).select("filename", "status", _order(attempts).alias("_at"), day(F.col("ts")).alias("_day"))
    days = tried.groupBy("filename", "_day").agg(
        F.count_if(F.col("status") == 404).alias("_n"), F.max(F.when(F.col("status") == 200, F.col("_at"))).alias("_ok")
    )
    cleared = days.filter(F.col("_ok").isNotNull()).groupBy("filename").agg(F.max("_ok").alias("_ok"))
    cleared = cleared.select("filename", "_ok", day(F.col("_ok")["ts"]).alias("_ok_day"))
    whole = days.drop("_ok").join(cleared, "filename", "left").filter(F.col("_ok").isNull() | (F.col("_day") > F.col("_ok_day")))
    on = ["filename", "_day"]
    part = tried.filter(F.col("status") == 404).join(cleared.withColumnRenamed("_ok_day", "_day"), on).filter(F.col("_at") > F.col("_ok"))
    parts = whole.select("filename", "_n").unionByName(part.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).select("filename", "_n"))
    if previous is not None:
        kept = previous.join(cleared, "filename", "left_anti")
        parts = parts.unionByName(kept.select("filename", F.col("strikes").cast("long").alias("_n")))
    return parts.groupBy("filename").agg(F.sum("_n").cast("int").alias("strikes")).filter(F.col("strikes") > 0)


def fetch_window_rows(attempts: DataFrame, limit: int = EMPTY_RUN_LIMIT) -> DataFrame:
    """Attempt rows with ``run_before`` (empty days in a row before this row)
    and ``made`` (false from the first row reached with ``run_before >=
    limit``: the run stopped there).  200 and already-landed reset the run;
    404, other codes and errors extend it; strike-skipped rows leave it.

    A segmented scan, so one feed with a huge log never sits in one task:

    1. range-partition by (feed, ts, seq) and checkpoint -- a hot feed spans
       many partitions; a (partition, feed) pair is a *segment*.  The
       checkpoint fixes which row is in which partition: a recomputed range
       exchange re-samples its bounds (the sample seed depends on the RDD id)
       and could move rows between segments;
    2. scan each segment locally (windows by segment);
    3. fold the segments of each feed in order on a small per-segment table
       (one row per segment) to get the run entering each segment;
    4. add that carry back, then cut each feed at its first row with
       ``run_before >= limit`` (a per-feed minimum, aggregated map-side).
    """
    spark = attempts.sparkSession
    ensure_checkpoint_dir(spark)
    n = max(1, spark.sparkContext.defaultParallelism)
    order = ["ts", "seq"]
    reset = F.coalesce(F.col("status").isin(200, 0), F.lit(False))
    empty = F.col("status").isNotNull() & ~reset
    srt = attempts.repartitionByRange(n, "feed", *order).checkpoint()
    a = srt.withColumn("_pid", F.spark_partition_id()).withColumn("_r", reset.cast("int")).withColumn(
        "_e", empty.cast("int")
    )

    # 2. local scan per segment.  A row's island is the number of resets
    # strictly before it, so a reset row closes the previous island and
    # run_before is "empties earlier in my island" (+ the carry in island 0).
    seg = Window.partitionBy("_pid", "feed").orderBy(*order)
    before = seg.rowsBetween(Window.unboundedPreceding, -1)
    a = a.withColumn("_isl", F.coalesce(F.sum("_r").over(before), F.lit(0)))
    isl = Window.partitionBy("_pid", "feed", "_isl").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    a = a.withColumn("_prior", F.coalesce(F.sum("_e").over(isl), F.lit(0)))
    # empties since the last reset up to and including this row
    a = a.withColumn("_since", F.when(F.col("_r") == 1, F.lit(0)).otherwise(F.col("_prior") + F.col("_e")))
    a = a.checkpoint()  # the one shuffle of the attempt rows; every branch below reads this

    # 3. per-segment summary and the carry entering each segment
    summary = a.groupBy("_pid", "feed").agg(
        (F.max("_r") > 0).alias("_has_reset"),
        F.sum("_e").alias("_tot"),
        F.max_by("_since", F.struct(*order)).alias("_tail"),
    )
    by_feed = Window.partitionBy("feed").orderBy("_pid")
    upto_prev = by_feed.rowsBetween(Window.unboundedPreceding, -1)
    cum_before = F.coalesce(F.sum("_tot").over(upto_prev), F.lit(0))
    summary = summary.withColumn("_cum_incl", F.sum("_tot").over(by_feed.rowsBetween(Window.unboundedPreceding, 0)))
    last_reset = F.last(
        F.when(F.col("_has_reset"), F.struct(F.col("_tail").alias("tail"), F.col("_cum_incl").alias("cum"))),
        ignorenulls=True,
    ).over(upto_prev)
    carry = (
        summary.withColumn("_lr", last_reset)
        .withColumn(
            "_carry",
            F.when(F.col("_lr").isNull(), cum_before).otherwise(F.col("_lr.tail") + cum_before - F.col("_lr.cum")),
        )
        .select("_pid", "feed", "_carry")
    )

    # 4. run values with the carry, then the per-feed cut (small tables only
    # are joined back, on the segment key)
    # keys are null-safe: rows of a NULL feed are a feed of their own
    own = carry.select(F.col("_pid").alias("_p"), F.col("feed").alias("_f"), "_carry")
    a = a.join(own, (F.col("_pid") == F.col("_p")) & F.col("feed").eqNullSafe(F.col("_f"))).drop("_p", "_f").withColumn(
        "run_before", F.col("_prior") + F.when(F.col("_isl") == 0, F.col("_carry")).otherwise(F.lit(0))
    )
    cut = a.filter(F.col("run_before") >= limit).groupBy("feed").agg(F.min(F.struct(*order)).alias("_cut"))
    cut = cut.withColumnRenamed("feed", "_f")
    seg_cut = carry.select(F.col("_pid").alias("_p"), F.col("feed").alias("_g")).join(cut, F.col("_g").eqNullSafe(F.col("_f"))).drop("_f")
    a = a.join(seg_cut, (F.col("_pid") == F.col("_p")) & F.col("feed").eqNullSafe(F.col("_g")), "left").drop("_p", "_g")
    made = F.col("_cut").isNull() | (F.struct(*order) < F.col("_cut"))
    return a.withColumn("made", made).drop("_pid", "_r", "_e", "_isl", "_prior", "_since", "_carry", "_cut")


def fetch_window(attempts: DataFrame, limit: int = EMPTY_RUN_LIMIT) -> DataFrame:
    """Per feed: rows before the stop, whether the run reached ``limit``, and
    the first row not made."""
    rows = fetch_window_rows(attempts, limit)
    made = F.col("made")
    return rows.groupBy("feed").agg(
        F.count(F.when(made, F.lit(1))).alias("rows_made"),
        F.max(F.when(made, F.col("run_before") + F.when(
            F.col("status").isNotNull() & ~F.col("status").isin(200, 0), 1).otherwise(0))).alias("_peak"),
        F.min(F.when(~made, F.struct("ts", "seq"))).alias("_stop"),
    ).select(
        "feed",
        "rows_made",
        (F.coalesce(F.col("_peak"), F.lit(0)) >= limit).alias("reached_limit"),
        F.col("_stop.ts").alias("stop_ts"),
        F.col("_stop.seq").alias("stop_seq"),
    )
