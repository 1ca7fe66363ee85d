"""Silver layer: typed daily bars and the weekly checks computed from them.

Scale notes
-----------
Bars hold one row per (symbol, trading day), so the rows of one symbol are
bounded by the calendar (about 250 a year) no matter how large the raw feed
is, and hashing by symbol is skew-safe.  Every weekly step is a window
partitioned by ``symbol`` alone (``weekly_rows``), so Spark inserts a single
exchange by symbol per branch -- none when the bars are already partitioned
or bucketed by symbol -- and the signal queries compute both checks in one
branch (``weekly_stats``).

Frames count traded weeks (rows), never calendar time, so history is never
pruned by date before a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import (
    as_of_date,
    exact_decimal_mean,
    flag,
    round_half_away,
    week_start,
)

BAR_COLUMNS = [
    "symbol",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "TTL_TRD_QNTY",
    "DELIV_QTY",
    "_file_date",
]

MA_COLUMN = "50w_Moving_avg"


# --------------------------------------------------------------------------- L1
def _price(c: str, lenient: bool) -> Column:
    v = F.nullif(F.trim(F.col(c)), F.lit(""))
    return v.try_cast("decimal(12,2)") if lenient else v.cast("decimal(12,2)")


def _quantity(c: str, lenient: bool) -> Column:
    # Text to BIGINT rounding half away from zero ('12.5' -> 13, '1e3' -> 1000)
    # instead of failing on a fractional value.
    v = F.nullif(F.trim(F.col(c)), F.lit(""))
    if lenient:
        return F.round(v.try_cast("decimal(38,6)"), 0).try_cast("bigint")
    return F.round(v.cast("decimal(38,6)"), 0).cast("bigint")


def clean_bars(bronze: DataFrame, lenient: bool = False) -> DataFrame:
    """Typed bars from bronze rows: trimmed symbol, prices as DECIMAL(12,2),
    quantities as BIGINT, series EQ only, file date present.

    ``lenient=False`` raises on text that does not convert (before anything is
    written); ``lenient=True`` turns it into NULL instead."""
    return bronze.filter((F.trim(F.col("SERIES")) == "EQ") & F.col("_file_date").isNotNull()).select(
        F.trim(F.col("SYMBOL")).alias("symbol"),
        _price("OPEN_PRICE", lenient).alias("open_price"),
        _price("HIGH_PRICE", lenient).alias("high_price"),
        _price("LOW_PRICE", lenient).alias("low_price"),
        _price("CLOSE_PRICE", lenient).alias("close_price"),
        _quantity("TTL_TRD_QNTY", lenient).alias("TTL_TRD_QNTY"),
        _quantity("DELIV_QTY", lenient).alias("DELIV_QTY"),
        F.col("_file_date"),
    )


_TEXT_COLUMNS = {
    "open_price": "OPEN_PRICE",
    "high_price": "HIGH_PRICE",
    "low_price": "LOW_PRICE",
    "close_price": "CLOSE_PRICE",
    "TTL_TRD_QNTY": "TTL_TRD_QNTY",
    "DELIV_QTY": "DELIV_QTY",
}


def loss_counts() -> list[Column]:
    """Per column, the number of non-blank texts that ``lenient=True`` turns into NULL,
    as aggregates over bronze rows (for ``agg`` or ``observe``)."""
    kept = (F.trim(F.col("SERIES")) == "EQ") & F.col("_file_date").isNotNull()
    out = []
    for name, src in _TEXT_COLUMNS.items():
        conv = _price(src, True) if name.endswith("price") else _quantity(src, True)
        lost = F.nullif(F.trim(F.col(src)), F.lit("")).isNotNull() & conv.isNull()
        out.append(F.count(F.when(kept & lost, F.lit(1))).alias(name))
    return out


def clean_bars_losses(bronze: DataFrame) -> DataFrame:
    """``loss_counts`` of a bronze table (one aggregation, combined map-side)."""
    return bronze.agg(*loss_counts())


# ------------------------------------------------------------------ shared steps
def through_week(bars: DataFrame, as_of=None) -> DataFrame:
    """Keep bars whose week is not after the week of ``as_of`` (the current
    week is kept).  Written as ``_file_date < Monday after`` -- the same rows
    as comparing week starts, but a plain bound on the column that folds to a
    literal and reaches the Parquet scan (row-group and partition pruning)."""
    return bars.filter(F.col("_file_date") < F.date_add(week_start(as_of_date(as_of)), 7))


def _by_week() -> Window:
    return Window.partitionBy("symbol").orderBy("week_start")


def _same_week() -> Window:
    return _by_week().rangeBetween(Window.currentRow, Window.currentRow)


def weekly_rows(bars: DataFrame, as_of=None) -> DataFrame:
    """Bars up to the run week with their week's total quantity and last date.

    The per-week values are windows partitioned by ``symbol`` alone (a RANGE
    frame over equal ``week_start`` peers), so every weekly step downstream
    shares one hash exchange by symbol, inserted by Spark -- or none when the
    bars are already partitioned or bucketed by symbol."""
    return (
        through_week(bars, as_of)
        .select("symbol", "_file_date", "close_price", "TTL_TRD_QNTY", week_start("_file_date").alias("week_start"))
        .withColumn("_week_sum", F.sum("TTL_TRD_QNTY").over(_same_week()))
        .withColumn("_week_end", F.max("_file_date").over(_same_week()))
    )


def named(bars: DataFrame) -> DataFrame:
    """Bars with a symbol."""
    return bars.filter(F.col("symbol").isNotNull())


def _first_of_week() -> Column:
    """True on exactly one row per (symbol, week)."""
    prev = F.lag("week_start").over(Window.partitionBy("symbol").orderBy("week_start", "_file_date"))
    return F.coalesce(prev != F.col("week_start"), F.lit(True))


def anchor_date(bars: DataFrame, as_of=None) -> Column:
    """Latest bar date up to the week of ``as_of``, as an uncorrelated scalar
    subquery (computed once, then used as a literal).  It equals both the
    latest weekly-close date and the latest week-end date.  It reads only the
    date column and aggregates map-side: no shuffle of the bars."""
    return through_week(bars, as_of).agg(F.max("_file_date")).scalar()


def market_week_ends(bars: DataFrame, as_of=None) -> DataFrame:
    """One row per calendar week: the last date any symbol traded in it.
    Bounded by the calendar (52 rows a year), partial-aggregated before its
    (tiny) shuffle."""
    return (
        through_week(bars, as_of)
        .groupBy(week_start("_file_date").alias("week_start"))
        .agg(F.max("_file_date").alias("_file_date"))
    )


# ----------------------------------------------------------------------- E2 / E1
def weekly_volume(bars: DataFrame, as_of=None) -> DataFrame:
    """Per (symbol, week): last traded date and summed quantity.  Combined map-side,
    so the bars without symbol, or of a much traded one, are a row a week and task."""
    return (
        through_week(bars, as_of)
        .groupBy("symbol", week_start("_file_date").alias("week_start"))
        .agg(F.max("_file_date").alias("week_end_date"), F.sum("TTL_TRD_QNTY").alias("weekly_sum"))
    )


def weekly_close(bars: DataFrame, as_of=None) -> DataFrame:
    """Bars on each symbol's last trading date of each week.  A duplicated
    (symbol, date) bar yields two rows, as the self-join form would; a bar
    without symbol has no close, as in an equi-join."""
    return (
        weekly_rows(named(bars), as_of)
        .filter(F.col("_file_date") == F.col("_week_end"))
        .select("symbol", "week_start", "_file_date", "close_price")
    )


# --------------------------------------------------------------------------- L2
def surge_stats(bars: DataFrame, as_of=None, factor=3, weeks: int = 26) -> DataFrame:
    """Every (symbol, week) with the mean weekly volume of the ``weeks`` traded
    weeks before it and the surge flag."""
    w = Window.partitionBy("symbol").orderBy("week_start").rowsBetween(-weeks, -1)
    avg = F.avg("weekly_sum").over(w)
    return (
        weekly_volume(bars, as_of)
        .withColumn("_avg", avg)
        .select(
            "symbol",
            "week_start",
            F.col("week_end_date").alias("_file_date"),
            F.col("weekly_sum").alias("TTL_TRD_QNTY"),
            round_half_away("_avg", 0).alias("avg_vol_180d"),
            flag(F.col("weekly_sum") > F.lit(factor) * F.col("_avg")).alias("IS_3X_SURGE"),
        )
    )


def volume_surge_check(bars: DataFrame, as_of=None, factor=3, weeks: int = 26) -> DataFrame:
    """Weekly volume against ``factor`` x its mean over the prior ``weeks``
    traded weeks, for the rows whose week ends on the anchor date, the last date of
    all bars, with or without symbol.  A symbol that did not trade on the anchor
    date is absent."""
    return (
        surge_stats(bars, as_of, factor, weeks)
        .filter(F.col("_file_date") == anchor_date(bars, as_of))
        .drop("week_start")
    )


# --------------------------------------------------------------------------- L3
def breakout_stats(bars: DataFrame, as_of=None, high_weeks: int = 26, ma_weeks: int = 50) -> DataFrame:
    """Every weekly close with the highest close of the prior ``high_weeks``
    weekly closes, the ``ma_weeks`` moving average and the breakout flag."""
    w = Window.partitionBy("symbol").orderBy("_file_date")
    prior_high = F.max("close_price").over(w.rowsBetween(-high_weeks, -1))
    mean = exact_decimal_mean("close_price", w.rowsBetween(-(ma_weeks - 1), 0))
    return (
        weekly_close(bars, as_of)
        .withColumn("prev_180d_friday_high", prior_high)
        .withColumn(MA_COLUMN, round_half_away(mean, 2))
        .select(
            "symbol",
            "week_start",
            "_file_date",
            "close_price",
            "prev_180d_friday_high",
            MA_COLUMN,
            flag(F.col("close_price") > F.col("prev_180d_friday_high")).alias("IS_BREAKOUT"),
        )
    )


def price_breakout_check(bars: DataFrame, as_of=None, high_weeks: int = 26, ma_weeks: int = 50) -> DataFrame:
    """Weekly close above the prior 26-week high, for rows on the anchor date."""
    return (
        breakout_stats(bars, as_of, high_weeks, ma_weeks)
        .filter(F.col("_file_date") == anchor_date(named(bars), as_of))
        .drop("week_start")
    )


def moving_average_50w(bars: DataFrame, as_of=None, ma_weeks: int = 50) -> DataFrame:
    """The moving average of weekly closes for every weekly close."""
    return breakout_stats(bars, as_of, ma_weeks=ma_weeks).select(
        "symbol", "_file_date", "close_price", MA_COLUMN
    )


# ------------------------------------------------------------ L2 + L3 fused
def weekly_stats(
    bars: DataFrame, as_of=None, factor=3, weeks: int = 26, high_weeks: int = 26, ma_weeks: int = 50
) -> DataFrame:
    """Both checks for every weekly close in ONE pass over the bars.

    Every window is partitioned by ``symbol`` alone (per-week values use a
    RANGE frame over the equal ``week_start`` peers), so Spark needs a single
    hash exchange by symbol -- and none at all when the bars are already
    partitioned or bucketed by symbol.

    Rows are the weekly closes (duplicates kept).  Each carries its week's
    total volume; the surge mean averages only the first row of each prior
    week over a RANGE frame on a dense week number, so it is the mean of the
    prior ``weeks`` traded weeks exactly as the per-week table gives it, and
    the breakout frames count weekly-close rows as before.  Joining the two
    separate checks on (symbol, _file_date) yields the same rows."""
    by_date = Window.partitionBy("symbol").orderBy("_file_date")
    closes = (
        weekly_rows(named(bars), as_of)
        .filter(F.col("_file_date") == F.col("_week_end"))
        .withColumn("_first", _first_of_week())
        .withColumn("_wk", F.dense_rank().over(_by_week()))
    )
    prior = Window.partitionBy("symbol").orderBy("_wk").rangeBetween(-weeks, -1)
    avg = F.avg(F.when(F.col("_first"), F.col("_week_sum"))).over(prior)
    mean = exact_decimal_mean("close_price", by_date.rowsBetween(-(ma_weeks - 1), 0))
    return (
        closes.withColumn("_avg", avg)
        .withColumn("prev_180d_friday_high", F.max("close_price").over(by_date.rowsBetween(-high_weeks, -1)))
        .withColumn(MA_COLUMN, round_half_away(mean, 2))
        .select(
            "symbol",
            "week_start",
            "_file_date",
            F.col("_week_sum").alias("TTL_TRD_QNTY"),
            round_half_away("_avg", 0).alias("avg_vol_180d"),
            flag(F.col("_week_sum") > F.lit(factor) * F.col("_avg")).alias("IS_3X_SURGE"),
            "close_price",
            "prev_180d_friday_high",
            MA_COLUMN,
            flag(F.col("close_price") > F.col("prev_180d_friday_high")).alias("IS_BREAKOUT"),
        )
    )


# --------------------------------------------------------------------------- L4
def delivery_weekly_check(bars: DataFrame, min_pct: float = 50.0) -> DataFrame:
    """Weekly delivered share of traded quantity, weeks above ``min_pct``.
    A week with zero traded quantity has no share and is dropped."""
    pct = F.sum("DELIV_QTY") * F.lit(100.0) / F.nullif(F.sum("TTL_TRD_QNTY"), F.lit(0))
    return (
        bars.groupBy("symbol", week_start("_file_date").alias("week_start"))
        .agg(pct.alias("weekly_deliv_per"))
        .filter(F.col("weekly_deliv_per") > F.lit(float(min_pct)))
    )
