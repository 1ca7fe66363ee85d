"""Registered queries: ``name -> (spark callable, DuckDB oracle SQL or None)``.

Every callable takes ``(spark, sf_dir)``, reads the driver's tables through
the fixture mappings and returns a DataFrame; those that write their input or state first
(landing folders, lakes, indexes, streams) run jobs when they are built.  Run dates are explicit
literals (the reference uses "today"); the chosen dates are the ones
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import file_date_from_name, previous_business_day
from tidemark.operators import files, gold, serve, silver, watchlist, weekly_state
from tidemark.plans import oracle as O
from tidemark.plans import pipeline
from tidemark.plans.lake import Lake
from tidemark.session import scratch_dir
from tidemark.sources import bhavcopy, landing, widgets
from tidemark.sources import fixtures as X
from tidemark.streaming import fetch_state, ingest

# Latest ship date at every scale: the default anchor.
LATEST = "2001-11-04"
# The first batch of attempts has those before this time.
ATTEMPTS_UNTIL = "2024-01-16"
# Latest market week end with a factor-3 signal at sf0.01.
SIGNAL_AS_OF = "2000-07-16"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ------------------------------------------------------------ silver (X1 bars)
@register(
    "weekly_volume",
    f"WITH {O.bars_cte()}, {O.silver_ctes('bars', LATEST)}\n"
    "SELECT symbol, week_start, week_end_date, weekly_sum FROM week_volume",
)
def q_weekly_volume(spark, sf):
    return silver.weekly_volume(X.bars(spark, sf), LATEST)


@register(
    "weekly_close",
    f"WITH {O.bars_cte()}, {O.silver_ctes('bars', LATEST)}\n"
    "SELECT symbol, CAST(date_trunc('week', _file_date) AS DATE) AS week_start, _file_date, close_price "
    "FROM week_close",
)
def q_weekly_close(spark, sf):
    return silver.weekly_close(X.bars(spark, sf), LATEST)


@register(
    "volume_surge_check",
    f"WITH {O.bars_cte()}, {O.silver_ctes('bars', LATEST)}\n"
    "SELECT symbol, _file_date, TTL_TRD_QNTY, avg_vol_180d, IS_3X_SURGE FROM surges "
    "WHERE _file_date = (SELECT MAX(week_end_date) FROM week_volume)",
)
def q_volume_surge_check(spark, sf):
    return silver.volume_surge_check(X.bars(spark, sf), LATEST)


@register(
    "volume_surge_check_as_of",
    f"WITH {O.bars_cte()}, {O.silver_ctes('bars', SIGNAL_AS_OF)}\n"
    "SELECT symbol, _file_date, TTL_TRD_QNTY, avg_vol_180d, IS_3X_SURGE FROM surges "
    "WHERE _file_date = (SELECT MAX(week_end_date) FROM week_volume)",
)
def q_volume_surge_check_as_of(spark, sf):
    return silver.volume_surge_check(X.bars(spark, sf), SIGNAL_AS_OF)


@register(
    "price_breakout_check",
    f"WITH {O.bars_cte()}, {O.silver_ctes('bars', LATEST)}\n"
    "SELECT symbol, _file_date, close_price, prev_180d_friday_high, \"50w_Moving_avg\", IS_BREAKOUT "
    "FROM breakouts WHERE _file_date = (SELECT MAX(_file_date) FROM week_close)",
)
def q_price_breakout_check(spark, sf):
    return silver.price_breakout_check(X.bars(spark, sf), LATEST)


@register(
    "moving_average_50w",
    f"WITH {O.bars_cte()}, {O.silver_ctes('bars', LATEST)}\n"
    "SELECT symbol, _file_date, close_price, \"50w_Moving_avg\" FROM breakouts",
)
def q_moving_average_50w(spark, sf):
    return silver.moving_average_50w(X.bars(spark, sf), LATEST)


@register(
    "delivery_weekly_check",
    f"WITH {O.bars_cte()}\n"
    "SELECT symbol, CAST(date_trunc('week', _file_date) AS DATE) AS week_start,\n"
    "       (SUM(DELIV_QTY) * 100.0 / NULLIF(SUM(TTL_TRD_QNTY), 0)) AS weekly_deliv_per\n"
    "FROM bars GROUP BY 1, 2 HAVING weekly_deliv_per > 50.0",
)
def q_delivery_weekly_check(spark, sf):
    return silver.delivery_weekly_check(X.bars(spark, sf))


# ------------------------------------------------------------------- gold
@register("weekly_signals", O.as_of_signals_sql(O.bars_cte(), SIGNAL_AS_OF))
def q_weekly_signals(spark, sf):
    b = X.bars(spark, sf)
    surge, breakout = silver.volume_surge_check(b, SIGNAL_AS_OF), silver.price_breakout_check(b, SIGNAL_AS_OF)
    return gold.weekly_signals(surge, breakout, SIGNAL_AS_OF)


@register("weekly_signal_history", O.history_sql(O.bars_cte(), LATEST))
def q_weekly_signal_history(spark, sf):
    return gold.weekly_signal_history(X.bars(spark, sf), LATEST)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signal history at factor 2 (factor 3 has no signal at sf0.001)."""
    return gold.weekly_signal_history(X.bars(spark, sf_dir), LATEST, factor=2)


# -------------------------------------------------------- bronze (X2 raw files)
_NO_LOAD_TIME = [c for c in bhavcopy.BRONZE_COLUMNS if c != "_loaded_at"]


@register("parse_bhavcopy", f"WITH {O.x2_ctes()}\nSELECT {O.PARSED_COLUMNS} FROM x2f")
def q_parse_bhavcopy(spark, sf):
    return bhavcopy.parse_bhavcopy(X.raw_files(spark, sf)).select(*_NO_LOAD_TIME)


@register(
    "stock_filter",
    f"WITH {O.x2_ctes()}\n"
    f"SELECT x2_symbol AS SYMBOL, x2_series AS SERIES, _source_file, _file_date FROM x2f WHERE {O.KEEP}",
)
def q_stock_filter(spark, sf):
    parsed = bhavcopy.parse_bhavcopy(X.raw_files(spark, sf))
    return bhavcopy.stock_filter(parsed).select("SYMBOL", "SERIES", "_source_file", "_file_date")


@register("clean_bars", f"WITH {O.x2_ctes()}\n{O.X2_BARS}")
def q_clean_bars(spark, sf):
    return silver.clean_bars(bhavcopy.bronze_rows(X.raw_files(spark, sf)))


@register(
    "ingest_counts",
    f"WITH {O.x2_ctes()}\n"
    "SELECT _source_file, COUNT(*) AS rows_read,\n"
    f"       COUNT(CASE WHEN {O.KEEP} THEN 1 END) AS rows_kept\n"
    "FROM x2f GROUP BY _source_file",
)
def q_ingest_counts(spark, sf):
    return bhavcopy.ingest_counts(bhavcopy.parse_bhavcopy(X.raw_files(spark, sf)))


# Latest market week end with a factor-3 signal on stock-filtered X2 bars at
# sf0.01; weeks after it are cut by the run-date filter, so the whole landing
# directory can be read.
PIPELINE_AS_OF = "2000-01-02"
_LANDING: dict[str, str] = {}


def _landing_dir(spark: SparkSession, sf: str) -> str:
    """X2 raw files written once per process as a landing directory."""
    key = f"{spark.sparkContext.applicationId}:{sf}"
    if key not in _LANDING:
        d = scratch_dir(spark, "landing")
        landing.write_landing(X.raw_files(spark, sf), d)
        _LANDING[key] = d
    return _LANDING[key]


def _processed_before(raw: DataFrame) -> DataFrame:
    """Raw files a previous run already handled: those dated before its day."""
    return raw.filter(file_date_from_name("filename") < F.lit(O.PREVIOUS_RUN).cast("date"))


@register(
    "pending_files",
    f"WITH {O.x2_ctes()}, done AS (SELECT DISTINCT _source_file FROM x2f WHERE {O.DONE_BEFORE} AND {O.KEEP})\n"
    "SELECT filename, content FROM x2raw WHERE filename NOT IN (SELECT _source_file FROM done)",
)
def q_pending_files(spark, sf):
    raw = X.raw_files(spark, sf)
    return landing.pending_files(raw, bhavcopy.bronze_rows(_processed_before(raw)))


@register(
    "land_files",
    f"WITH {O.x2_ctes()}\n"
    "SELECT filename, content FROM x2raw\n"
    "WHERE CAST(strptime(regexp_extract(filename, '([0-9]{8})', 1), '%d%m%Y') AS DATE) >= DATE '"
    + O.PREVIOUS_RUN
    + "'",
)
def q_land_files(spark, sf):
    existing = _processed_before(X.raw_files(spark, sf))
    return landing.land_files(spark, _landing_dir(spark, sf), existing).select("filename", "content")


# ------------------------------------------------------------- serving views
def _history_view(spark, sf):
    return serve.signal_history_view(gold.weekly_signal_history(X.bars(spark, sf), LATEST))


@register("signal_history_view", O.view_with(O.bars_cte(), LATEST) + "\nSELECT * FROM v")
def q_signal_history_view(spark, sf):
    return _history_view(spark, sf)


def _page(spark, sf, month, page):
    index = serve.PageIndex.build(_history_view(spark, sf), scratch_dir(spark, "page-index"))
    return index.page(month, page)


@register("signals_page", O.page_sql(O.bars_cte(), LATEST, page=2))
def q_signals_page(spark, sf):
    return _page(spark, sf, "all", 2)


# At factor 1 a month has several pages at sf0.01.
PAGED_MONTH = "06-1998"


@register("signals_page_of_month", O.page_sql(O.bars_cte(), LATEST, page=2, month=PAGED_MONTH, factor=1))
def q_signals_page_of_month(spark, sf):
    history = gold.weekly_signal_history(X.bars(spark, sf), LATEST, factor=1)
    index = serve.PageIndex.build(serve.signal_history_view(history), scratch_dir(spark, "page-index"))
    return index.page(PAGED_MONTH, 2)


@register("signal_month_counts", O.month_counts_sql(O.bars_cte(), LATEST))
def q_signal_month_counts(spark, sf):
    return serve.signal_month_counts(_history_view(spark, sf))


@register("signals_json", O.json_sql(O.bars_cte(), LATEST))
def q_signals_json(spark, sf):
    return serve.signals_json(_history_view(spark, sf))


# ------------------------------------------------------------ expected files
FILES_AS_OF = "2001-08-01"


@register("previous_business_day", O.PREVIOUS_BUSINESS_DAY)
def q_previous_business_day(spark, sf):
    d = X.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return d.select("d", previous_business_day("d").alias("previous_business_day"))


@register("missing_files", O.missing_files_sql(FILES_AS_OF))
def q_missing_files(spark, sf):
    strikes = X.strike_table(files.expected_calendar(spark, FILES_AS_OF))
    return files.missing_files(X.landed_files(spark, sf), strikes, FILES_AS_OF)


@register("strike_counts", O.STRIKE_COUNTS)
def q_strike_counts(spark, sf):
    return files.strike_counts(X.fetch_attempts(spark, sf))


@register("strike_counts_carried", O.STRIKE_COUNTS_CARRIED)
def q_strike_counts_carried(spark, sf):
    return files.strike_counts(X.fetch_attempts(spark, sf), X.carried_strikes(spark, sf))


@register("fetch_window", O.fetch_window_sql())
def q_fetch_window(spark, sf):
    return files.fetch_window(X.fetch_attempts(spark, sf))


# ----------------------------------------------------------------- watchlist
VIEW_NOW = "2024-01-15 00:00:00"


def _watchlist(spark, sf):
    return watchlist.watchlist_apply(X.stored_watchlist(spark, sf), X.watchlist_changes(spark, sf))


@register("watchlist_apply", O.WATCHLIST_APPLY)
def q_watchlist_apply(spark, sf):
    return _watchlist(spark, sf)


@register("watchlist_view", O.watchlist_view_sql(VIEW_NOW))
def q_watchlist_view(spark, sf):
    return watchlist.watchlist_view(_watchlist(spark, sf), now=datetime.datetime.fromisoformat(VIEW_NOW))


# ------------------------------------------------------------------- widgets
@register("widget_rows", O.WIDGET_ROWS)
def q_widget_rows(spark, sf):
    return widgets.widget_rows(X.widget_payloads(spark, sf))


_RECORD = "event_id double, user_id double, value double"


@register("widget_export", O.WIDGET_EXPORT)
def q_widget_export(spark, sf):
    """Exports of all days, written in one job and read back."""
    out = scratch_dir(spark, "exports")
    widgets.write_widget_csv(widgets.widget_rows(X.widget_payloads(spark, sf), record_schema=_RECORD, keep=["day"]), out, "day")
    return widgets.read_widget_csv(spark, out, _RECORD)


@register("fetch_state", O.fetch_state_sql())
def q_fetch_state(spark, sf):
    """The attempts come in two batches; the state of the first meets the second."""
    log, out, checkpoint = (scratch_dir(spark, n) for n in ("attempts", "fetch-state", "fetch-ckpt"))
    attempts, middle = X.fetch_attempts(spark, sf), F.lit(ATTEMPTS_UNTIL).cast("timestamp")
    for batch in (attempts.filter(F.col("ts") < middle), attempts.filter(F.col("ts") >= middle)):
        batch.write.mode("append").parquet(log)
        fetch_state.run_fetch_state(spark, log, attempts.schema, out, checkpoint)
    state = fetch_state.latest_state(spark, out)
    strikes = F.coalesce(F.try_element_at("strikes", F.col("feed")), F.lit(0))
    return state.withColumn("strikes", strikes).withColumn("stop_ts", F.col("stop_ts").cast(attempts.schema["ts"].dataType))


@register("catalog_signal_history", O.history_sql(O.bars_cte(), LATEST))
def q_catalog_signal_history(spark, sf):
    """The history from bars stored as a bucketed catalog table."""
    where = scratch_dir(spark, "warehouse")
    name = pipeline.save_table(X.bars(spark, sf), "bars", location=where, prefix=f"t{where.rsplit('-', 1)[1]}_")
    return gold.weekly_signal_history(spark.table(name), LATEST)


# ---------------------------------------------------- end-to-end and streaming
@register(
    "run_pipeline",
    O.as_of_signals_sql(f"x1 AS ({O.X1}), x2 AS ({O.X2}), bars AS ({O.X2_BARS})", PIPELINE_AS_OF),
)
def q_run_pipeline(spark, sf):
    result = pipeline.run_pipeline(spark, _landing_dir(spark, sf), scratch_dir(spark, "lake"), PIPELINE_AS_OF)
    return pipeline.signals_table(spark, result)


def _closes_sql() -> str:
    return (
        f"WITH {O.bars_cte()}, {O.silver_ctes('bars', LATEST)}\n"
        'SELECT symbol, b._file_date, close_price, prev_180d_friday_high, "50w_Moving_avg", week_sum, mean_before, delivered FROM breakouts b\n'
        "JOIN (SELECT symbol, _file_date, TTL_TRD_QNTY AS week_sum, mean_before FROM volume_means) USING (symbol, _file_date)\n"
        "JOIN (SELECT symbol, MAX(_file_date) AS _file_date, CAST(SUM(DELIV_QTY) AS BIGINT) AS delivered FROM dated GROUP BY symbol, monday) USING (symbol, _file_date)"
    )


@register("weekly_state_two_runs", _closes_sql())
def q_weekly_state_two_runs(spark, sf):
    """The stored weeks and closes after two runs, the second of which brings bars of
    all weeks, late ones included."""
    change = Lake(spark, scratch_dir(spark, "state")).change()
    bars, odd = X.bars(spark, sf), F.dayofmonth("_file_date") % 2 == 1
    weekly = closes = None
    for run in (bars.filter(odd), bars.filter(~odd)):
        new = weekly_state.update(run, weekly, closes)
        weekly = change.refresh_years("weekly", new.weekly, "year", new.years)
        closes = change.refresh_years("closes", new.closes, "year", new.years)
    change.commit()
    weeks = weekly.select("symbol", "week_start", F.col("weekly_sum").alias("week_sum"), "mean_before", "delivered")
    return closes.join(weeks, ["symbol", "week_start"]).drop("week_start")


@register("file_errors", O.file_errors_sql())
def q_file_errors(spark, sf):
    """What became of each raw file, broken ones included."""
    raw = X.raw_files_some_broken(spark, sf)
    return pipeline.file_status(raw, bhavcopy.bronze_rows(raw))


@register(
    "stream_ingest",
    f"WITH {O.x2_ctes()}\n"
    f"SELECT x2_symbol AS SYMBOL, x2_series AS SERIES, {O.PARSED_COLUMNS.split(', ', 2)[2]} FROM x2f WHERE {O.KEEP}",
)
def q_stream_ingest(spark, sf):
    bronze = scratch_dir(spark, "bronze")
    ingest.stream_ingest(spark, _landing_dir(spark, sf), bronze, scratch_dir(spark, "stream-ckpt"))
    return ingest.read_bronze(spark, bronze).select(*_NO_LOAD_TIME)
