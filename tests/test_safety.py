"""Rows and files that must not be lost, changed or counted twice."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import files, gold, serve, silver
from tidemark.plans.pipeline import run_pipeline
from tidemark.sources.bhavcopy import BHAVCOPY_COLUMNS
from tidemark.streaming.ingest import read_bronze, stream_ingest

BAR = "symbol string, _file_date date, open_price decimal(12,2), high_price decimal(12,2), low_price decimal(12,2), close_price decimal(12,2), TTL_TRD_QNTY bigint, DELIV_QTY bigint"


def _csv(rows):
    line = lambda s, q: f"{s},EQ,01-Jan-2024,1,1,1,1,1,1,1,{q},1,1,{q},1"
    return "\n".join([",".join(BHAVCOPY_COLUMNS), *(line(s, q) for s, q in rows)]) + "\n"


def _bars(spark, symbols, weeks=30):
    start = dt.date(2024, 1, 5)
    rows = []
    for w in range(weeks):
        d = start + dt.timedelta(days=7 * w)
        high = 1000 if w == weeks - 1 else 10
        rows += [(s, d, *[high + w] * 4, high * 10, 1) for s in symbols]
    return spark.createDataFrame([(r[0], r[1], *map(float, r[2:6]), *r[6:]) for r in rows], BAR.replace("decimal(12,2)", "double")).select(
        *[F.col(c).cast("decimal(12,2)").alias(c) if c.endswith("price") else F.col(c) for c in ("symbol", "_file_date", "open_price", "high_price", "low_price", "close_price", "TTL_TRD_QNTY", "DELIV_QTY")]
    ), start + dt.timedelta(days=7 * (weeks - 1))


def test_bars_without_symbol_have_volume_but_no_close(spark):
    bars, last = _bars(spark, ["A", None])
    day = last.isoformat()
    assert {r.symbol for r in silver.weekly_volume(bars, day).collect()} == {"A", None}
    assert {r.symbol for r in silver.weekly_close(bars, day).collect()} == {"A"}
    assert {r.symbol for r in silver.price_breakout_check(bars, day).collect()} == {"A"}
    assert {r.symbol for r in gold.weekly_signal_history(bars, day).collect()} == {"A"}
    assert {r.symbol for r in gold.signals_as_of(bars, day).collect()} == {"A"}


def test_strict_run_that_fails_keeps_the_stored_tables(spark, tmp_path):
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    (landing / "sec_bhavdata_full_05012024.csv").write_text(_csv([("A", 5), ("B", 6)]))
    first = run_pipeline(spark, str(landing), lake, as_of="2024-01-05")
    before = sorted(map(tuple, first.table(spark, "bars").collect()))
    assert len(before) == 2
    (landing / "sec_bhavdata_full_08012024.csv").write_text(_csv([("A", "-")]))
    with pytest.raises(Exception, match=r"(?i)cast|number"):
        run_pipeline(spark, str(landing), lake, as_of="2024-01-08")
    spark.catalog.clearCache()
    assert sorted(map(tuple, first.table(spark, "bars").collect())) == before
    assert first.table(spark, "signal_history").count() == 0


def test_json_records_keep_nulls(spark):
    view = spark.createDataFrame([("A", None)], "symbol string, multiple double")
    assert json.loads(serve.signals_json(view).first()[0]) == {"multiple": None, "symbol": "A"}


def test_stream_takes_nested_files_and_each_name_once(spark, tmp_path):
    name = "sec_bhavdata_full_05012024.csv"
    for folder in ("one", "two/deep"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / name).write_text(_csv([("A", 5)]))
    (tmp_path / "in" / "three").mkdir()
    (tmp_path / "in" / "three" / "sec_bhavdata_full_08012024.csv").write_text(_csv([("B", 5)]))
    bronze = str(tmp_path / "bronze")
    stream_ingest(spark, str(tmp_path / "in"), bronze, str(tmp_path / "ckpt"))
    assert sorted(r.SYMBOL for r in read_bronze(spark, bronze).collect()) == ["A", "B"]


def test_fetch_window_keeps_rows_without_feed(spark):
    rows = [(f, dt.datetime(2024, 1, 1, h), h, 404 if h < 6 else 200) for f in ("x", None) for h in range(8)]
    df = spark.createDataFrame(rows, "feed string, ts timestamp, seq long, status int").withColumn("filename", F.lit("f"))
    got = {r.feed: (r.rows_made, r.reached_limit) for r in files.fetch_window(df).collect()}
    assert got[None] == got["x"]
