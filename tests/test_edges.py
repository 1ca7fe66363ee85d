"""Hand-made edge rows (FIXTURES.md §3) for each operator."""

import datetime as dt
import io
import json
import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions.scalars import NO, YES, previous_business_day, round_half_away, round_half_even
from tidemark.operators import files, gold, serve, silver, watchlist
from tidemark.sources import bhavcopy, landing, widgets

D = dt.date
HEADER = " SYMBOL , SERIES, DATE1, PREV_CLOSE, OPEN_PRICE, HIGH_PRICE, LOW_PRICE, LAST_PRICE, CLOSE_PRICE, AVG_PRICE, TTL_TRD_QNTY, TURNOVER_LACS, NO_OF_TRADES, DELIV_QTY, DELIV_PER"


def line(sym, series="EQ", qty="10", deliv="5", last="NA"):
    return f"{sym},{series},01-Jan-2024,1,1,1,1,1,1,1,{qty},-,1,{deliv},{last}"


def raw_df(spark, files_):
    return spark.createDataFrame(list(files_.items()), "filename string, content string")


def bars_df(spark, data):
    """data: (symbol, date, close, qty[, deliv])"""
    out = []
    for r in data:
        sym, d, close, qty = r[:4]
        deliv = r[4] if len(r) > 4 else 0
        c = Decimal(str(close)).quantize(Decimal("0.01"))
        out.append((sym, c, c, c, c, qty, deliv, d))
    return spark.createDataFrame(
        out,
        "symbol string, open_price decimal(12,2), high_price decimal(12,2), low_price decimal(12,2), "
        "close_price decimal(12,2), TTL_TRD_QNTY bigint, DELIV_QTY bigint, _file_date date",
    )


# ------------------------------------------------------------------ bronze
def test_stock_filter_patterns(spark):
    df = spark.createDataFrame(
        [(" niftybees ", "EQ"), ("ABCSDLX", "EQ"), ("HEALTHY", "EQ"), ("HEALTHYCO", "EQ"), ("INFY\t", " eq "),
         (None, "EQ"), ("TCS", None), ("XBEESX", "EQ"), ("GOLDBEES", "BE")],
        "SYMBOL string, SERIES string",
    )
    got = rows(bhavcopy.stock_filter(df))
    assert got == sorted([("HEALTHYCO", "EQ"), ("INFY", "EQ"), (None, "EQ"), ("XBEESX", "EQ")], key=str)


def test_parse_na_padding_crlf_and_blank_lines(spark):
    content = HEADER + "\r\n" + line(" abc ", last="NA") + "\r\n\r\n" + line("XYZ", last=" NA") + "\n"
    out = bhavcopy.parse_bhavcopy(raw_df(spark, {"sec_bhavdata_full_05012024.csv": content}))
    got = {r["SYMBOL"]: r for r in out.collect()}
    assert set(got) == {" abc ", "XYZ"}
    assert got[" abc "]["DELIV_PER"] is None  # exact 'NA' -> NULL
    assert got["XYZ"]["DELIV_PER"] == " NA"  # padded stays text
    assert got["XYZ"]["_file_date"] == D(2024, 1, 5)
    assert got["XYZ"]["_source_file"] == "sec_bhavdata_full_05012024.csv"


def test_blank_lines_and_quoted_commas(spark):
    content = "\n \t\n" + HEADER + "\n\t\n" + line('"A,B"') + "\n  \n,\n" + line('"Q""T"') + "\n"
    out = bhavcopy.parse_bhavcopy(raw_df(spark, {"sec_bhavdata_full_05012024.csv": content}))
    assert bhavcopy.file_errors(raw_df(spark, {"sec_bhavdata_full_05012024.csv": content})).count() == 0
    got = rows(out, "SYMBOL", "SERIES")
    assert got == sorted([("A,B", "EQ"), (None, None), ('Q"T', "EQ")], key=repr)


def test_line_ends_quoted_newlines_and_byte_order_mark_as_pandas(spark):
    cases = {
        "sec_bhavdata_full_01012024.csv": HEADER + "\r" + line("A") + "\r" + line("B"),
        "sec_bhavdata_full_02012024.csv": "\ufeff" + HEADER + "\n" + line("A") + "\n",
        "sec_bhavdata_full_03012024.csv": HEADER + "\n" + line('"A\nB"') + "\n" + line("C") + "\n",
        "sec_bhavdata_full_04012024.csv": HEADER + "\r\n" + line('"A\r\nB, ""x"""') + "\r\n\r\n" + line("C") + "\r\n",
        "sec_bhavdata_full_05012024.csv": HEADER + "\n" + line("A") + "\r" + line("B") + "\n",
    }
    raw = raw_df(spark, cases)
    assert bhavcopy.file_errors(raw).count() == 0
    got = rows(bhavcopy.parse_bhavcopy(raw), "_source_file", *bhavcopy.BHAVCOPY_COLUMNS)
    want = []
    for name, content in cases.items():
        for r in pd.read_csv(io.BytesIO(content.encode()), dtype=str).itertuples(index=False):
            want.append((name, *(None if pd.isna(x) else x for x in r)))
    assert got == sorted(want, key=repr)


def test_bad_files_are_reported_and_yield_no_rows(spark):
    raw = raw_df(
        spark,
        {
            "sec_bhavdata_full_05012024.csv": HEADER + "\n" + line("A") + ",extra\n",
            "no_date_here.csv": HEADER + "\n" + line("B") + "\n",
            "sec_bhavdata_full_08012024.csv": "A,B,C\n1,2,3\n",
            "sec_bhavdata_full_09012024.csv": HEADER + "\n",
            "sec_bhavdata_full_10012024.csv": HEADER + "\n" + line("GOOD") + "\n",
        },
    )
    errs = dict(rows(bhavcopy.file_errors(raw)))
    assert set(errs) == {"sec_bhavdata_full_05012024.csv", "no_date_here.csv", "sec_bhavdata_full_08012024.csv"}
    assert rows(bhavcopy.parse_bhavcopy(raw), "SYMBOL") == [("GOOD",)]


def test_files_without_stock_rows_stay_pending(spark):
    raw = raw_df(
        spark,
        {
            "sec_bhavdata_full_05012024.csv": HEADER + "\n" + line("NIFTYBEES") + "\n",
            "sec_bhavdata_full_08012024.csv": HEADER + "\n" + line("INFY") + "\n",
        },
    )
    bronze = bhavcopy.bronze_rows(raw)
    assert rows(landing.pending_files(raw, bronze), "filename") == [("sec_bhavdata_full_05012024.csv",)]
    counts = {r[0]: (r[1], r[2]) for r in bhavcopy.ingest_counts(bhavcopy.parse_bhavcopy(raw)).collect()}
    assert counts == {"sec_bhavdata_full_05012024.csv": (1, 0), "sec_bhavdata_full_08012024.csv": (1, 1)}


def test_clean_bars_casts(spark):
    raw = raw_df(
        spark,
        {"sec_bhavdata_full_05012024.csv": HEADER + "\n" + line("A", qty=" ", deliv="12.5") + "\n" + line("B", qty="1e3", deliv="13.5") + "\n"},
    )
    got = {r["symbol"]: r for r in silver.clean_bars(bhavcopy.bronze_rows(raw)).collect()}
    assert got["A"]["TTL_TRD_QNTY"] is None and got["A"]["DELIV_QTY"] == 13
    assert got["B"]["TTL_TRD_QNTY"] == 1000 and got["B"]["DELIV_QTY"] == 14
    assert got["A"]["close_price"] == Decimal("1.00")


def test_clean_bars_strict_and_lenient(spark):
    raw = raw_df(spark, {"sec_bhavdata_full_05012024.csv": HEADER + "\n" + line("A", qty="-") + "\n"})
    bronze = bhavcopy.bronze_rows(raw)
    with pytest.raises(PySparkException):
        silver.clean_bars(bronze).collect()
    assert silver.clean_bars(bronze, lenient=True).collect()[0]["TTL_TRD_QNTY"] is None
    losses = silver.clean_bars_losses(bronze).collect()[0].asDict()
    assert losses["TTL_TRD_QNTY"] == 1 and losses["DELIV_QTY"] == 0 and losses["close_price"] == 0


def test_landing_flat_and_folder_layout(spark, tmp_path):
    flat = tmp_path / "flat"
    flat.mkdir()
    (flat / "sec_bhavdata_full_05012024.csv").write_text("x\ny\n")
    got = rows(landing.read_landing(spark, str(flat)))
    assert got == [("sec_bhavdata_full_05012024.csv", "x\ny\n")]
    folders = str(tmp_path / "folders")
    landing.write_landing(raw_df(spark, {"sec_bhavdata_full_06012024.csv": "a\nb\n"}), folders)
    assert rows(landing.read_landing(spark, folders)) == [("sec_bhavdata_full_06012024.csv", "a\nb\n")]
    existing = raw_df(spark, {"sec_bhavdata_full_05012024.csv": "old"})
    new = landing.land_files(spark, str(flat), existing)
    assert new.count() == 0
    assert landing.read_landing(spark, str(flat), modified_after="2999-01-01T00:00:00").count() == 0
    assert landing.read_landing(spark, str(flat), modified_after="2000-01-01T00:00:00").count() == 1


# ------------------------------------------------------------------ silver
def test_first_week_flags_no_and_missing_weeks_reach_back(spark):
    # Fridays with a gap of many weeks: the frame counts rows, not time.
    data = [("A", D(2024, 1, 5), 10, 100), ("A", D(2024, 6, 7), 11, 100), ("A", D(2024, 6, 14), 12, 1000)]
    b = bars_df(spark, data)
    s = {r["_file_date"]: r for r in silver.surge_stats(b, "2024-06-14").collect()}
    assert s[D(2024, 1, 5)]["IS_3X_SURGE"] == NO and s[D(2024, 1, 5)]["avg_vol_180d"] is None
    assert s[D(2024, 6, 14)]["avg_vol_180d"] == 100.0 and s[D(2024, 6, 14)]["IS_3X_SURGE"] == YES
    p = {r["_file_date"]: r for r in silver.breakout_stats(b, "2024-06-14").collect()}
    assert p[D(2024, 1, 5)]["IS_BREAKOUT"] == NO and p[D(2024, 1, 5)]["prev_180d_friday_high"] is None
    assert p[D(2024, 6, 14)]["prev_180d_friday_high"] == Decimal("11.00")
    assert p[D(2024, 6, 14)]["50w_Moving_avg"] == 11.0


def test_symbol_absent_on_anchor_is_absent(spark):
    b = bars_df(spark, [("A", D(2024, 6, 13), 10, 1), ("B", D(2024, 6, 14), 10, 1)])
    assert rows(silver.volume_surge_check(b, "2024-06-14"), "symbol") == [("B",)]
    assert rows(silver.price_breakout_check(b, "2024-06-14"), "symbol") == [("B",)]


def test_duplicate_bar_gives_two_weekly_close_rows(spark):
    b = bars_df(spark, [("A", D(2024, 6, 14), 10, 1), ("A", D(2024, 6, 14), 11, 1), ("A", D(2024, 6, 13), 9, 1)])
    assert len(silver.weekly_close(b, "2024-06-14").collect()) == 2


@pytest.mark.parametrize("as_of", ["2024-06-14", "2024-06-16", "2024-06-10"])
def test_current_week_included(spark, as_of):
    # Friday, Sunday and Monday of the same ISO week all keep that week.
    b = bars_df(spark, [("A", D(2024, 6, 14), 10, 1), ("A", D(2024, 6, 17), 10, 1)])
    got = rows(silver.weekly_volume(b, as_of), "week_start")
    assert got == [(D(2024, 6, 10),)]


def test_complete_weeks_only(spark):
    from tidemark.functions.scalars import last_complete_week_end

    assert last_complete_week_end("2024-06-14") == D(2024, 6, 9)
    assert last_complete_week_end("2024-06-16") == D(2024, 6, 9)
    assert last_complete_week_end("2024-06-17") == D(2024, 6, 16)
    b = bars_df(spark, [("A", D(2024, 6, 7), 10, 1), ("A", D(2024, 6, 14), 10, 1)])
    got = rows(silver.weekly_volume(b, last_complete_week_end("2024-06-14")), "week_start")
    assert got == [(D(2024, 6, 3),)]


def test_zero_mean_volume_gives_null_multiple(spark):
    b = bars_df(spark, [("A", D(2024, 6, 7), 10, 0), ("A", D(2024, 6, 14), 20, 5)])
    surge = silver.volume_surge_check(b, "2024-06-14")
    breakout = silver.price_breakout_check(b, "2024-06-14")
    got = gold.weekly_signals(surge, breakout, "2024-06-14").collect()
    assert len(got) == 1 and got[0]["3X_180dvol_MULTIPLE"] is None


def test_delivery_share(spark):
    b = bars_df(spark, [("A", D(2024, 6, 13), 10, 10, 6), ("A", D(2024, 6, 14), 10, 10, 0), ("B", D(2024, 6, 14), 1, 0, 0)])
    assert rows(silver.delivery_weekly_check(b)) == []  # 30% is not above 50%
    assert rows(silver.delivery_weekly_check(b, min_pct=25.0)) == [("A", D(2024, 6, 10), 30.0)]


def test_rounding_rules(spark):
    vals = [1.005, 2.675, 0.125, -1.005, 12.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    # scale, round half away from zero on the scaled double, unscale
    assert got == [math.copysign(math.floor(abs(v * 100) + 0.5), v) / 100 for v in vals]
    assert got[0] == 1.0  # 1.005 * 100 is 100.49999999999999
    assert [r[0] for r in df.select(round_half_away("x", 0)).collect()] == [1.0, 3.0, 0.0, -1.0, 13.0]
    vals = [0.25, 0.35, 0.45, 1.05, 2.5, -0.25, 12.345]
    e = spark.createDataFrame([(v,) for v in vals], "x double")
    assert [r[0] for r in e.select(round_half_even("x", 1)).collect()] == list(np.round(np.array(vals), 1))


# ------------------------------------------------------------ expected files
def test_previous_business_day(spark):
    df = spark.createDataFrame([(D(2024, 6, 15),), (D(2024, 6, 16),), (D(2024, 6, 17),), (D(2024, 6, 19),)], "d date")
    got = [r[0] for r in df.select(previous_business_day("d")).collect()]
    assert got == [D(2024, 6, 14), D(2024, 6, 14), D(2024, 6, 14), D(2024, 6, 18)]


def test_missing_files_weekdays_strikes_landed(spark):
    landed = spark.createDataFrame([("sec_bhavdata_full_14062024.csv",)], "filename string")
    strikes = spark.createDataFrame([("sec_bhavdata_full_13062024.csv", 2), ("sec_bhavdata_full_12062024.csv", 1)], "filename string, strikes int")
    got = rows(files.missing_files(landed, strikes, "2024-06-16", days_back=7), "filename", "strikes")
    assert got == [
        ("sec_bhavdata_full_10062024.csv", 0),
        ("sec_bhavdata_full_11062024.csv", 0),
        ("sec_bhavdata_full_12062024.csv", 1),
    ]


def attempts(spark, statuses, feed="f", filenames=None):
    t0 = dt.datetime(2024, 1, 1)
    data = [
        (feed, (filenames or [f"file{i}" for i in range(len(statuses))])[i], t0 + dt.timedelta(minutes=i), i, s)
        for i, s in enumerate(statuses)
    ]
    return spark.createDataFrame(data, "feed string, filename string, ts timestamp_ntz, seq bigint, status int")


def test_fetch_window_stops_after_five_empty(spark):
    a = attempts(spark, [404, 500, 500, -1, 404, 404])
    made = [r["made"] for r in files.fetch_window_rows(a).orderBy("seq").collect()]
    assert made == [True] * 5 + [False]
    w = files.fetch_window(a).collect()[0]
    assert w["rows_made"] == 5 and w["reached_limit"] and w["stop_seq"] == 5
    made_rows = files.fetch_window_rows(a).filter("made")
    assert sum(r["strikes"] for r in files.strike_counts(made_rows).collect()) == 2


def test_landed_resets_run_and_strikes_are_per_file(spark):
    a = attempts(spark, [404, 0, 404], filenames=["x", "y", "x"])
    r = files.fetch_window_rows(a).orderBy("seq").collect()
    assert [x["run_before"] for x in r] == [0, 1, 0]
    assert rows(files.strike_counts(a)) == [("x", 2)]
    b = attempts(spark, [404, 200, 404, None], filenames=["x", "x", "x", "x"])
    assert rows(files.strike_counts(b)) == [("x", 1)]


def test_strikes_follow_the_log_on_top_of_carried_ones(spark, tmp_path):
    rng = np.random.default_rng(5)
    start = dt.datetime(2024, 1, 1)
    log = [
        ("f", f"f{rng.integers(6)}", start + dt.timedelta(hours=int(rng.integers(96))), seq, [200, 404, 404, 500, None][rng.integers(5)])
        for seq in range(60)
    ]
    carried = {"f0": 2, "f1": 1, "old": 1}
    want = dict(carried)
    for _, name, _, _, status in sorted(log, key=lambda r: (r[2], r[3])):
        if status == 200:
            want.pop(name, None)
        elif status == 404:
            want[name] = want.get(name, 0) + 1
    attempts = spark.createDataFrame(log, "feed string, filename string, ts timestamp, seq long, status int")
    previous = spark.createDataFrame(list(carried.items()), "filename string, strikes int")
    assert rows(files.strike_counts(attempts, previous)) == sorted(want.items(), key=repr)
    none = files.read_strike_tracker(spark, str(tmp_path / "absent.json"))
    assert rows(files.strike_counts(attempts, none)) == rows(files.strike_counts(attempts))


def test_strike_tracker_round_trip(spark, tmp_path):
    p = tmp_path / "strikes.json"
    p.write_text('{"sec_bhavdata_full_02102025.csv": 3, "sec_bhavdata_full_24042026.csv": 1}')
    got = rows(files.read_strike_tracker(spark, str(p)))
    assert got == [("sec_bhavdata_full_02102025.csv", 3), ("sec_bhavdata_full_24042026.csv", 1)]
    bad = tmp_path / "bad.json"
    bad.write_text("not json")
    assert files.read_strike_tracker(spark, str(bad)).count() == 0
    out = str(tmp_path / "out")
    files.write_strike_tracker(files.read_strike_tracker(spark, str(p)), out)
    assert rows(files.read_strike_tracker(spark, out)) == got


# ------------------------------------------------------------------ serving
def view_df(spark, data):
    df = spark.createDataFrame(
        [(s, d, Decimal(c), ma, m) for s, d, c, ma, m in data],
        "symbol string, _file_date date, close_price decimal(12,2), `50w_Moving_avg` double, `3X_180dvol_MULTIPLE` double",
    )
    df = df.select(
        "*",
        F.lit(1).cast("bigint").alias("TTL_TRD_QNTY"),
        F.lit(1.0).alias("avg_vol_180d"),
        F.lit(YES).alias("IS_3X_SURGE"),
        F.lit(Decimal("1.00")).cast("decimal(12,2)").alias("prev_180d_friday_high"),
        F.lit(YES).alias("IS_BREAKOUT"),
    )
    return serve.signal_history_view(df)


def test_month_order_and_counts(spark):
    v = view_df(spark, [("A", D(2025, 12, 5), "10", 5.0, 1.2), ("A", D(2026, 1, 9), "10", None, 1.5), ("B", D(2026, 1, 9), "1", 5.0, None)])
    got = [tuple(r) for r in serve.signal_month_counts(v).collect()]
    assert got == [("all", 2, 3), ("12-2025", 1, 1), ("01-2026", 2, 2)]
    assert [tuple(r) for r in serve.signal_month_counts(v.filter("false")).collect()] == [("all", 0, 0)]
    chrono = [r[0] for r in serve.signal_month_counts(v, chronological=True).collect()]
    assert chrono == ["all", "01-2026", "12-2025"]
    colors = {(r["symbol"], r["month_year"]): r["price_color"] for r in v.collect()}
    assert colors == {("A", "12-2025"): "green", ("A", "01-2026"): "red", ("B", "01-2026"): "red"}


def test_pages_by_position(spark, tmp_path):
    days = [D(2026, 1, 9)] * 12 + [D(2026, 2, 6)] * 25
    v = view_df(spark, [(f"S{i:02d}", d, "1", 1.0, float(i) if i % 7 else None) for i, d in enumerate(days)])
    index = serve.PageIndex.build(v, str(tmp_path / "index"))
    order = [r.symbol for r in v.collect()]
    p0 = index.page(page=0).collect()
    assert [r.symbol for r in p0] == order[:10] and p0[0]["page"] == 1 and p0[0]["total_pages"] == 4
    p99 = index.page(page=99).collect()
    assert [r.symbol for r in p99] == order[30:] and p99[0]["page"] == 4
    january = [r.symbol for r in v.collect() if r.month_year == "01-2026"]
    assert [[r.symbol for r in index.page("01-2026", n).collect()] for n in (1, 2)] == [january[:10], january[10:]]
    assert [len(index.page("02-2026", n, 4).collect()) for n in (1, 7)] == [4, 1]
    assert index.page("03-2026", 2).count() == 0
    again = serve.PageIndex.open(spark, str(tmp_path / "index")).page(page=2)
    assert [r.symbol for r in again.collect()] == order[10:20] and set(again.columns) == {*v.columns, "page", "total_pages"}
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert " = all)" in plan and "PartitionFilters: [isnotnull(month" in plan and "Offset" not in plan and "Limit" not in plan
    none = serve.PageIndex.build(v.filter("false"), str(tmp_path / "none"))
    assert none.page(page=5).count() == 0


def test_signals_json_sorted_keys_and_text_decimals(spark):
    v = view_df(spark, [("A", D(2026, 1, 9), "10.50", 5.0, 1.25)])
    import json

    rec = json.loads(serve.signals_json(v).collect()[0][0])
    assert list(rec) == sorted(rec)
    assert rec["close_price"] == "10.50" and rec["_file_date"] == "2026-01-09" and rec["3X_180dvol_MULTIPLE"] == 1.25


# ---------------------------------------------------------------- watchlist
CH = "ts timestamp_ntz, seq bigint, op string, symbol string, note string, file_name string, reminder_time string, event_id string"


def changes(spark, data):
    t0 = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(t0 + dt.timedelta(minutes=i), i, *r) for i, r in enumerate(data)], CH)


def test_watchlist_update_keeps_event_id_and_id(spark):
    cur = spark.createDataFrame(
        [(7, "INFY", "old", "f", None, True, "ev1")], watchlist.WATCHLIST_SCHEMA
    )
    ch = changes(spark, [("upsert", "INFY", "new", "g", "2024-01-20T10:30", None), ("upsert", "", "x", "", None, None)])
    got = watchlist.watchlist_apply(cur, ch).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["id"], r["note"], r["is_notified"], r["event_id"]) == (7, "new", True, "ev1")
    assert r["reminder_time"] == dt.datetime(2024, 1, 20, 10, 30)


def test_watchlist_upsert_delete_upsert(spark):
    cur = spark.createDataFrame([(3, "TCS", "n", "f", None, True, "ev0")], watchlist.WATCHLIST_SCHEMA)
    ch = changes(
        spark,
        [
            ("upsert", "TCS", "a", "f1", None, "ev1"),
            ("delete", "TCS", None, None, None, None),
            ("upsert", "TCS", "b", "f2", None, None),
            ("upsert", "NEW", "c", "f3", "", "ev9"),
            ("delete", "GONE", None, None, None, None),
        ],
    )
    got = {r["symbol"]: r for r in watchlist.watchlist_apply(cur, ch).collect()}
    assert set(got) == {"TCS", "NEW"}
    assert (got["TCS"]["id"], got["TCS"]["note"], got["TCS"]["event_id"], got["TCS"]["is_notified"]) == (4, "b", None, False)
    assert (got["NEW"]["id"], got["NEW"]["event_id"], got["NEW"]["reminder_time"]) == (5, "ev9", None)


def test_watchlist_view(spark):
    wl = spark.createDataFrame(
        [(1, "A", "  ", "", dt.datetime(2024, 1, 10, 9, 0, 0), False, None), (2, "B", "note", "2024-01-02", None, False, "e")],
        watchlist.WATCHLIST_SCHEMA,
    )
    got = {r["symbol"]: r for r in watchlist.watchlist_view(wl, now=dt.datetime(2024, 1, 15)).collect()}
    assert got["A"]["note_display"] == watchlist.NO_NOTE and got["A"]["file_name_display"] == " "
    assert got["A"]["is_expired"] and got["A"]["calendar_url"].endswith("/day/2024/01/10")
    assert got["A"]["reminder_end"] == dt.datetime(2024, 1, 10, 9, 30)
    assert not got["B"]["is_expired"] and got["B"]["calendar_url"] == watchlist.CALENDAR_URL
    assert [r["symbol"] for r in watchlist.watchlist_view(wl).collect()] == ["B", "A"]


# ------------------------------------------------------------------ widgets
def test_widget_first_match_and_rounding(spark, tmp_path):
    p1 = '{"data": [{"name": "other", "values": [{"x": 1.25, "s": "a"}]}, {"name": "My WL Volume % gain", "values": [{"x": 0.35, "s": "b", "n": 3}]}, {"name": "WL Volume % gain 2", "values": [{"x": 9.0, "s": "c"}]}]}'
    p2 = '{"data": [{"name": "WL Volume % gain", "values": []}]}'
    p3 = '{"data": []}'
    df = spark.createDataFrame([(p1,), (p2,), (p3,)], "payload string")
    got = widgets.widget_rows(df).collect()
    assert len(got) == 1
    r = got[0].asDict()
    assert r == {"n": 3.0, "s": "b", "x": float(np.round(0.35, 1))}


def _fold(statuses, limit=5):
    """Sequential reference of the download loop's run counter."""
    run, out, stopped = 0, [], False
    for s in statuses:
        stopped = stopped or run >= limit
        out.append((run, not stopped))
        if s in (200, 0):
            run = 0
        elif s is not None:
            run += 1
    return out


def test_fetch_window_hot_feed_spans_partitions(spark):
    """One feed holding most rows is split over many partitions; the segmented
    scan must equal the sequential fold."""
    import random

    rnd = random.Random(7)
    choices = [200, 404, 404, 500, -1, 0, None, 404]
    t0 = dt.datetime(2024, 1, 1)
    data, expect = [], {}
    for feed, n in [("hot", 3000), ("a", 40), ("b", 7), ("z", 300)]:
        # rare resets in the hot feed so runs cross partition boundaries
        sts = [rnd.choice(choices) if rnd.random() < 0.02 or feed != "hot" else rnd.choice([404, None, 500]) for _ in range(n)]
        if feed == "hot":
            sts = [200 if i % 997 == 0 else s for i, s in enumerate(sts)]
            sts = [s if s != 404 or i < 2990 else 404 for i, s in enumerate(sts)]
        for i, s in enumerate(sts):
            data.append((feed, f"{feed}{i}", t0 + dt.timedelta(seconds=i), i, s))
        expect[feed] = _fold(sts)
    df = spark.createDataFrame(data, "feed string, filename string, ts timestamp_ntz, seq bigint, status int")
    got = {}
    for r in files.fetch_window_rows(df, limit=5000).collect():
        got.setdefault(r["feed"], {})[r["seq"]] = (r["run_before"], r["made"])
    for feed, exp in expect.items():
        assert [got[feed][i] for i in range(len(exp))] == [
            (rb, m) for rb, m in [(x[0], x[1]) for x in _fold([d[4] for d in data if d[0] == feed], 5000)]
        ], feed
    got5 = {}
    for r in files.fetch_window_rows(df).collect():
        got5.setdefault(r["feed"], {})[r["seq"]] = (r["run_before"], r["made"])
    for feed, exp in expect.items():
        assert [got5[feed][i] for i in range(len(exp))] == exp, feed


def test_widget_schema_is_that_of_the_matched_widget(spark):
    other = {"name": "Other", "values": [{"x": "text", "y": 1}]}
    mine = {"name": "my WL Volume % gain", "values": [{"x": 1.27, "s": "A"}, {"x": 3, "s": None}]}
    docs = [
        ("d1", json.dumps({"data": [other, mine]})),
        ("d2", json.dumps({"data": []})),
        ("d3", "not json"),
        ("d4", None),
        ("d5", json.dumps({"data": [{"name": None, "values": None}]})),
        ("d6", json.dumps({"data": [{"name": "WL Volume % gain", "values": []}]})),
    ]
    payloads = spark.createDataFrame(docs, "day string, payload string")
    out = widgets.widget_rows(payloads, keep=["day"])
    assert out.columns == ["day", "s", "x"]
    assert rows(out) == sorted([("d1", "A", 1.3), ("d1", None, 3.0)], key=repr)
    assert widgets.unreadable_payloads(payloads).collect()[0].unreadable == 1
    none = widgets.widget_rows(payloads.filter("day <> 'd1'"))
    assert none.columns == [] and none.count() == 0
