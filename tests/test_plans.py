"""Plan-shape checks: no Python in the hot path, shared exchanges, pruning,
and the anchor date as a scalar subquery."""

import re

from tests.conftest import SF_SMALL
from tidemark.operators import gold, silver
from tidemark.sources import bhavcopy
from tidemark.sources import fixtures as X

from tidemark.plans import pipeline, registry

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_python_in_any_registered_query(spark):
    # these write fixtures first; the state of the fetch stream is kept by a Python function
    skip = {"land_files", "run_pipeline", "stream_ingest", "fetch_state"}
    for name, fn in registry.QUERIES.items():
        if name in skip:
            continue
        p = plan(fn(spark, SF_SMALL))
        assert not any(n in p for n in PY_NODES), name


def test_both_checks_share_one_symbol_shuffle(spark):
    """Signal history: the bars cross the network once (by symbol); every
    window reuses that partitioning."""
    bars = X.bars(spark, SF_SMALL)
    df = gold.weekly_signal_history(bars, "2001-11-04")
    df.collect()  # materialise the adaptive plan
    final = df._jdf.queryExecution().executedPlan().toString()
    by_symbol = set(re.findall(r"Exchange hashpartitioning\(symbol#\d+, \d+\)", final))
    assert len(by_symbol) == 1, final
    assert not re.search(r"Exchange hashpartitioning\(symbol#\d+, week_start", final)


def test_month_counts_scan_the_view_once(spark):
    from tidemark.operators import serve

    view = serve.signal_history_view(gold.weekly_signal_history(X.bars(spark, SF_SMALL), "2001-11-04"))
    scans = lambda df: optimized(df).count("Relation [")
    assert scans(serve.signal_month_counts(view)) == scans(view)


def test_history_of_a_catalog_table_needs_no_exchange_by_symbol(spark, tmp_path):
    bars = X.bars(spark, SF_SMALL)
    name = pipeline.save_table(bars, "bars", buckets=4, location=str(tmp_path), prefix="t_")
    assert name == "`t_silver`.`bhavcopy_clean`" and spark.catalog.databaseExists("t_silver")
    df = gold.weekly_signal_history(spark.table(name), "2001-11-04", factor=2)
    got = sorted(map(tuple, df.collect()))
    final = plan(df)
    assert "Bucketed: true" in final and "Exchange hashpartitioning(symbol" not in final, final
    assert got == sorted(map(tuple, gold.weekly_signal_history(bars, "2001-11-04", factor=2).collect()))


def test_scan_reads_only_needed_columns(spark):
    df = silver.weekly_volume(X.bars(spark, SF_SMALL), "2001-11-04")
    p = plan(df)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    cols = {c.split(":")[0] for c in schema.split(",")}
    assert cols <= {"l_suppkey", "l_quantity", "l_shipdate", "l_extendedprice", "l_returnflag"}
    assert "l_comment" not in schema and "l_discount" not in schema


def test_anchor_is_a_scalar_subquery_above_the_window(spark):
    df = silver.volume_surge_check(X.bars(spark, SF_SMALL), "2001-11-04")
    opt = optimized(df)
    assert "scalar-subquery" in opt
    # the anchor filter must stay above the window (frames need history)
    assert opt.index("Filter") < opt.index("Window")


def test_pending_files_reduces_bronze_before_the_join(spark):
    from tidemark.sources import landing

    raw = X.raw_files(spark, SF_SMALL)
    p = plan(landing.pending_files(raw, bhavcopy.bronze_rows(raw)))
    assert "LeftAnti" in p
    assert p.count("HashAggregate") >= 2  # distinct names, partial + final


def test_run_week_bound_reaches_the_scan(spark, tmp_path):
    """On a stored bars table the run-week filter is a pushed Parquet filter."""
    path = str(tmp_path / "bars")
    X.bars(spark, SF_SMALL).write.parquet(path)
    bars = spark.read.parquet(path)
    p = plan(silver.weekly_volume(bars, "2000-07-16"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", p).group(1)
    assert "LessThan(_file_date,2000-07-17)" in pushed, p


def test_prepartitioned_bars_need_no_new_exchange(spark):
    """Bars already hash-partitioned by symbol (as a bucketed table would be):
    the fused checks add no exchange of their own."""
    bars = X.bars(spark, SF_SMALL).repartition(8, "symbol")
    stats = silver.weekly_stats(bars, "2001-11-04")
    p = plan(stats)
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, 8\), REPARTITION_BY_NUM", p)) == 1, p
    assert not re.search(r"Exchange hashpartitioning\(symbol#\d+, \d+\), ENSURE_REQUIREMENTS", p), p
