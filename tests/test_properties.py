"""Randomised parity checks of the subtle scalar rules, in bulk (one Spark job
per property): DuckDB's ROUND on DOUBLE, numpy's half-even rounding, the
exact decimal window mean, and the stock-filter regex."""

import random
import re
from decimal import Decimal

import duckdb
import numpy as np
from pyspark.sql import Window

from tidemark.functions.scalars import exact_decimal_mean, round_half_away, round_half_even
from tidemark.sources import bhavcopy

RND = random.Random(20240101)


def _doubles(n=4000):
    vals = []
    for _ in range(n):
        k = RND.randint(0, 4)
        if k == 0:  # x.xx5 style ties
            vals.append(RND.randint(-10**6, 10**6) / 1000 + 0.0005)
        elif k == 1:
            vals.append(RND.randint(-10**7, 10**7) / 1000)
        elif k == 2:
            vals.append(RND.uniform(-1e6, 1e6))
        elif k == 3:
            vals.append(RND.randint(0, 10**9) / RND.choice([3, 7, 9, 11]))
        else:
            vals.append(RND.randint(-1000, 1000) + 0.5)
    return vals


def test_round_half_away_matches_duckdb(spark):
    vals = _doubles()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = {r[0]: (r[1], r[2]) for r in df.select("i", round_half_away("x", 2), round_half_away("x", 0)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    exp = {r[0]: (r[1], r[2]) for r in con.execute("SELECT i, ROUND(x, 2), ROUND(x, 0) FROM t").fetchall()}
    assert got == exp


def test_round_half_even_matches_numpy(spark):
    vals = _doubles()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = [r[1] for r in sorted(df.select("i", round_half_even("x", 1)).collect())]
    assert got == list(np.round(np.array(vals), 1))


def test_exact_decimal_mean_matches_duckdb_avg(spark):
    rows = []
    for s in range(40):
        for d in range(RND.randint(1, 120)):
            rows.append((f"S{s}", d, Decimal(RND.randint(1, 10**8)) / 100))
    df = spark.createDataFrame(rows, "s string, d int, p decimal(12,2)")
    w = Window.partitionBy("s").orderBy("d").rowsBetween(-49, 0)
    got = {(r[0], r[1]): r[2] for r in df.select("s", "d", round_half_away(exact_decimal_mean("p", w), 2)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (s VARCHAR, d INTEGER, p DECIMAL(12,2))")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    exp = {
        (r[0], r[1]): r[2]
        for r in con.execute(
            "SELECT s, d, ROUND(AVG(p) OVER (PARTITION BY s ORDER BY d ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 2) FROM t"
        ).fetchall()
    }
    assert got == exp


def test_stock_filter_regex_matches_python_re(spark):
    parts = ["BEES", "ETF", "IETF", "CASE", "ADD", "GOLD", "SILVER", "LIQUID", "BETA", "GILT", "NIFTY", "SDL",
             "VALUE", "QUAL", "MOM", "ALPHA", "LOWVOL", "HEALTHY", "CONSUMER", "FINANCE", "MOGSEC", "MOMENTUM",
             "NIFTY50", "GROWWLIQID", "INFY", "TCS", "X", "1", "S"]
    syms = set()
    for _ in range(3000):
        syms.add("".join(RND.choice(parts) for _ in range(RND.randint(1, 3))))
    syms |= set(parts)
    df = spark.createDataFrame([(s, "EQ") for s in sorted(syms)], "SYMBOL string, SERIES string")
    got = {r[0] for r in bhavcopy.stock_filter(df).collect()}
    pat = re.compile("|".join(bhavcopy.EXCLUDE_PATTERNS))
    assert got == {s for s in syms if not pat.search(s)}
