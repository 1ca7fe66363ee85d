"""Adapters from the driver's TPC-H-like tables to the reference's inputs.

The reference ships no data, so every input is derived (by Spark, from the
given tables) with the mappings documented in FIXTURES.md:

* X1 bars            <- lineitem   (one bar per supplier and ship date)
* X2 raw files       <- X1         (one space-padded CSV file per date)
* X3 landed files    <- orders     (dates of orders with status 'P')
* X4 fetch attempts  <- events
* X5 watchlist log   <- events
* X6 widget payloads <- events
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import daily_file_name
from tidemark.sources.bhavcopy import BHAVCOPY_COLUMNS

# Symbol suffixes by supplier key modulo 10 (X2).  The first
# three are dropped by the stock filter; the fourth must survive because the
# exclusion patterns are anchored at the end.
X2_SUFFIX = {0: "BEES", 1: "ETF", 2: "SDLX", 3: "BEESX"}
# Latest ship date at every scale.
LAST_DATE = "2001-11-04"
# Suppliers per raw file: bounds one file (one row, one string) whatever the
# scale.  All blocks of a day are named ``sec_bhavdata_full_b<k>_<ddMMyyyy>.csv``
# (the date is the part after the last underscore).
FILE_BLOCK = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ----------------------------------------------------------------------- X1
def _bars_keyed(lineitem: DataFrame) -> DataFrame:
    px = F.col("l_extendedprice").cast("decimal(12,2)")
    qty = F.col("l_quantity").cast("bigint")
    delivered = F.when(F.col("l_returnflag") == "N", qty).otherwise(F.lit(0).cast("bigint"))
    return lineitem.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("_file_date")).agg(
        F.min(px).alias("open_price"),
        F.max(px).alias("high_price"),
        F.min(px).alias("low_price"),
        F.max(px).alias("close_price"),
        F.sum(qty).alias("TTL_TRD_QNTY"),
        F.sum(delivered).alias("DELIV_QTY"),
    )


def _symbol(key) -> "F.Column":
    return F.concat(F.lit("S"), F.lpad(F.col(key).cast("string"), 6, "0"))


def _no_symbol() -> "F.Column":
    """Bars without symbol: all of the last ship date, and those of every tenth
    supplier on the first of a month."""
    scattered = (F.col("l_suppkey") % 10 == 8) & (F.dayofmonth("_file_date") == 1)
    return (F.col("_file_date") == F.lit(LAST_DATE).cast("date")) | scattered


def bars_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """X1: silver bars, one per (supplier, ship date)."""
    return _bars_keyed(lineitem).select(
        F.when(~_no_symbol(), _symbol("l_suppkey")).alias("symbol"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "TTL_TRD_QNTY",
        "DELIV_QTY",
        "_file_date",
    )


def bars(spark: SparkSession, sf_dir: str, through=None) -> DataFrame:
    """X1 bars; ``through`` keeps the bars a run on that date would have seen."""
    b = bars_from_lineitem(table(spark, sf_dir, "lineitem"))
    if through is not None:
        b = b.filter(F.col("_file_date") <= F.lit(through).cast("date"))
    return b


# ----------------------------------------------------------------------- X2
def _x2_symbol(key: str) -> "F.Column":
    k = F.col(key) % 10
    suffix = F.lit("")
    for m, s in sorted(X2_SUFFIX.items(), reverse=True):
        suffix = F.when(k == m, F.lit(s)).otherwise(suffix)
    return F.concat(_symbol(key), suffix)


def bhavcopy_lines(lineitem: DataFrame) -> DataFrame:
    """X2 line per bar: (filename, _file_date, line)."""
    b = _bars_keyed(lineitem)
    sym = _x2_symbol("l_suppkey")
    sym_text = F.when(F.col("l_suppkey") % 4 == 1, F.lower(sym)).otherwise(sym)
    series = F.when(F.col("l_suppkey") % 10 == 9, F.lit("BE")).otherwise(F.lit("EQ"))
    s = lambda c: F.col(c).cast("string")
    deliv = F.when(F.col("DELIV_QTY") == 0, F.lit("")).otherwise(s("DELIV_QTY"))
    deliv_pct = F.when(F.col("DELIV_QTY") == 0, F.lit("NA")).otherwise(
        F.expr("DELIV_QTY * 100 div TTL_TRD_QNTY").cast("string")
    )
    # a quoted field with a comma, a line end and a quote for every tenth supplier
    quoted = F.concat(F.lit('"'), s("TTL_TRD_QNTY"), F.lit(',\nx""y"'))
    spaced = lambda c: F.concat(F.lit(" "), c)
    padded = F.concat_ws(
        ",",
        F.when(_no_symbol(), F.lit("NA")).otherwise(F.concat(F.lit(" "), sym_text, F.lit(" "))),
        spaced(series),
        spaced(F.date_format("_file_date", "dd-MMM-yyyy")),
        *[spaced(s(c)) for c in ("close_price", "open_price", "high_price", "low_price", "close_price", "close_price", "close_price")],
        spaced(s("TTL_TRD_QNTY")),
        F.when(F.col("l_suppkey") % 10 == 4, quoted).otherwise(F.lit(" -")),
        spaced(s("TTL_TRD_QNTY")),
        spaced(deliv),
    )
    # The last field is written without padding so that 'NA' is read as NULL.
    block = F.floor(F.col("l_suppkey") / FILE_BLOCK)
    name = F.concat(
        F.lit("sec_bhavdata_full_b"), block.cast("string"), F.lit("_"),
        F.date_format("_file_date", "ddMMyyyy"), F.lit(".csv"),
    )
    return b.select(
        name.alias("filename"),
        "_file_date",
        F.concat(padded, F.lit(","), deliv_pct).alias("line"),
    )


HEADER = ", ".join(BHAVCOPY_COLUMNS)


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2: one raw file per ship date and block of suppliers, (filename, content)."""
    lines = bhavcopy_lines(table(spark, sf_dir, "lineitem"))
    body = F.concat_ws("\n", F.array_sort(F.collect_list("line")))
    return lines.groupBy("filename").agg(
        F.concat(F.lit(HEADER + "\n"), body, F.lit("\n")).alias("content")
    )


def raw_files_some_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 with broken files: by the day of the month the first lines lose a column
    (1), a line has a field too many (2), the file is empty (3) or has no content (4);
    files of the 5th have a name without date, and those of the 6th no stocks."""
    raw = raw_files(spark, sf_dir)
    day = F.substring(F.regexp_extract("filename", r"([0-9]{8})", 1), 1, 2).cast("int")
    content = (
        F.when(day == 1, F.regexp_replace("content", r"\A[^,]*,", ""))
        .when(day == 2, F.concat(F.col("content"), F.lit(",".join(["9"] * 16) + "\n")))
        .when(day == 3, F.lit(" \n"))
        .when(day == 4, F.lit(None).cast("string"))
        .when(day == 6, F.regexp_replace("content", r"(?s)\A([^\n]*\n).*", "$1"))
        .otherwise(F.col("content"))
    )
    return raw.select(F.when(day == 5, F.concat(F.lit("undated "), F.col("filename"), F.lit(".old"))).otherwise(F.col("filename")).alias("filename"), content.alias("content"))


# ----------------------------------------------------------------------- X3
def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3: file names already landed = dates of orders with status 'P'."""
    orders = table(spark, sf_dir, "orders")
    return (
        orders.filter(F.col("o_orderstatus") == "P")
        .select(F.col("o_orderdate").cast("date").alias("d"))
        .distinct()
        .select(daily_file_name("d").alias("filename"))
    )


def strike_table(calendar: DataFrame) -> DataFrame:
    """X3 strikes: ``day(d) % 4`` for each calendar date."""
    return calendar.select(
        daily_file_name("file_date").alias("filename"), (F.dayofmonth("file_date") % 4).alias("strikes")
    )


# ----------------------------------------------------------------------- X4
def fetch_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4: one attempt per event; error -> 404, purchase -> 200; of the signups a
    quarter each is a failed request (500), one that raised (-1) and a file found
    landed (0); the others are not attempted (NULL status)."""
    ev = table(spark, sf_dir, "events")
    signup = F.when(F.col("event_id") % 4 == 0, F.lit(500)).when(F.col("event_id") % 4 == 1, F.lit(-1)).when(F.col("event_id") % 4 == 2, F.lit(0))
    status = (
        F.when(F.col("event_type") == "error", F.lit(404))
        .when(F.col("event_type") == "purchase", F.lit(200))
        .when(F.col("event_type") == "signup", signup)
        .otherwise(F.lit(None).cast("int"))
    )
    feed = F.concat(F.lit("f"), F.col("user_id").cast("string"))
    return ev.select(
        feed.alias("feed"), feed.alias("filename"), "ts", F.col("event_id").alias("seq"), status.alias("status")
    )


def carried_strikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4: strikes of an earlier run, ``custkey % 3`` for the feed of each customer's key."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("f"), key.cast("string")).alias("filename"), (key % 3).cast("int").alias("strikes"))


# ----------------------------------------------------------------------- X5
def watchlist_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5: change log; error -> delete, anything else -> upsert."""
    ev = table(spark, sf_dir, "events")
    purchase = F.col("event_type") == "purchase"
    return ev.select(
        "ts",
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("upsert")).alias("op"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("event_type").alias("note"),
        F.col("ts").cast("date").cast("string").alias("file_name"),
        F.when(purchase, F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).alias("reminder_time"),
        F.when(purchase, F.col("event_id").cast("string")).alias("event_id"),
    )


def stored_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5: the watchlist that the changes meet, a row for every second customer's key."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").filter(key % 2 == 0).select(
        (key + 1).alias("id"),
        F.concat(F.lit("U"), key.cast("string")).alias("symbol"),
        F.col("c_mktsegment").alias("note"),
        F.lit(None).cast("string").alias("file_name"),
        F.lit(None).cast("timestamp_ntz").alias("reminder_time"),
        (key % 3 == 0).alias("is_notified"),
        F.when(key % 5 == 0, F.concat(F.lit("e"), key.cast("string"))).alias("event_id"),
    )


# ----------------------------------------------------------------------- X6
WIDGET_NAME = "WL Volume % gain"
# A later widget whose name matches as well, with fields of other types: not read.
CLASHING_WIDGET = '{"name":"old WL Volume % gain","values":[{"event_id":"x","user_id":[1],"value":"n/a","other":{"a":1}}]}'
PAYLOAD_CHUNK = 1000  # event ids per payload: bounds the size of one document


def widget_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6: JSON payloads ``{data: [{name, values: [...]}, ...]}``, one per day
    and block of event ids, one widget per event type; the purchase widget
    carries the watched name, and so does a later one with other field types."""
    ev = table(spark, sf_dir, "events")
    keyed = ev.select(
        F.col("ts").cast("date").alias("day"),
        F.floor(F.col("event_id") / PAYLOAD_CHUNK).alias("chunk"),
        "event_type",
        F.struct("event_id", "user_id", "value").alias("v"),
    )
    name = F.when(F.col("event_type") == "purchase", F.lit(WIDGET_NAME)).otherwise(
        F.concat(F.lit("Screener: "), F.col("event_type"))
    )
    widgets = keyed.groupBy("day", "chunk", "event_type").agg(F.array_sort(F.collect_list("v")).alias("values"))
    watched = F.col("event_type") == "purchase"
    each = widgets.select("day", "chunk", watched.alias("watched"), F.to_json(F.struct(name.alias("name"), "values")).alias("w"))
    data = F.concat_ws(",", F.array_sort(F.collect_list("w")), F.when(F.max("watched"), F.lit(CLASHING_WIDGET)))
    return each.groupBy("day", "chunk").agg(F.concat(F.lit('{"data":['), data, F.lit("]}")).alias("payload"))
