"""Serving views over the signal table: the history listing, one page of it,
month counts, and JSON records.

Pages are read by position from a stored index (``PageIndex``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.gold import MULTIPLE_COLUMN
from tidemark.operators.ids import dense_positions
from tidemark.operators.silver import MA_COLUMN

# Chart link prefix, page size, and the serving column names.
CHART_URL = "https://in.tradingview.com/chart/?symbol="
PAGE_SIZE = 10
MA_LABEL = "50-week moving average"

def _display_order():
    return [F.col(MULTIPLE_COLUMN).desc_nulls_last(), F.col("symbol").asc(), F.col("_file_date").asc()]


def signal_history_view(signals: DataFrame, chart_url: str = CHART_URL) -> DataFrame:
    """Signals with the month label, renamed columns, price colour (green when
    the close is above its moving average; missing average -> red) and chart
    link, ordered by the volume multiple (NULLs last)."""
    return signals.select(
        "_file_date",
        F.date_format("_file_date", "MM-yyyy").alias("month_year"),
        "symbol",
        "close_price",
        F.col(MA_COLUMN).alias(MA_LABEL),
        "prev_180d_friday_high",
        MULTIPLE_COLUMN,
        "IS_3X_SURGE",
        F.col("IS_BREAKOUT").alias("IS_PRICE_BREAKOUT"),
        F.when(F.col("close_price").cast("double") > F.col(MA_COLUMN), F.lit("green"))
        .otherwise(F.lit("red"))
        .alias("price_color"),
        F.concat(F.lit(chart_url), F.col("symbol")).alias("chart_url"),
    ).orderBy(*_display_order())


#: The month that stands for all rows.
ALL = "all"


@dataclass(frozen=True)
class PageIndex:
    """The view with the position of each row within its month and within all rows
    (``rows``: month, pos and the view's columns, a folder for each month, in order), and
    the number of rows of each month (``totals``)."""

    rows: DataFrame
    totals: DataFrame

    @classmethod
    def build(cls, view: DataFrame, path: str) -> PageIndex:
        """Stores the index of ``view`` under ``path``.  Positions come from one sort
        over ranges and one row for each month; no task holds a month."""
        spark = view.sparkSession
        order = F.struct(F.col(MULTIPLE_COLUMN).isNull().alias("n"), (-F.col(MULTIPLE_COLUMN)).alias("m"), "symbol", "_file_date")
        whole = view.withColumn("month", F.lit(ALL))
        rows = whole.unionByName(view.filter(F.col("month_year").isNotNull()).withColumn("month", F.col("month_year")))
        placed = dense_positions(rows.withColumn("_order", F.struct("month", order.alias("o"))), "_order").drop("_order").checkpoint()
        counts = placed.groupBy("month").agg(F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("total"))
        # one row for each month
        numbered = placed.join(F.broadcast(counts.select("month", "_start")), "month").withColumn("pos", F.col("_pos") - F.col("_start") + 1).drop("_pos", "_start")
        numbered.repartitionByRange("month", "pos").sortWithinPartitions("month", "pos").write.mode("overwrite").partitionBy("month").parquet(f"{path}/rows")
        counts.select("month", "total").write.mode("overwrite").parquet(f"{path}/totals")
        return cls.open(spark, path, numbered.schema)

    @classmethod
    def open(cls, spark: SparkSession, path: str, schema: T.StructType | None = None) -> PageIndex:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return cls(reader.parquet(f"{path}/rows"), spark.read.schema("month string, total bigint").parquet(f"{path}/totals"))

    def page(self, month: str = ALL, page: int = 1, page_size: int = PAGE_SIZE) -> DataFrame:
        """One page of a month: the rows at its positions.  The page number is clamped to
        1..total pages, of which there is at least one; the total comes from the index,
        and no row is counted or skipped."""
        total = F.coalesce(self.totals.filter(F.col("month") == month).agg(F.max("total")).scalar(), F.lit(0))
        pages = F.greatest(F.ceil(total / page_size), F.lit(1)).cast("bigint")
        number = F.least(F.greatest(F.lit(int(page)).cast("bigint"), F.lit(1)), pages)
        at = F.col("pos").between((number - 1) * page_size + 1, number * page_size)
        rows = self.rows.filter((F.col("month") == month) & at).orderBy("pos")
        return rows.drop("month", "pos").withColumns({"page": number, "total_pages": pages})


def signal_month_counts(view: DataFrame, chronological: bool = False) -> DataFrame:
    """Distinct symbols and rows per month plus an ``all`` row, in one pass over the
    view (a rollup); months in reverse text order of ``MM-yyyy`` (so 12-2025 precedes
    01-2026), or newest month first with ``chronological=True``."""
    counts = view.rollup("month_year").agg(
        F.countDistinct("symbol").alias("symbol_count"), F.count(F.lit(1)).alias("row_count"), F.grouping("month_year").alias("_all")
    )
    month_start = F.try_to_timestamp(F.concat(F.lit("01-"), F.col("month_year")), F.lit("dd-MM-yyyy"))
    key = month_start if chronological else F.col("month_year")
    named = F.when(F.col("_all") == 1, F.lit(ALL)).otherwise(F.col("month_year"))
    # an empty view has its row for all months as well
    none = view.sparkSession.range(1).select(F.lit(None).cast("string").alias("month_year"), F.lit(0).cast("long").alias("symbol_count"), F.lit(0).cast("long").alias("row_count"), F.lit(1).cast("tinyint").alias("_all"))
    counts = counts.unionByName(none).groupBy("month_year", "_all").agg(F.max("symbol_count").alias("symbol_count"), F.max("row_count").alias("row_count"))
    ordered = counts.withColumn("_key", key).select(named.alias("month_year"), "symbol_count", "row_count", "_all", "_key")
    return ordered.orderBy(F.col("_all").desc(), F.col("_key").desc()).drop("_all", "_key")


def signals_json(view: DataFrame) -> DataFrame:
    """One JSON record per row with keys in sorted order, decimals as text and
    dates as ISO text (how the dashboard API serialises rows)."""
    cols = []
    for f in sorted(view.schema.fields, key=lambda f: f.name):
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("decimal", "date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return view.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))
