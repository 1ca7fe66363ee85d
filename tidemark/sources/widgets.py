"""Screener widget payloads: nested JSON flattened to rows.

A payload is ``{"data": [{"name": ..., "values": [{...record...}, ...]}, ...]}``.
The first widget whose name contains ``name`` is taken, its records become
rows, and every numeric field is cast to DOUBLE and rounded half-to-even to
``digits`` decimals (what ``DataFrame.astype(float).round(1)`` does).  A
widget with no records yields no rows.

Each payload is one row, so flattening is a per-row ``explode`` in the scan
stage; record fields are inferred from the matching widgets when no schema is given.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import round_half_even

# Fixed value: the widget watched by default.
WIDGET_NAME = "WL Volume % gain"

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _records(payloads: DataFrame, name: str, column: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` and one variant ``_record`` per record of the first widget whose
    name contains ``name``; unreadable payloads have none."""
    data = F.try_variant_get(F.try_parse_json(F.col(column)), "$.data", "array<variant>")
    named = F.filter(data, lambda w: F.coalesce(F.try_variant_get(w, "$.name", "string"), F.lit("")).contains(name))
    values = F.try_variant_get(F.try_element_at(named, F.lit(1)), "$.values", "array<variant>")
    return payloads.select(*keep, F.explode(values).alias("_record"))


def infer_record_schema(payloads: DataFrame, name: str = WIDGET_NAME, column: str = "payload") -> T.StructType:
    """Schema of the records of the widgets that match (a distributed pass, like
    reading JSON files); no other widget counts.  No record: no fields."""
    found = _records(payloads, name, column, []).filter(F.schema_of_variant("_record").startswith("OBJECT"))
    ddl = found.agg(F.schema_of_variant_agg("_record").alias("s")).collect()[0].s
    if not ddl or not ddl.startswith("OBJECT<") or ddl == "OBJECT<>":
        return T.StructType([])
    # numbers with a point are doubles, fields of mixed or unknown type text
    ddl = re.sub(r"DECIMAL\(\d+,\s*\d+\)|FLOAT", "DOUBLE", ddl.replace("OBJECT<", "STRUCT<"))
    return T._parse_datatype_string(re.sub(r"(?<=: )(VARIANT|VOID)\b", "STRING", ddl))


def widget_rows(
    payloads: DataFrame,
    name: str = WIDGET_NAME,
    record_schema: T.StructType | str | None = None,
    column: str = "payload",
    digits: int = 1,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of the matching widgets, after the columns ``keep`` of their payload
    (its day, say).  Unreadable payloads give no rows; ``unreadable_payloads``
    counts them."""
    if record_schema is None:
        record_schema = infer_record_schema(payloads, name, column)
    if isinstance(record_schema, str):
        record_schema = T._parse_datatype_string(record_schema)
    if not record_schema.fields:
        return payloads.select(*keep).limit(0)
    record = F.from_json(F.to_json("_record"), record_schema).alias("_r")
    rows = _records(payloads, name, column, list(keep)).select(*keep, record)
    out = []
    for f in record_schema.fields:
        c = F.col("_r")[f.name]
        out.append((round_half_even(c, digits) if isinstance(f.dataType, _NUMERIC) else c).alias(f.name))
    return rows.select(*keep, *out)


def unreadable_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """One row: how many non-null payloads are no JSON."""
    bad = F.col(column).isNotNull() & F.try_parse_json(F.col(column)).isNull()
    return payloads.agg(F.count_if(bad).alias("unreadable"))


# Name of a day's export.
EXPORT_PREFIX, EXPORT_DAY = "wl_volume_gain_", "ddMMyyyy"


def write_widget_csv(rows: DataFrame, out_dir: str, day: str) -> None:
    """CSV exports with a header and no index of all days of the date column ``day``, in
    one job: ``<out_dir>/file=wl_volume_gain_<ddMMyyyy>``, each a folder of part files.
    Days that are there already are replaced, others stay."""
    name = F.concat(F.lit(EXPORT_PREFIX), F.date_format(day, EXPORT_DAY))
    named = rows.withColumn("file", name).drop(day)
    (
        named.repartition("file")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("file")
        .csv(out_dir.rstrip("/"))
    )


def read_widget_csv(spark: SparkSession, out_dir: str, record_schema: str, day: str = "day") -> DataFrame:
    """Exported rows and their day."""
    rows = spark.read.option("header", True).schema(f"{record_schema}, file string").csv(out_dir.rstrip("/"))
    date = F.to_date(F.substring_index("file", "_", -1), EXPORT_DAY)
    return rows.select(date.alias(day), *[c for c in rows.columns if c != "file"])
