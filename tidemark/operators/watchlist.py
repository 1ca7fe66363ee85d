"""Watchlist table maintained from a change log, and its display view.

Table: ``id, symbol, note, file_name, reminder_time, is_notified, event_id``.
Change log: ``symbol, op ('upsert' | 'delete'), note, file_name,
reminder_time (text), event_id`` plus the ordering columns.

Folding a batch per symbol: only changes after the symbol's last delete
count; the last upsert gives note / file name / reminder; the event id is the
last non-NULL one (an update keeps the old id when it brings none).  A symbol
present, and not deleted in the batch, keeps its id and ``is_notified``;
otherwise it gets a new id ``max(id) + position`` in order of its first
change after the delete, and ``is_notified = false``.  (The one-at-a-time
reference can reuse the id of a deleted maximum row; a batch does not.)

Changes are combined map-side by (symbol, day) before any join, so a symbol with a
huge log is a row a day; new ids come from ``dense_positions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import strip_ws
from tidemark.operators.ids import dense_positions
from tidemark.operators.serve import CHART_URL

# Calendar link base and placeholder texts of the view.
CALENDAR_URL = "https://calendar.google.com/calendar/r"
NO_NOTE = "No descriptive note attached"
WATCHLIST_COLUMNS = ["id", "symbol", "note", "file_name", "reminder_time", "is_notified", "event_id"]
WATCHLIST_SCHEMA = (
    "id bigint, symbol string, note string, file_name string, reminder_time timestamp_ntz, "
    "is_notified boolean, event_id string"
)


def normalise_reminder(raw: Column) -> Column:
    """``yyyy-MM-ddTHH:mm[:ss]`` text to TIMESTAMP_NTZ: every 'T' becomes a
    space and ':00' is added to a 16-character value; blank -> NULL."""
    s = F.replace(raw, F.lit("T"), F.lit(" "))
    s = F.when(F.length(s) == 16, F.concat(s, F.lit(":00"))).otherwise(s)
    ts = s.try_cast("timestamp_ntz")  # wall-clock text, independent of the session time zone
    return F.when(raw.isNull() | (raw == ""), F.lit(None).cast("timestamp_ntz")).otherwise(ts)


def _folded(changes: DataFrame, order_cols) -> DataFrame:
    """What a batch says of each symbol: its last delete (``_del``), and of the upserts
    after it the last one's values, the last event id and the first one's order.

    Changes fold to a row for each (symbol, day) map-side.  All but the first upsert
    after the delete follows from these; for that the changes of the delete's day alone
    are looked at again."""
    never = F.lit("0001-01-01").cast("date")
    day = lambda c: F.coalesce(F.to_date(c), never)
    ch = changes.filter(F.col("symbol").isNotNull() & (F.col("symbol") != "")).withColumn("_o", F.struct(*order_cols)).withColumn("_day", day(F.col(order_cols[0])))
    is_del = F.col("op") == "delete"
    values = F.struct("_o", "note", "file_name", "reminder_time")
    days = ch.groupBy("symbol", "_day").agg(
        F.max(F.when(is_del, F.col("_o"))).alias("_del"),
        F.min(F.when(~is_del, F.col("_o"))).alias("_first"),
        F.max(F.when(~is_del, values)).alias("_last"),
        F.max(F.when(~is_del & F.col("event_id").isNotNull(), F.struct("_o", "event_id"))).alias("_event"),
    )
    per = days.groupBy("symbol").agg(F.max("_del").alias("_del"), F.max("_last").alias("_last"), F.max("_event").alias("_event"))
    after = lambda c: F.col("_del").isNull() | (F.col(c)["_o"] > F.col("_del"))
    of_day = per.filter(F.col("_del").isNotNull()).select("symbol", "_del", day(F.col("_del")[order_cols[0]]).alias("_day"))
    later = days.select("symbol", "_day", "_first").join(of_day.withColumnRenamed("_day", "_del_day"), "symbol", "left")
    later = later.filter(F.col("_del_day").isNull() | (F.col("_day") > F.col("_del_day"))).select("symbol", "_first")
    same = ch.filter(~is_del).join(of_day, ["symbol", "_day"]).filter(F.col("_o") > F.col("_del")).select("symbol", F.col("_o").alias("_first"))
    first = later.unionByName(same).groupBy("symbol").agg(F.min("_first").alias("_first"))
    last = F.when(after("_last"), F.col("_last"))
    return per.join(first, "symbol", "left").select(
        "symbol",
        F.col("_del").isNotNull().alias("_deleted"),
        last.isNotNull().alias("_upserted"),
        last["note"].alias("note"),
        last["file_name"].alias("file_name"),
        normalise_reminder(last["reminder_time"]).alias("reminder_time"),
        F.when(after("_event"), F.col("_event.event_id")).alias("_event"),
        "_first",
    )


def watchlist_apply(current: DataFrame, changes: DataFrame, order_cols=("ts", "seq")) -> DataFrame:
    """The watchlist after applying a batch of changes; the first of ``order_cols`` is a
    time.  ``current`` meets one row for each symbol of the batch."""
    batch = _folded(changes, order_cols)
    last_del = batch.filter("_deleted")
    upserted = batch.filter("_upserted").drop("_deleted", "_upserted")

    kept = current.join(last_del.select("symbol"), "symbol", "left_anti")
    updated = kept.alias("c").join(upserted.alias("u"), "symbol", "left").select(
        F.col("c.id").alias("id"),
        F.col("symbol"),
        F.coalesce(F.col("u._first").isNotNull(), F.lit(False)).alias("_touched"),
        F.col("c.note"),
        F.col("u.note").alias("_note"),
        F.col("c.file_name"),
        F.col("u.file_name").alias("_file_name"),
        F.col("c.reminder_time"),
        F.col("u.reminder_time").alias("_reminder"),
        F.col("c.is_notified"),
        F.col("c.event_id"),
        F.col("u._event"),
    )
    t = F.col("_touched")
    existing = updated.select(
        "id",
        "symbol",
        F.when(t, F.col("_note")).otherwise(F.col("note")).alias("note"),
        F.when(t, F.col("_file_name")).otherwise(F.col("file_name")).alias("file_name"),
        F.when(t, F.col("_reminder")).otherwise(F.col("reminder_time")).alias("reminder_time"),
        "is_notified",
        F.coalesce(F.col("_event"), F.col("event_id")).alias("event_id"),
    )

    fresh = upserted.join(kept.select("symbol"), "symbol", "left_anti")
    base = F.coalesce(current.agg(F.max("id")).scalar(), F.lit(0)).cast("bigint")
    inserted = dense_positions(fresh, "_first").select(
        (base + F.col("_pos")).alias("id"),
        "symbol",
        "note",
        "file_name",
        "reminder_time",
        F.lit(False).alias("is_notified"),
        F.col("_event").alias("event_id"),
    )
    return existing.unionByName(inserted).select(*WATCHLIST_COLUMNS)


def empty_watchlist(spark) -> DataFrame:
    return spark.createDataFrame([], WATCHLIST_SCHEMA)


def watchlist_view(watchlist: DataFrame, now=None, chart_url: str = CHART_URL) -> DataFrame:
    """Display rows, newest id first: note placeholder, blank file date as a
    space, calendar-day link, expiry against ``now`` (seconds precision) and
    the 30-minute reminder end."""
    now_c = F.localtimestamp() if now is None else F.lit(now).cast("timestamp_ntz")
    r = F.col("reminder_time")
    note_ok = F.col("note").isNotNull() & (strip_ws(F.col("note")) != "")
    return watchlist.select(
        "id",
        "symbol",
        F.when(note_ok, F.col("note")).otherwise(F.lit(NO_NOTE)).alias("note_display"),
        F.when(F.col("file_name").isNotNull() & (F.col("file_name") != ""), F.col("file_name"))
        .otherwise(F.lit(" "))
        .alias("file_name_display"),
        "reminder_time",
        (r + F.expr("INTERVAL 30 MINUTES")).alias("reminder_end"),
        "is_notified",
        F.when(r.isNotNull(), F.concat(F.lit(CALENDAR_URL + "/day/"), F.date_format(r, "yyyy/MM/dd")))
        .otherwise(F.lit(CALENDAR_URL))
        .alias("calendar_url"),
        F.coalesce(now_c > F.date_trunc("second", r).cast("timestamp_ntz"), F.lit(False)).alias("is_expired"),
        F.concat(F.lit(chart_url), F.col("symbol")).alias("chart_url"),
    ).orderBy(F.col("id").desc())
