"""DuckDB SQL for every registered query, over the driver's tables.

The weekly checks are computed on lists of a symbol's weeks, on top of the
FIXTURES.md mappings written in SQL; run dates are literals.  Sums are cast to
BIGINT and weeks to DATE so types line up with Spark's.
"""

from __future__ import annotations

from tidemark.operators.serve import CHART_URL
from tidemark.sources.bhavcopy import BHAVCOPY_COLUMNS, EXCLUDE_PATTERNS

YES = "'✅ YES'"
NO = "'❌ NO'"

# ----------------------------------------------------------------- fixtures
X1 = """
SELECT CASE WHEN CAST(l_shipdate AS DATE) = DATE '2001-11-04' OR (l_suppkey % 10 = 8 AND day(CAST(l_shipdate AS DATE)) = 1) THEN NULL
            ELSE 'S' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') END AS symbol,
       MIN(CAST(l_extendedprice AS DECIMAL(12,2))) AS open_price,
       MAX(CAST(l_extendedprice AS DECIMAL(12,2))) AS high_price,
       MIN(CAST(l_extendedprice AS DECIMAL(12,2))) AS low_price,
       MAX(CAST(l_extendedprice AS DECIMAL(12,2))) AS close_price,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS TTL_TRD_QNTY,
       CAST(SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS DELIV_QTY,
       CAST(l_shipdate AS DATE) AS _file_date,
       l_suppkey AS _key
FROM lineitem
GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
"""

X1_BARS = "SELECT symbol, open_price, high_price, low_price, close_price, TTL_TRD_QNTY, DELIV_QTY, _file_date FROM x1"


def bars_cte(through: str | None = None) -> str:
    where = f" WHERE _file_date <= DATE '{through}'" if through else ""
    return f"x1 AS ({X1}), bars AS ({X1_BARS}{where})"


def silver_ctes(src: str, as_of: str, factor=3) -> str:
    """``week_volume``, ``surges``, ``week_close`` and ``breakouts`` over the bars CTE
    ``src``.  The weeks of a symbol are put into one list, and every frame is a
    slice of that list: no window functions, so that the operators' frames are
    checked by another method."""
    return f"""
dated AS (
    SELECT *, CAST(_file_date - CAST(isodow(_file_date) - 1 AS INTEGER) AS DATE) AS monday FROM {src}
    WHERE _file_date < DATE '{as_of}' + CAST(8 - isodow(DATE '{as_of}') AS INTEGER)
),
week_volume AS (
    SELECT symbol, monday AS week_start, MAX(_file_date) AS week_end_date, CAST(SUM(TTL_TRD_QNTY) AS BIGINT) AS weekly_sum
    FROM dated GROUP BY ALL
),
volume_lists AS (
    SELECT symbol, list(week_end_date ORDER BY week_start) AS days, list(weekly_sum ORDER BY week_start) AS sums
    FROM week_volume GROUP BY ALL
),
volume_means AS (
    SELECT symbol, days[i] AS _file_date, sums[i] AS TTL_TRD_QNTY, list_avg(sums[greatest(i - 26, 1):i - 1]) AS mean_before
    FROM (SELECT *, unnest(range(1, len(days) + 1)) AS i FROM volume_lists)
),
surges AS (
    SELECT symbol, _file_date, TTL_TRD_QNTY, ROUND(mean_before, 0) AS avg_vol_180d,
           if(TTL_TRD_QNTY > mean_before * {factor}, {YES}, {NO}) AS IS_3X_SURGE
    FROM volume_means
),
week_close AS (
    SELECT symbol, MAX(_file_date) AS _file_date, arg_max(close_price, _file_date) AS close_price
    FROM dated WHERE symbol IS NOT NULL GROUP BY symbol, monday
),
close_lists AS (
    SELECT symbol, list(_file_date ORDER BY _file_date) AS days, list(close_price ORDER BY _file_date) AS closes
    FROM week_close GROUP BY ALL
),
breakouts AS (
    SELECT symbol, days[i] AS _file_date, closes[i] AS close_price,
           list_max(closes[greatest(i - 26, 1):i - 1]) AS prev_180d_friday_high,
           ROUND(list_avg(closes[greatest(i - 49, 1):i]), 2) AS "50w_Moving_avg",
           if(closes[i] > list_max(closes[greatest(i - 26, 1):i - 1]), {YES}, {NO}) AS IS_BREAKOUT
    FROM (SELECT *, unnest(range(1, len(days) + 1)) AS i FROM close_lists)
)"""


def gold_select(where: str, factor=3) -> str:
    """Rows of both checks on one day, as far as ``where`` goes."""
    return f"""
SELECT *, if(avg_vol_180d <> 0, ROUND(TTL_TRD_QNTY / (avg_vol_180d * {factor}), 2), NULL) AS "3X_180dvol_MULTIPLE"
FROM (FROM surges WHERE IS_3X_SURGE = {YES})
SEMI JOIN (SELECT symbol, _file_date FROM breakouts WHERE IS_BREAKOUT = {YES}) USING (symbol, _file_date)
JOIN breakouts USING (symbol, _file_date)
WHERE {where}"""


def history_with(src_ctes: str, as_of: str, factor=3) -> str:
    """``WITH ..., sig AS (signal history)`` -- a prefix for more CTEs."""
    # a day is the last of its week if no later bar of any symbol is in that week
    last = "_file_date IN (SELECT unnest(list_distinct(list(d))) FROM (SELECT MAX(_file_date) AS d FROM dated GROUP BY monday))"
    sig = gold_select(last, factor)
    return f"WITH {src_ctes}, {silver_ctes('bars', as_of, factor)},\nsig AS ({sig})"


def history_sql(src_ctes: str, as_of: str, factor=3) -> str:
    return history_with(src_ctes, as_of, factor) + "\nSELECT * FROM sig"


def as_of_signals_sql(src_ctes: str, as_of: str, factor=3, months: int = 2) -> str:
    where = (
        "_file_date = (SELECT _file_date FROM dated ORDER BY _file_date DESC LIMIT 1) "
        f"AND _file_date + INTERVAL {months} MONTH >= DATE '{as_of}'"
    )
    return f"WITH {src_ctes}, {silver_ctes('bars', as_of, factor)}\n" + gold_select(where, factor)


# ------------------------------------------------------- X2 raw files (text)
_SUFFIX = "CASE _key % 10 WHEN 0 THEN 'BEES' WHEN 1 THEN 'ETF' WHEN 2 THEN 'SDLX' WHEN 3 THEN 'BEESX' ELSE '' END"
EXCLUDE_REGEX = "|".join(EXCLUDE_PATTERNS)
HEADER = ", ".join(BHAVCOPY_COLUMNS)

X2 = f"""
SELECT x1.*,
       symbol || {_SUFFIX} AS x2_symbol,
       CASE WHEN _key % 10 = 9 THEN 'BE' ELSE 'EQ' END AS x2_series,
       'sec_bhavdata_full_b' || CAST(_key // 1000 AS VARCHAR) || '_'
         || strftime(_file_date, '%d%m%Y') || '.csv' AS filename
FROM x1
"""

X2_FIELDS = """
SELECT CASE WHEN _key % 4 = 1 THEN ' ' || lower(x2_symbol) || ' ' ELSE ' ' || x2_symbol || ' ' END AS SYMBOL,
       ' ' || x2_series AS SERIES,
       ' ' || strftime(_file_date, '%d-%b-%Y') AS DATE1,
       ' ' || CAST(close_price AS VARCHAR) AS PREV_CLOSE,
       ' ' || CAST(open_price AS VARCHAR) AS OPEN_PRICE,
       ' ' || CAST(high_price AS VARCHAR) AS HIGH_PRICE,
       ' ' || CAST(low_price AS VARCHAR) AS LOW_PRICE,
       ' ' || CAST(close_price AS VARCHAR) AS LAST_PRICE,
       ' ' || CAST(close_price AS VARCHAR) AS CLOSE_PRICE,
       ' ' || CAST(close_price AS VARCHAR) AS AVG_PRICE,
       ' ' || CAST(TTL_TRD_QNTY AS VARCHAR) AS TTL_TRD_QNTY,
       CASE WHEN _key % 10 = 4 THEN CAST(TTL_TRD_QNTY AS VARCHAR) || ',' || chr(10) || 'x"y' ELSE ' -' END AS TURNOVER_LACS,
       ' ' || CAST(TTL_TRD_QNTY AS VARCHAR) AS NO_OF_TRADES,
       ' ' || CASE WHEN DELIV_QTY = 0 THEN '' ELSE CAST(DELIV_QTY AS VARCHAR) END AS DELIV_QTY,
       CASE WHEN DELIV_QTY = 0 THEN NULL ELSE CAST(DELIV_QTY * 100 // TTL_TRD_QNTY AS VARCHAR) END AS DELIV_PER,
       filename AS _source_file,
       _file_date,
       x2_symbol, x2_series, _key
FROM x2
"""

X2_LINE = """
SELECT filename, _file_date,
       COALESCE(SYMBOL, 'NA') || ',' || SERIES || ',' || DATE1 || ',' || PREV_CLOSE || ',' || OPEN_PRICE || ',' || HIGH_PRICE || ','
       || LOW_PRICE || ',' || LAST_PRICE || ',' || CLOSE_PRICE || ',' || AVG_PRICE || ',' || TTL_TRD_QNTY || ','
       || CASE WHEN _key % 10 = 4 THEN '"' || replace(TURNOVER_LACS, '"', '""') || '"' ELSE TURNOVER_LACS END || ',' || NO_OF_TRADES || ',' || DELIV_QTY || ',' || COALESCE(DELIV_PER, 'NA') AS line
FROM (SELECT *, _source_file AS filename FROM x2f)
"""

X2_RAW = f"""
SELECT filename, '{HEADER}' || chr(10) || string_agg(line, chr(10) ORDER BY line) || chr(10) AS content
FROM x2line GROUP BY filename
"""

KEEP = f"x2_series = 'EQ' AND NOT regexp_matches(COALESCE(x2_symbol, ''), '{EXCLUDE_REGEX}')"


def x2_ctes() -> str:
    return (
        f"x1 AS ({X1}), x2 AS ({X2}), x2f AS ({X2_FIELDS}), x2line AS ({X2_LINE}), "
        f"x2raw AS ({X2_RAW})"
    )


PARSED_COLUMNS = ", ".join([*BHAVCOPY_COLUMNS, "_source_file", "_file_date"])

# Bars that survive the text round trip: stocks only, blank delivery -> NULL.
X2_BARS = f"""
SELECT x2_symbol AS symbol, open_price, high_price, low_price, close_price, TTL_TRD_QNTY,
       NULLIF(DELIV_QTY, 0) AS DELIV_QTY, _file_date
FROM x2 WHERE {KEEP}
"""

def file_errors_sql() -> str:
    """What becomes of each X2 file if those of the first days of a month are broken."""
    return f"""
WITH {x2_ctes()},
f AS (SELECT filename, day(any_value(_file_date)) AS d, count(*) FILTER ({KEEP}) AS kept FROM x2 GROUP BY filename),
e AS (
    SELECT CASE WHEN d = 5 THEN 'undated ' || filename || '.old' ELSE filename END AS filename,
           CASE d WHEN 1 THEN 'header does not have 15 columns' WHEN 2 THEN 'line with more than 15 fields'
                  WHEN 3 THEN 'empty file' WHEN 4 THEN 'no content' WHEN 5 THEN 'no ddMMyyyy date in file name' END AS error,
           CASE WHEN d <= 6 THEN 0 ELSE kept END AS rows_kept
    FROM f
)
SELECT filename, CASE WHEN error IS NOT NULL THEN 'bad' WHEN rows_kept = 0 THEN 'empty' ELSE 'loaded' END AS status, error, rows_kept
FROM e"""


# Files a previous run already processed: those dated before this day.
PREVIOUS_RUN = "1998-07-01"
DONE_BEFORE = f"_file_date < DATE '{PREVIOUS_RUN}'"


# ------------------------------------------------------------ serving views
VIEW = f"""
SELECT * EXCLUDE (TTL_TRD_QNTY, avg_vol_180d, IS_BREAKOUT, "50w_Moving_avg"),
       IS_BREAKOUT AS IS_PRICE_BREAKOUT,
       "50w_Moving_avg" AS "50-week moving average",
       strftime(_file_date, '%m-%Y') AS month_year,
       if("50w_Moving_avg" < CAST(close_price AS DOUBLE), 'green', 'red') AS price_color,
       concat('{CHART_URL}', symbol) AS chart_url
FROM sig
"""
DISPLAY_ORDER = '"3X_180dvol_MULTIPLE" DESC NULLS LAST, symbol ASC, _file_date ASC'


def view_with(src_ctes: str, as_of: str, factor=3) -> str:
    return history_with(src_ctes, as_of, factor) + f",\nv AS ({VIEW})"


def page_sql(src_ctes: str, as_of: str, page: int, size: int = 10, month: str = "all", factor=3) -> str:
    where = "" if month == "all" else f" WHERE month_year = '{month}'"
    return view_with(src_ctes, as_of, factor) + f""",
f AS (SELECT * FROM v{where}),
pages AS (SELECT CAST(GREATEST(CEIL(COUNT(*) / {size}.0), 1) AS BIGINT) AS total_pages FROM f),
cur AS (SELECT LEAST(GREATEST({page}, 1), total_pages) AS page, total_pages FROM pages),
ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {DISPLAY_ORDER}) AS rn FROM f)
SELECT ranked.* EXCLUDE (rn), CAST(cur.page AS BIGINT) AS page, cur.total_pages
FROM ranked, cur
WHERE rn > (cur.page - 1) * {size} AND rn <= cur.page * {size}"""


def month_counts_sql(src_ctes: str, as_of: str) -> str:
    return view_with(src_ctes, as_of) + """
SELECT month_year, COUNT(DISTINCT symbol) AS symbol_count, COUNT(*) AS row_count FROM v GROUP BY month_year
UNION ALL
SELECT 'all', COUNT(DISTINCT symbol), COUNT(*) FROM v"""


def json_sql(src_ctes: str, as_of: str) -> str:
    return view_with(src_ctes, as_of) + """
SELECT CAST(json_object(
    '3X_180dvol_MULTIPLE', "3X_180dvol_MULTIPLE",
    '50-week moving average', "50-week moving average",
    'IS_3X_SURGE', IS_3X_SURGE,
    'IS_PRICE_BREAKOUT', IS_PRICE_BREAKOUT,
    '_file_date', CAST(_file_date AS VARCHAR),
    'chart_url', chart_url,
    'close_price', CAST(close_price AS VARCHAR),
    'month_year', month_year,
    'prev_180d_friday_high', CAST(prev_180d_friday_high AS VARCHAR),
    'price_color', price_color,
    'symbol', symbol) AS VARCHAR) AS json
FROM v"""


# ------------------------------------------------------------ expected files
def file_name_sql(d: str) -> str:
    return f"'sec_bhavdata_full_' || strftime({d}, '%d%m%Y') || '.csv'"


PREVIOUS_BUSINESS_DAY = """
SELECT d, CAST(d - CASE isodow(d) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END AS DATE) AS previous_business_day
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
"""


def missing_files_sql(as_of: str, days_back: int = 365) -> str:
    return f"""
WITH cal AS (
    SELECT i AS days_back, CAST(DATE '{as_of}' - CAST(i AS INTEGER) AS DATE) AS file_date FROM range({days_back}) t(i)
),
named AS (
    SELECT days_back, file_date, {file_name_sql('file_date')} AS filename,
           CAST(day(file_date) % 4 AS INTEGER) AS strikes
    FROM cal WHERE isodow(file_date) <= 5
),
landed AS (
    SELECT DISTINCT {file_name_sql('CAST(o_orderdate AS DATE)')} AS filename FROM orders WHERE o_orderstatus = 'P'
)
SELECT days_back, file_date, filename, strikes FROM named
WHERE strikes < 2 AND filename NOT IN (SELECT filename FROM landed)"""


ATTEMPTS = """
SELECT 'f' || CAST(user_id AS VARCHAR) AS feed, 'f' || CAST(user_id AS VARCHAR) AS filename, ts, event_id AS seq,
       CASE event_type WHEN 'error' THEN 404 WHEN 'purchase' THEN 200
            WHEN 'signup' THEN CASE event_id % 4 WHEN 0 THEN 500 WHEN 1 THEN -1 WHEN 2 THEN 0 END END AS status
FROM events
"""

STRIKE_COUNTS = f"""
WITH att AS ({ATTEMPTS})
SELECT a.filename, CAST(COUNT(*) AS INTEGER) AS strikes
FROM att a
WHERE a.status = 404 AND NOT EXISTS (
    SELECT 1 FROM att b
    WHERE b.filename = a.filename AND b.status = 200 AND (b.ts > a.ts OR (b.ts = a.ts AND b.seq > a.seq))
)
GROUP BY a.filename"""

# Strikes of an earlier run stay unless the log has a 200; new ones add up.
STRIKE_COUNTS_CARRIED = f"""
WITH att AS ({ATTEMPTS}),
fresh AS ({STRIKE_COUNTS.replace(f"WITH att AS ({ATTEMPTS})", "")}),
kept AS (
    SELECT 'f' || CAST(c_custkey AS VARCHAR) AS filename, CAST(c_custkey % 3 AS INTEGER) AS strikes FROM customer
    WHERE 'f' || CAST(c_custkey AS VARCHAR) NOT IN (SELECT filename FROM att WHERE status = 200)
)
SELECT filename, CAST(SUM(strikes) AS INTEGER) AS strikes FROM (FROM fresh UNION ALL FROM kept)
GROUP BY filename HAVING SUM(strikes) > 0"""


def fetch_window_sql(limit: int = 5) -> str:
    return f"""
WITH att AS ({ATTEMPTS}),
f AS (SELECT *, CASE WHEN status IN (200, 0) THEN 1 ELSE 0 END AS r,
             CASE WHEN status IS NOT NULL AND status NOT IN (200, 0) THEN 1 ELSE 0 END AS e FROM att),
g AS (SELECT *, SUM(r) OVER (PARTITION BY feed ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS island FROM f),
h AS (SELECT *, SUM(e) OVER (PARTITION BY feed, island ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS run_after FROM g),
k AS (SELECT *, COALESCE(LAG(run_after) OVER (PARTITION BY feed ORDER BY ts, seq), 0) AS run_before FROM h),
m AS (SELECT *, NOT BOOL_OR(run_before >= {limit}) OVER (PARTITION BY feed ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS made
      FROM k),
stops AS (SELECT feed, ts AS stop_ts, seq AS stop_seq
          FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY feed ORDER BY ts, seq) AS rn FROM m WHERE NOT made) WHERE rn = 1),
agg AS (SELECT feed, COUNT(CASE WHEN made THEN 1 END) AS rows_made,
               COALESCE(MAX(CASE WHEN made THEN run_after END), 0) >= {limit} AS reached_limit
        FROM m GROUP BY feed)
SELECT agg.feed, rows_made, reached_limit, stop_ts, stop_seq FROM agg LEFT JOIN stops USING (feed)"""


def fetch_state_sql(limit: int = 5) -> str:
    """What stays of each feed after the whole log: where it stopped, and its strikes."""
    return f"""
WITH win AS ({fetch_window_sql(limit)}), strikes AS ({STRIKE_COUNTS})
SELECT feed, rows_made, reached_limit, stop_ts, stop_seq, COALESCE(strikes, 0) AS strikes
FROM win LEFT JOIN strikes ON filename = feed"""


# ---------------------------------------------------------------- watchlist
CHANGES = """
SELECT ts, event_id AS seq,
       CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op,
       'U' || CAST(user_id AS VARCHAR) AS symbol,
       event_type AS note,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS file_name,
       CASE WHEN event_type = 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M') END AS reminder_time,
       CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS event_id
FROM events
"""

WATCHLIST_WITH = f"""
WITH ch AS ({CHANGES}),
cur AS (
    SELECT c_custkey + 1 AS id, 'U' || CAST(c_custkey AS VARCHAR) AS symbol, c_mktsegment AS note, CAST(NULL AS VARCHAR) AS file_name,
           CAST(NULL AS TIMESTAMP) AS reminder_time, c_custkey % 3 = 0 AS is_notified,
           CASE WHEN c_custkey % 5 = 0 THEN 'e' || CAST(c_custkey AS VARCHAR) END AS event_id
    FROM customer WHERE c_custkey % 2 = 0
),
o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY ts, seq) AS pos FROM ch
      WHERE symbol IS NOT NULL AND symbol <> ''),
ld AS (SELECT symbol, MAX(pos) AS del_pos FROM o WHERE op = 'delete' GROUP BY symbol),
af AS (SELECT o.* FROM o LEFT JOIN ld USING (symbol) WHERE o.op = 'upsert' AND o.pos > COALESCE(ld.del_pos, 0)),
fo AS (
    SELECT symbol,
           arg_max_null(note, pos) AS note,
           arg_max_null(file_name, pos) AS file_name,
           arg_max_null(reminder_time, pos) AS rt,
           arg_max(event_id, pos) FILTER (WHERE event_id IS NOT NULL) AS event_id,
           arg_min(ts, pos) AS first_ts,
           arg_min(seq, pos) AS first_seq
    FROM af GROUP BY symbol
),
norm AS (
    SELECT *, CASE WHEN rt IS NULL OR rt = '' THEN NULL
                   ELSE TRY_CAST(CASE WHEN length(replace(rt, 'T', ' ')) = 16 THEN replace(rt, 'T', ' ') || ':00' ELSE replace(rt, 'T', ' ') END AS TIMESTAMP)
              END AS reminder
    FROM fo
),
kept AS (SELECT * FROM cur WHERE symbol NOT IN (SELECT symbol FROM ld)),
wl AS (
    SELECT k.id, k.symbol, if(n.symbol IS NULL, k.note, n.note) AS note, if(n.symbol IS NULL, k.file_name, n.file_name) AS file_name,
           if(n.symbol IS NULL, k.reminder_time, n.reminder) AS reminder_time, k.is_notified, COALESCE(n.event_id, k.event_id) AS event_id
    FROM kept k LEFT JOIN norm n USING (symbol)
    UNION ALL
    SELECT (SELECT MAX(id) FROM cur) + ROW_NUMBER() OVER (ORDER BY first_ts, first_seq), symbol, note, file_name, reminder, FALSE, event_id
    FROM norm WHERE symbol NOT IN (SELECT symbol FROM kept)
)"""

WATCHLIST_APPLY = WATCHLIST_WITH + "\nSELECT * FROM wl"


def watchlist_view_sql(now: str) -> str:
    return WATCHLIST_WITH + f"""
SELECT id, symbol,
       CASE WHEN note IS NOT NULL AND trim(note) <> '' THEN note ELSE 'No descriptive note attached' END AS note_display,
       CASE WHEN file_name IS NOT NULL AND file_name <> '' THEN file_name ELSE ' ' END AS file_name_display,
       reminder_time,
       reminder_time + INTERVAL 30 MINUTE AS reminder_end,
       is_notified,
       CASE WHEN reminder_time IS NOT NULL
            THEN 'https://calendar.google.com/calendar/r/day/' || strftime(reminder_time, '%Y/%m/%d')
            ELSE 'https://calendar.google.com/calendar/r' END AS calendar_url,
       COALESCE(TIMESTAMP '{now}' > date_trunc('second', reminder_time), FALSE) AS is_expired,
       '{CHART_URL}' || symbol AS chart_url
FROM wl"""


# ------------------------------------------------------------------ widgets
WIDGET_ROWS = """
SELECT CAST(event_id AS DOUBLE) AS event_id, CAST(user_id AS DOUBLE) AS user_id,
       round_even(value * 10, 0) / 10 AS value
FROM events WHERE event_type = 'purchase'
"""

WIDGET_EXPORT = """
SELECT CAST(ts AS DATE) AS day, CAST(event_id AS DOUBLE) AS event_id, CAST(user_id AS DOUBLE) AS user_id,
       round_even(value * 10, 0) / 10 AS value
FROM events WHERE event_type = 'purchase'
"""
