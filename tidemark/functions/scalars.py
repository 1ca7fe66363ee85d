"""Column expressions shared by the operators.

Everything here is built from ``pyspark.sql.functions`` so it compiles into
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# The labels the weekly checks emit, and the prefix of the
# daily price file names.
YES = "✅ YES"
NO = "❌ NO"
FILE_PREFIX = "sec_bhavdata_full_"

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_of_date(as_of=None) -> Column:
    """The run date as a DATE column.  ``None`` means today; operators that are
    compared with an oracle always pass an explicit date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def week_start(d) -> Column:
    """Monday of the ISO week containing ``d`` (as DATE)."""
    return F.trunc(_c(d), "week")


def round_half_away(x, digits: int = 0) -> Column:
    """ROUND on DOUBLE the way the reference's engine does it: scale by
    10^digits, round half away from zero, scale back.  Spark's own
    ``round(x, 2)`` rounds the decimal text of ``x`` instead, which differs on
    values such as 1.005."""
    x = _c(x)
    if digits == 0:
        return F.round(x, 0)
    m = float(10**digits)
    return F.round(x * F.lit(m), 0) / F.lit(m)


def round_half_even(x, digits: int = 1) -> Column:
    """numpy's ``round``: scale, round half to even (``rint``), scale back."""
    m = float(10**digits)
    return F.rint(_c(x).cast("double") * F.lit(m)) / F.lit(m)


def exact_decimal_mean(price, window: Window, scale: int = 2) -> Column:
    """Mean of a DECIMAL(p, scale) column over a window as DOUBLE, summed
    exactly on the unscaled integers and divided once -- the same value an
    engine with an exact 128-bit decimal sum produces."""
    p = _c(price)
    unscaled = (p * F.lit(10**scale)).cast("bigint")
    total = F.sum(unscaled).over(window)
    n = F.count(p).over(window)
    return F.when(n > 0, total / (n.cast("double") * F.lit(float(10**scale))))


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN YES ELSE NO (NULL counts as NO)."""
    return F.when(cond, F.lit(YES)).otherwise(F.lit(NO))


# The characters Python's ``str.strip()`` removes, derived from Python's own
# definition rather than listed by hand.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip_ws(x) -> Column:
    """``str.strip()``: remove any whitespace (not only spaces) at both ends.
    Plain ``trim`` removes spaces only; ``btrim`` with Python's whitespace set
    is code-generated (no regex per value)."""
    return F.btrim(_c(x), F.lit(PY_WHITESPACE))


def strip_upper(x) -> Column:
    """``str.strip().upper()``."""
    return F.upper(strip_ws(x))


def file_date_from_name(name) -> Column:
    """Date in a file name ``<prefix>_<ddMMyyyy>.csv``: the text after the last
    underscore with ``.csv`` removed, parsed as ddMMyyyy; NULL when it does
    not parse."""
    part = F.replace(F.element_at(F.split(_c(name), "_"), -1), F.lit(".csv"), F.lit(""))
    return F.try_to_timestamp(part, F.lit("ddMMyyyy")).cast("date")


def previous_business_day(d) -> Column:
    """Monday -> Friday before, Sunday -> Friday, any other day -> day before
    (so Saturday also gives Friday)."""
    d = _c(d)
    wd = F.weekday(d)  # Monday = 0
    back = F.when(wd == 0, 3).when(wd == 6, 2).otherwise(1)
    return F.date_sub(d, back)


def daily_file_name(d) -> Column:
    """``sec_bhavdata_full_<ddMMyyyy>.csv`` for date ``d``."""
    return F.concat(F.lit(FILE_PREFIX), F.date_format(_c(d), "ddMMyyyy"), F.lit(".csv"))


def last_complete_week_end(as_of) -> _dt.date:
    """The Sunday before the week of ``as_of``.  Passing it as the run date
    keeps complete weeks only (what the reference's comment intended; its
    code keeps the current week)."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    return as_of - _dt.timedelta(days=as_of.weekday() + 1)
