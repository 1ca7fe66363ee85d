from tidemark.functions.scalars import (
    NO,
    YES,
    as_of_date,
    daily_file_name,
    exact_decimal_mean,
    file_date_from_name,
    flag,
    last_complete_week_end,
    previous_business_day,
    round_half_away,
    round_half_even,
    strip_upper,
    strip_ws,
    week_start,
)

__all__ = [
    "NO",
    "YES",
    "as_of_date",
    "daily_file_name",
    "exact_decimal_mean",
    "file_date_from_name",
    "flag",
    "last_complete_week_end",
    "previous_business_day",
    "round_half_away",
    "round_half_even",
    "strip_upper",
    "strip_ws",
    "week_start",
]
