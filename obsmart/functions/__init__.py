"""Column functions (JVM-side expressions only; no Python UDFs)."""

from obsmart.functions.numeric import (
    clip, div_half_up, exact_avg, exact_avg_rounded, exact_sum, nan_to_null, round_to,
    rounded_ratio, scaled_sum, to_number,
)
from obsmart.functions.temporal import (
    month_start, to_utc, unix_day, utc_day, year_month,
)
from obsmart.functions.text import join_values, readable_size

__all__ = [
    "clip", "div_half_up", "exact_avg", "exact_avg_rounded", "exact_sum", "nan_to_null",
    "round_to", "rounded_ratio", "scaled_sum", "to_number",
    "month_start", "to_utc", "unix_day", "utc_day", "year_month",
    "join_values", "readable_size",
]
