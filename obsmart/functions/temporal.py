"""Time column functions. Days are UTC calendar days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# day, then optionally a clock of minutes, seconds or fractions, then optionally a zone
_ISO = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(:\d{2}(?:\.\d+)?)? ?(Z|[+-]\d{2}(?::?\d{2})?)?)?$"


def to_utc(c, strict: bool = False) -> Column:
    """ISO text -> instant (TIMESTAMP): ``YYYY-MM-DD[THH:MM[:SS[.f]][Z|+HH|+HHMM|+HH:MM]]``.

    Text without a zone is read as UTC, whatever the session's time zone; a day without a clock
    is its midnight. Junk gives NULL (``strict=True``: the job fails instead).
    """
    s = F.trim(_col(c).cast("string"))
    # the plain form YYYY-MM-DDTHH:MM needs no pattern: its signs stand where they must, and the cast
    # itself refuses anything but digits between them
    sign = {5: "-", 8: "-", 14: ":"}
    plain = F.length(s) == 16
    for at, mark in sign.items():
        plain = plain & (F.substring(s, at, 1) == mark)
    plain = plain & F.substring(s, 11, 1).isin("T", " ")
    quick = F.concat(s, F.lit(":00Z")).try_cast("timestamp")

    def part(n: int, otherwise: str) -> Column:
        found = F.regexp_extract(s, _ISO, n)
        return F.when(found == "", F.lit(otherwise)).otherwise(found)

    zone = F.regexp_replace(part(4, "Z"), r"^([+-]\d{2}):?(\d{2})?$", "$1:$2")
    zone = F.when(zone.endswith(":"), F.concat(zone, F.lit("00"))).otherwise(zone)
    text = F.concat(F.regexp_extract(s, _ISO, 1), F.lit("T"), part(2, "00:00"), part(3, ":00"), zone)
    if strict:
        junk = F.raise_error(F.concat(F.lit("no ISO time: "), s)).cast("timestamp")
        return F.when(plain & quick.isNotNull(), quick).when(s.rlike(_ISO), text.cast("timestamp")).when(s.isNotNull(), junk)
    return F.when(plain, quick).when(s.rlike(_ISO), text.try_cast("timestamp"))


def utc_day(c, dtype: T.DataType | None = None) -> Column:
    """UTC calendar day of a timestamp, whatever the session time zone.

    For TIMESTAMP (an instant) the day is derived from epoch microseconds; for TIMESTAMP_NTZ
    (a wall clock already in UTC) and DATE it is a plain ``to_date``.
    """
    c = _col(c)
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return F.to_date(c)
    return F.date_from_unix_date(F.floor(F.unix_micros(c) / F.lit(86_400_000_000)).cast("int"))


def unix_day(c) -> Column:
    """Days since 1970-01-01 (the order key of calendar range windows)."""
    return F.unix_date(_col(c))


def month_start(c) -> Column:
    """First day of the month."""
    return F.trunc(_col(c), "MM")


def year_month(c) -> Column:
    """YYYYMM as INT (month partition key of the serving table)."""
    c = _col(c)
    return (F.year(c) * 100 + F.month(c)).cast("int")
