"""Trailing calendar norm and anomaly."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsmart.schemas import NORM_MIN_DAYS, NORM_WINDOW_DAYS


def trailing_window(entity, day: str, days: int = NORM_WINDOW_DAYS):
    """The previous ``days`` calendar days of the same entity, today excluded. A range frame
    on the day number: gaps in the data do not stretch the window."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*keys).orderBy(F.unix_date(F.col(day))).rangeBetween(-days, -1)


def trailing_norm(daily: DataFrame, *, entity, day: str = "dt", value: str = "temp_avg",
                  norm: str = "temp_norm_30d", anomaly: str | None = "temp_anomaly",
                  window: int = NORM_WINDOW_DAYS, min_periods: int = NORM_MIN_DAYS) -> DataFrame:
    """Add ``norm`` = average of ``value`` over the trailing window, only when at least
    ``min_periods`` days in it have a value (else NULL), and ``anomaly`` = value - norm.

    Both window aggregates sit in one projection, so Spark plans a single Window operator
    over one shuffle by entity. The input is the daily table (one row per entity and day), so
    a window partition holds at most one row per calendar day of one entity.
    """
    w = trailing_window(entity, day, window)
    with_norm = daily.select(
        "*",
        F.when(F.count(F.col(value)).over(w) >= min_periods, F.avg(F.col(value)).over(w)).alias(norm),
    )
    if anomaly:
        with_norm = with_anomaly(with_norm, value=value, norm=norm, out=anomaly)
    return with_norm


def with_anomaly(daily: DataFrame, *, value: str = "temp_avg", norm: str = "temp_norm_30d",
                 out: str = "temp_anomaly") -> DataFrame:
    """``out`` = value - norm (NULL when the norm is NULL)."""
    return daily.withColumn(out, F.col(value) - F.col(norm))
