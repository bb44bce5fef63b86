"""The daily mart: hourly staging -> daily rollup -> trailing norm and anomaly -> rounded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmart.operators.calendar import check_period
from obsmart.operators.normalize import assign_day
from obsmart.operators.norms import trailing_norm
from obsmart.operators.rollup import daily, round_metrics
from obsmart.schemas import NORM_MIN_DAYS, NORM_WINDOW_DAYS, WEATHER, WEATHER_DAILY, DailySpec, Roles


def build_mart(hourly: DataFrame, *, start=None, end=None, roles: Roles = WEATHER,
               spec: DailySpec = WEATHER_DAILY, window: int = NORM_WINDOW_DAYS,
               min_periods: int = NORM_MIN_DAYS, scale: int | None = 2,
               exact_scale: int | None = None, processed_at=True) -> DataFrame:
    """One row per entity and day of ``[start, end]``.

    ``hourly`` should hold ``window`` days before ``start`` as history for the norm (see
    ``sources.lake.read_days(lookback=...)``). The norm and the anomaly are computed on the
    unrounded daily value; all metrics are rounded (HALF_UP, ``scale``) at the end.
    ``processed_at``: True = ``current_timestamp()``, a datetime = that value, None = left out.
    ``exact_scale``: the inputs have at most that many decimals; sums and averages are then
    exact (integer accumulation) and averages are rounded exactly.

    Plan: partial aggregate -> shuffle on (day, entity) -> final aggregate -> shuffle on
    entity (daily rows only, ~1/24 of the hourly input) -> one Window -> period filter. On a
    staging table bucketed by the entity both shuffles disappear.
    """
    d = rollup(hourly, roles=roles, spec=spec, scale=scale, exact_scale=exact_scale)
    return mart_of_daily(d, start=start, end=end, roles=roles, spec=spec, window=window,
                         min_periods=min_periods, scale=scale, exact_scale=exact_scale,
                         processed_at=processed_at)


def rollup(hourly: DataFrame, *, roles: Roles = WEATHER, spec: DailySpec = WEATHER_DAILY,
           scale: int | None = 2, exact_scale: int | None = None) -> DataFrame:
    """The unrounded daily rows (with the state of exact averages) that the norm is computed on."""
    if roles.day not in hourly.columns:
        hourly = assign_day(hourly, roles.ts, roles.day)
    return daily(hourly, entity=roles.entity, day=roles.day, attrs=roles.attrs, aggs=spec.aggs,
                 count_col=spec.count_col, exact_scale=exact_scale,
                 keep_state=exact_scale is not None and scale is not None)


def mart_of_daily(d: DataFrame, *, start=None, end=None, roles: Roles = WEATHER,
                  spec: DailySpec = WEATHER_DAILY, window: int = NORM_WINDOW_DAYS,
                  min_periods: int = NORM_MIN_DAYS, scale: int | None = 2,
                  exact_scale: int | None = None, processed_at=True, where=None) -> DataFrame:
    """Daily rows -> mart rows of ``[start, end]`` (and of the condition ``where``): trailing norm and
    anomaly on the unrounded values, then the period, then rounding."""
    out = trailing_norm(d, entity=roles.entity, day=roles.day, value=spec.value, norm=spec.norm,
                        anomaly=spec.anomaly, window=window, min_periods=min_periods)
    if start is not None or end is not None:
        s, e = check_period(start, end)
        out = out.where(F.col(roles.day).between(F.lit(s), F.lit(e)))
    if where is not None:
        out = out.where(where)
    if scale is not None:
        out = round_metrics(out, [*spec.outputs, spec.norm, spec.anomaly], scale,
                            exact_scale=exact_scale)
    if processed_at is True:
        out = out.withColumn("processed_at", F.current_timestamp())
    elif processed_at is not None:
        out = out.withColumn("processed_at", F.lit(processed_at).cast("timestamp"))
    return out
