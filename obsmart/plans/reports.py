"""End-user reports over the daily table (pass the latest-version view of the serving table).

Each report is a plain DataFrame function; entity, name, day and metric columns are
parameters. With ``exact_scale`` (the mart stores values rounded to that many decimals),
sums and averages accumulate exact integers, so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsmart.functions.numeric import (
    div_half_up, exact_avg_rounded, exact_stddev, round_to, rounded_units, scaled_sum,
)
from obsmart.functions.temporal import month_start
from obsmart.operators.rollup import aggregate
from obsmart.schemas import ANOMALY_LABELS
from obsmart.sources.lake import partition_inventory  # noqa: F401  (R2, listed with the reports)


def overview(daily: DataFrame, *, entity: str = "city", day: str = "dt",
             entities_as: str = "entities") -> DataFrame:
    """rows, entities (named ``entities_as``, e.g. ``cities``), first_day, last_day."""
    return daily.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(entity).alias(entities_as),
                     F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def climate(daily: DataFrame, *, group=("city_name", "country"), day: str = "dt",
            value: str = "temp_avg", low: str = "temp_min", high: str = "temp_max",
            wet: str = "precip_sum", wet_threshold: float = 1.0,
            exact_scale: int | None = None, mode: str = "half_up") -> DataFrame:
    """Per group: avg_temp (1 decimal), abs_min, abs_max, coldest_day, hottest_day (earliest
    day on ties; days without a value ignored), precip_per_year_mm (sum per 365.25 days of
    data, 0 decimals), rainy_days (wet >= threshold). Ordered by avg_temp descending."""
    d = F.col(day)
    lo, hi = F.col(low), F.col(high)
    n_days = F.count_distinct(d)
    if exact_scale is not None and mode == "half_up":
        avg_temp = exact_avg_rounded(value, exact_scale, 1)
        # sum / (days / 365.25) rounded to 0 decimals, as one exact integer division
        per_year = div_half_up(scaled_sum(wet, exact_scale).cast("decimal(38,0)") * F.lit(36525),
                               n_days * F.lit(10 ** (exact_scale + 2))).cast("double")
    else:
        avg_temp = round_to(F.avg(value), 1, mode)
        per_year = round_to(F.try_divide(F.sum(wet), n_days.cast("double") / F.lit(365.25)), 0, mode)
    return (daily.groupBy(*group).agg(
        avg_temp.alias("avg_temp"),
        F.min(lo).alias("abs_min"),
        F.max(hi).alias("abs_max"),
        F.min_by(d, F.when(lo.isNotNull(), F.struct(lo, d))).alias("coldest_day"),
        F.max_by(d, F.when(hi.isNotNull(), F.struct(hi, -F.unix_date(d)))).alias("hottest_day"),
        per_year.alias("precip_per_year_mm"),
        F.count_if(F.col(wet) >= wet_threshold).alias("rainy_days"),
    ).orderBy(F.col("avg_temp").desc_nulls_last(), *group))


def monthly_pivot(daily: DataFrame, *, entities: dict[str, str], entity: str = "city",
                  day: str = "dt", value: str = "temp_avg", scale: int = 1,
                  exact_scale: int | None = None, mode: str = "half_up") -> DataFrame:
    """Month x listed entities: the monthly average of ``value`` per entity, one column each.
    ``entities`` maps entity value -> output column (always listed: no discovery pass). Every
    month with data is a row; a listed entity without data in it gives NULL."""
    e, v = F.col(entity), F.col(value)

    def monthly_avg(x):
        if exact_scale is not None and mode == "half_up":
            return exact_avg_rounded(x, exact_scale, scale)
        return round_to(aggregate("avg", x, exact_scale), scale, mode)

    cols = [monthly_avg(F.when(e == F.lit(key), v)).alias(alias) for key, alias in entities.items()]
    return daily.groupBy(month_start(day).alias("month")).agg(*cols).orderBy("month")


def year_over_year(daily: DataFrame, *, entity_value, entity: str = "city", day: str = "dt",
                   value: str = "temp_avg", scale: int = 1, exact_scale: int | None = None,
                   mode: str = "half_up") -> DataFrame:
    """One entity: month_num, year, avg_temp (rounded) and diff_vs_prev_year = avg_temp minus
    the rounded average of the same month in the previous available year (NULL for the
    first). The window runs over the aggregated months (at most 12 partitions)."""
    one = daily.where(F.col(entity) == F.lit(entity_value))
    keys = [F.month(day).alias("month_num"), F.year(day).alias("year")]
    w = Window.partitionBy("month_num").orderBy("year")
    if exact_scale is not None and mode == "half_up":
        # averages in integer units of 10^-scale: the difference is exact as well
        units = rounded_units(scaled_sum(value, exact_scale), F.count(F.col(value)), exact_scale, scale)
        monthly = one.groupBy(*keys).agg(units.alias("_u"))
        unit = F.lit(float(10 ** scale))
        return (monthly.select("month_num", "year", (F.col("_u").cast("double") / unit).alias("avg_temp"),
                               ((F.col("_u") - F.lag("_u", 1).over(w)).cast("double") / unit)
                               .alias("diff_vs_prev_year"))
                .orderBy("month_num", "year"))
    monthly = one.groupBy(*keys).agg(round_to(F.avg(value), scale, mode).alias("avg_temp"))
    prev = F.lag("avg_temp", 1).over(w)
    return (monthly.withColumn("diff_vs_prev_year", round_to(F.col("avg_temp") - prev, scale, mode))
            .orderBy("month_num", "year"))


def top_anomalies(daily: DataFrame, *, n: int = 15, entity: str = "city", name: str = "city_name",
                  day: str = "dt", value: str = "temp_avg", norm: str = "temp_norm_30d",
                  anomaly: str = "temp_anomaly", labels: tuple[str, str] = ANOMALY_LABELS) -> DataFrame:
    """The ``n`` largest absolute anomalies (warm and cold); ties broken by day, entity.
    ``kind`` = labels[0] when the anomaly is > 0, else labels[1]. Planned as a top-k
    (per-partition heaps, no global sort)."""
    a = F.col(anomaly)
    kind = F.when(a > 0, F.lit(labels[0])).otherwise(F.lit(labels[1]))
    cols = [day, name, value, norm, anomaly]
    return (daily.where(a.isNotNull())
            .orderBy(F.abs(a).desc(), F.col(day).asc(), F.col(entity).asc())
            .limit(n)
            .select(*dict.fromkeys(cols), kind.alias("kind")))


def anomaly_counts(daily: DataFrame, *, years=(2024, 2025), threshold: float = 5.0,
                   name: str = "city_name", day: str = "dt", anomaly: str = "temp_anomaly",
                   digits: int = 2, mode: str = "half_up", exact_scale: int | None = None) -> DataFrame:
    """Per name: days with |anomaly| > threshold in each listed year (``y<year>``), in total,
    and the population standard deviation of the anomaly (with ``exact_scale`` from exact sums, the
    same on every partitioning). Ordered by total descending."""
    a = F.col(anomaly)
    big = F.abs(a) > F.lit(threshold)
    cols = [F.count_if(big & (F.year(day) == F.lit(y))).alias(f"y{y}") for y in years]
    cols += [F.count_if(big).alias("total"),
             round_to(F.stddev_pop(a) if exact_scale is None else exact_stddev(a, exact_scale), digits, mode).alias("anomaly_stddev")]
    return daily.groupBy(name).agg(*cols).orderBy(F.col("total").desc(), name)
