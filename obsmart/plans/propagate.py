"""Re-runs that rebuild only what a change reaches.

A corrected day changes its own mart row and the norms of the ``NORM_WINDOW_DAYS`` days after it, of
the entities that really changed. The daily rows (unrounded, one per entity and day) are kept as a
layer of their own, ``Layers.daily``. A re-run rolls up its period's hours, compares the new daily
rows with the stored ones by row hash, and rebuilds the mart rows that have a changed day in reach,
reading history from the daily layer (1/24 of the staging). Day partitions that nothing reaches keep
their files; of the others, rows that nothing reaches are carried over as they are.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.operators.calendar import check_period
from obsmart.operators.versions import conform
from obsmart.plans.mart import mart_of_daily, rollup
from obsmart.schemas import NORM_WINDOW_DAYS, WEATHER, WEATHER_DAILY, DailySpec, Roles
from obsmart.session import cut_lineage
from obsmart.sinks.folders import drop_partitions, is_empty
from obsmart.sinks.lake import append_months, overwrite_days
from obsmart.sources.lake import read_days

REACH = "_changed_days"


def row_hash(columns) -> Column:
    """128 bits of the columns' values, as two numbers. Which columns are NULL is hashed as well (a
    hash of several columns passes over NULLs)."""
    values = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.struct(F.xxhash64(F.lit(1), *values).alias("a"), F.xxhash64(F.lit(2), *values).alias("b"))


def changed_days(old: DataFrame, new: DataFrame, *, entity: str = "city", day: str = "dt") -> DataFrame:
    """(entity, day) of the rows that differ between ``old`` and ``new``, appeared or vanished. Both
    have one row per entity and day; only keys and hashes are shuffled."""
    columns = [c for c in new.columns if c not in (entity, day)]
    before = old.select(entity, day, row_hash(columns).alias("_before"))
    after = new.select(entity, day, row_hash(columns).alias("_after"))
    return before.join(after, [entity, day], "full").where(~F.col("_before").eqNullSafe(F.col("_after"))).select(entity, day)


def reached(rows: DataFrame, changed: DataFrame, *, entity: str = "city", day: str = "dt",
            window: int = NORM_WINDOW_DAYS) -> tuple[DataFrame, Column]:
    """``rows`` with the changed days of their entity, and the condition that one of them is the row's
    day or at most ``window`` days before it (NULL where the entity did not change)."""
    of = (changed.groupBy(F.col(entity).alias("_who")).agg(F.collect_set(day).alias(REACH)))     # <= days of the period
    joined = rows.join(of, rows[entity] == of["_who"], "left").drop("_who")
    return joined, F.exists(REACH, lambda c: F.col(day).between(c, F.date_add(c, window)))


def rebuilt_rows(daily: DataFrame, changed: DataFrame, *, start=None, end=None, roles: Roles = WEATHER,
                 spec: DailySpec = WEATHER_DAILY, window: int = NORM_WINDOW_DAYS, **how) -> DataFrame:
    """The mart rows that a change reaches, from daily rows that reach ``window`` days back. Entities
    that did not change are left out before the norm is computed."""
    rows, hit = reached(daily, changed, entity=roles.entity, day=roles.day, window=window)
    return mart_of_daily(rows.where(F.col(REACH).isNotNull()), start=start, end=end, roles=roles, spec=spec,
                         window=window, where=hit, **how).drop(REACH)


def aggregate_changed(spark: SparkSession, layers, hourly: DataFrame, start, end, *, roles: Roles = WEATHER,
                      spec: DailySpec = WEATHER_DAILY, window: int = NORM_WINDOW_DAYS, processed_at=True, **how) -> dict:
    """staging rows of ``[start, end]`` -> daily layer and mart. Returns the numbers of changed
    entity-days, rebuilt mart rows, carried rows and rewritten day partitions."""
    start, end = check_period(start, end)
    entity, day = roles.entity, roles.day
    scales = {k: how[k] for k in ("scale", "exact_scale") if k in how}
    new = cut_lineage(rollup(hourly.where(F.col(day).between(F.lit(start), F.lit(end))), roles=roles, spec=spec, **scales), required=True)
    old = new.limit(0) if is_empty(spark, layers.daily) else read_days(spark, layers.daily, start, end, day=day)
    changed = cut_lineage(changed_days(old.select(*new.columns), new, entity=entity, day=day), required=True)
    done = {"changed": changed.count(), "rebuilt": 0, "carried": 0, "days": 0}
    if not done["changed"]:
        return done
    touched = [r[0] for r in changed.select(day).distinct().collect()]              # <= days of the period
    left = {r[0] for r in new.select(day).distinct().collect()}
    overwrite_days(new.where(F.col(day).isin(touched)), layers.daily, day=day, sort_within=(entity,))
    drop_partitions(spark, layers.daily, day, [d for d in touched if d not in left])

    last = end + timedelta(days=window)
    history = read_days(spark, layers.daily, start, last, lookback=window, day=day).select(*new.columns)
    rebuilt = cut_lineage(rebuilt_rows(history, changed, start=start, end=last, roles=roles, spec=spec, window=window,
                                       processed_at=processed_at, **how), required=True)
    done["rebuilt"] = rebuilt.count()
    days = sorted({r[0] for r in rebuilt.select(day).distinct().collect()} | set(touched))     # <= period + window
    out = rebuilt
    if not is_empty(spark, layers.mart):
        mart, hit = reached(read_days(spark, layers.mart, start, last, day=day).where(F.col(day).isin(days)), changed,
                            entity=entity, day=day, window=window)
        carried = cut_lineage(mart.where(~F.coalesce(hit, F.lit(False))).select(*rebuilt.columns), required=True)
        done["carried"], out = carried.count(), rebuilt.unionByName(carried)
    overwrite_days(out, layers.mart, day=day, sort_within=(entity,))
    filled = {r[0] for r in out.select(day).distinct().collect()}
    drop_partitions(spark, layers.mart, day, [d for d in days if d not in filled])
    return done | {"days": len(days)}


def load_changed(spark: SparkSession, mart_path: str, served: DataFrame | None, serving_path: str, start, end, *,
                 load_ts, entity: str = "city", day: str = "dt", ignore=("processed_at",)) -> int:
    """Append to serving only the mart rows of ``[start, end]`` that differ from ``served`` (the latest
    versions, or None) in a column besides ``ignore``. Returns the rows appended."""
    rows = conform(read_days(spark, mart_path, start, end, day=day), day=day, load_ts=load_ts)
    if served is not None:
        content = [c for c in rows.columns if c not in (entity, day, "loaded_at", *ignore)]
        same = served.select(F.col(entity).alias("_e"), F.col(day).alias("_d"), row_hash(content).alias("_h"))
        rows = rows.join(same, (rows[entity] == same["_e"]) & (rows[day] == same["_d"]) & (row_hash(content) == same["_h"]), "left_anti")
    return append_months(rows, serving_path, sort_within=(entity, day))
