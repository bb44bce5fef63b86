"""The serving table: append-only, month-partitioned, latest version per (entity, day) wins.

Loading a period twice leaves the same logical content: readers resolve versions with
``current`` (greatest ``loaded_at``), and ``compact`` rewrites months to their latest rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsmart.operators.normalize import fixed_width, packed_order
from obsmart.operators.versions import conform, latest
from obsmart.sinks.lake import append_months, rewrite_months
from obsmart.sinks.tables import create_bucketed, write_bucketed
from obsmart.sources.lake import read_days, read_months

VERSION_COLUMNS = ("loaded_at", "processed_at")


def load_range(spark: SparkSession, mart_path: str, serving_path: str, start, end, *,
               load_ts: datetime, entity: str = "city", day: str = "dt") -> int:
    """Mart ``[start, end]`` -> serving, as new versions stamped ``load_ts``. Returns the rows
    appended. One job for the whole period (month partitions are written in parallel)."""
    mart = read_days(spark, mart_path, start, end, day=day)
    rows = conform(mart, day=day, load_ts=load_ts)
    return append_months(rows, serving_path, sort_within=(entity, day))


def resolve(df: DataFrame, *, keys=("city", "dt"), version=VERSION_COLUMNS) -> DataFrame:
    """Latest version per key; the remaining columns break exact ties deterministically: by their
    hash where all columns have a fixed width and the version leaves room for it in one packed value
    (hash aggregate), else by their values."""
    version = [v for v in version if v in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in version]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    tie = F.xxhash64(*rest) if rest else F.lit(0).cast("long")
    if fixed_width(df, [*version, *rest]) and packed_order([*map(F.col, version), tie], [*[kinds[v] for v in version], T.LongType()]) is not None:
        return latest(df, keys, [*version, tie])
    return latest(df, keys, [*version, *rest])


def current(spark: SparkSession, serving_path: str, start=None, end=None, *,
            keys=("city", "dt"), day: str = "dt") -> DataFrame:
    """The serving table as of now: latest version per key, pruned to the months of the
    period. All versions of a key share a month partition."""
    return resolve(read_months(spark, serving_path, start, end, day=day), keys=keys)


def version_stats(rows: DataFrame, *, keys=("city", "dt"), month: str = "month") -> DataFrame:
    """Per month: rows, keys and superseded rows (all but one of every key). Two shrinking counts, of
    which the first combines map-side; only key columns are read."""
    per_key = rows.groupBy(month, *[k for k in keys if k != month]).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy(month).agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("keys"),
                                      F.sum(F.col("_n") - 1).alias("superseded"))


def compact(spark: SparkSession, serving_path: str, start, end, *, keys=("city", "dt"),
            day: str = "dt", month: str = "month", min_share: float = 0.0) -> int:
    """Rewrite months touching ``[start, end]`` to their latest versions: those in which more than
    ``min_share`` of the rows are superseded (by default: any row). Other months keep their files.
    Returns the rows written."""
    rows = read_months(spark, serving_path, None, None, day=day, month=month)
    lo, hi = int(f"{_d(start):%Y%m}"), int(f"{_d(end):%Y%m}")
    rows = rows.where(F.col(month).between(lo, hi))
    stats = version_stats(rows, keys=keys, month=month).where(F.col("superseded") > F.col("rows") * min_share)
    months = [r[0] for r in stats.select(month).collect()]                  # <= months of the period
    if not months:
        return 0
    return rewrite_months(resolve(rows.where(F.col(month).isin(months)), keys=keys), serving_path, month=month,
                          sort_within=tuple(keys), months=months)


def retire(spark: SparkSession, serving_path: str, start, end, gone, *, keys=("city", "dt"), day: str = "dt",
           month: str = "month") -> int:
    """Take rows out of the serving table: those of the days ``[start, end]`` that ``gone`` (a
    condition) holds for, in all their versions. Their months are rewritten to the latest versions of
    what stays; a month that has no rows left is dropped. Returns the rows that stay in these months."""
    from obsmart.operators.calendar import check_period

    s, e = check_period(start, end)
    lo, hi = int(f"{s:%Y%m}"), int(f"{e:%Y%m}")
    rows = read_months(spark, serving_path, None, None, day=day, month=month).where(F.col(month).between(lo, hi))
    there = [r[0] for r in rows.select(month).distinct().collect()]         # <= months of the period
    stay = rows.where(~(F.col(day).between(F.lit(s), F.lit(e)) & F.coalesce(gone, F.lit(False))))
    return rewrite_months(resolve(stay, keys=keys), serving_path, month=month, sort_within=tuple(keys), months=there)


def _d(value):
    from obsmart.operators.calendar import as_day

    return as_day(value)


# --------------------------------------------------------------------------------------------
# Bucketed serving table (catalog table): versions of a key share a bucket, so resolving the
# latest version needs no shuffle.
# --------------------------------------------------------------------------------------------

def create_table(spark: SparkSession, name: str, path: str, schema, *, entity: str = "city",
                 day: str = "dt", month: str = "month", buckets: int = 64) -> None:
    """Register the serving table at ``path``: month partitions, bucketed by ``entity`` and
    sorted by (entity, day) within buckets. Idempotent (existing files are kept)."""
    create_bucketed(spark, name, path, schema, partition=month, bucket=entity, sort=(entity, day),
                    buckets=buckets, partition_type="int")


def load_table(spark: SparkSession, mart_path: str, name: str, start, end, *,
               load_ts: datetime, day: str = "dt", count_col: str = "hours_count") -> int:
    """Mart ``[start, end]`` -> new versions in the bucketed table. Returns rows appended."""
    rows = conform(read_days(spark, mart_path, start, end, day=day), day=day,
                   count_col=count_col, load_ts=load_ts)
    return write_bucketed(rows, name)


def current_table(spark: SparkSession, name: str, start=None, end=None, *,
                  keys=("city", "dt"), day: str = "dt", month: str = "month") -> DataFrame:
    """Latest version per key from the bucketed table; the aggregate runs per bucket."""
    df = spark.table(name)
    if start is not None or end is not None:
        s, e = _d(start), _d(end)
        df = df.where(F.col(month).between(s.year * 100 + s.month, e.year * 100 + e.month)
                      & F.col(day).between(F.lit(s), F.lit(e)))
    return resolve(df, keys=keys)


def compact_table(spark: SparkSession, name: str, start, end, *, keys=("city", "dt"),
                  month: str = "month") -> int:
    """Rewrite the months touching ``[start, end]`` of the bucketed table to latest rows."""
    from obsmart.session import cut_lineage

    lo, hi = int(f"{_d(start):%Y%m}"), int(f"{_d(end):%Y%m}")
    df = resolve(spark.table(name).where(F.col(month).between(lo, hi)), keys=keys)
    return write_bucketed(cut_lineage(df, required=True), name, overwrite=True)


def register_view(spark: SparkSession, serving_path: str, name: str = "daily_city", *,
                  keys=("city", "dt"), start=None, end=None) -> DataFrame:
    """Expose the latest versions as a temporary view, so reports can also be written in
    ``spark.sql`` (the view plays the role of the versioned table read with FINAL)."""
    df = current(spark, serving_path, start, end, keys=keys)
    df.createOrReplaceTempView(name)
    return df


def snapshot(spark: SparkSession, serving_path: str, start=None, end=None, *,
             keys=("city", "dt"), day: str = "dt") -> DataFrame:
    """The latest versions, resolved once and kept in the shared checkpoint folder, for
    running several reports: each report then reads the snapshot instead of resolving the
    versions (a shuffle of the served period) again."""
    from obsmart.session import cut_lineage

    return cut_lineage(current(spark, serving_path, start, end, keys=keys, day=day))
