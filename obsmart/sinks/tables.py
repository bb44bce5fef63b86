"""Bucketed catalog tables: co-located layers whose readers need no shuffle.

A layer registered as a table partitioned by a time column and bucketed by the entity keeps
all rows of an entity in one bucket file per partition. Spark's bucketed scan then reports
that partitioning, so a later aggregate or window keyed by the entity (the daily rollup,
the trailing norm, the quality profile, the latest-version read) runs without an exchange.
Trade-off: a bucketed scan runs at most one task per bucket, so pick the bucket count from
the layer's size and use it for layers with many entities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obsmart.operators.calendar import day_list
from obsmart.sinks.folders import drop_partitions


def create_bucketed(spark: SparkSession, name: str, path: str, schema, *, partition: str,
                    bucket: str, sort=(), buckets: int = 64,
                    partition_type: str | None = None) -> None:
    """Register ``name`` at ``path`` (Parquet), partitioned by ``partition`` and bucketed by
    ``bucket`` into ``buckets``, sorted by ``sort`` within buckets. Idempotent."""
    fields = [f for f in schema.fields if f.name != partition]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    ptype = partition_type or schema[partition].dataType.simpleString()
    sorted_by = f"SORTED BY ({', '.join(f'`{c}`' for c in sort)}) " if sort else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}, `{partition}` {ptype}) USING parquet "
        f"PARTITIONED BY (`{partition}`) CLUSTERED BY (`{bucket}`) {sorted_by}"
        f"INTO {buckets} BUCKETS LOCATION '{path}'")


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """Bucket count and bucket columns of a catalog table (from its description)."""
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    cols = [c.strip(" `[]") for c in info.get("Bucket Columns", "").split(",") if c.strip(" `[]")]
    return int(info.get("Num Buckets", "0") or 0), cols


def by_bucket(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Cluster rows by the table's bucket id (same hash and modulus as the table's bucketing),
    so each task writes one file per bucket and partition instead of one per bucket per task."""
    n, cols = bucketing(spark, name)
    return df.repartition(n, *cols) if n and cols else df


def write_bucketed(df: DataFrame, name: str, *, overwrite: bool = False, period=None,
                   partition: str = "dt") -> int:
    """Append to ``name`` or, with ``overwrite``, replace the partitions present in ``df``
    (dynamic overwrite). Columns are matched by name. Returns rows written. ``period``: the days that
    ``df`` stands for; those without rows are removed (see :func:`drop_days`) unless all are."""
    spark = df.sparkSession
    out = by_bucket(spark, name, df.select(*spark.table(name).columns))
    obs = Observation(f"write_{name}")
    days = [F.collect_set(partition).alias("days")] if period else []
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), *days)
    writer = out.write
    if overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.insertInto(name, overwrite=overwrite)
    n = int(obs.get["rows"])
    if period and n:
        drop_days(spark, name, partition, sorted(set(day_list(*period)) - set(obs.get["days"])))
    return n


def drop_days(spark: SparkSession, name: str, partition: str, days) -> list[str]:
    """Remove the partitions of ``days`` from a catalog table, in one statement, and their folders
    (an external table keeps them otherwise). Returns the folders that were there."""
    if not days:
        return []
    parts = ", ".join(f"PARTITION (`{partition}`='{d}')" for d in days)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return drop_partitions(spark, info["Location"], partition, days)
