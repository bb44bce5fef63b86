"""Exact distinct counts from stored bitmaps.

A state is one row per (period, bucket of 32,768 numbers) with a bitmap of the numbers seen: a bit for
each. States of months are kept; a re-run replaces those of its months only, and the distinct count of
any longer period comes from merging them, without reading the rows again. Building and merging are
plain aggregates that combine before the shuffle; several counted columns are several states, so no
row is multiplied as by several ``count_distinct``.

Counted are integer numbers (keys, or days by ``unix_date``), zero and negative ones as well; NULL is
not counted. A period whose values are all NULL has a state without a bit, so it keeps its count of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_states(rows: DataFrame, period: Column, number: Column, *, period_as: str = "period") -> DataFrame:
    """period, bucket, bits: the numbers of each period. An empty table has no states."""
    n = F.col("__n")
    kept = rows.select(period.alias(period_as), number.cast("long").alias("__n"))
    place = F.when(n.isNotNull(), F.bitmap_bit_position(n))
    return (kept.groupBy(period_as, F.coalesce(F.bitmap_bucket_number(n), F.lit(0)).alias("bucket"))
            .agg(F.bitmap_construct_agg(place).alias("bits")))


def merged_states(states: DataFrame, period: Column, *, period_as: str = "period") -> DataFrame:
    """The states with their periods replaced by longer ones (for example a month by its year)."""
    return (states.select(period.alias("__period"), "bucket", "bits").groupBy("__period", "bucket")
            .agg(F.bitmap_or_agg("bits").alias("bits")).withColumnRenamed("__period", period_as))


def replaced_states(states: DataFrame, fresh: DataFrame, touched: DataFrame, *, period: str = "period") -> DataFrame:
    """Stored states with those of the ``touched`` periods (distinct rows) taken from ``fresh``."""
    return states.join(touched.select(period).distinct(), period, "left_anti").unionByName(fresh)


def distinct_count(states: DataFrame, *, period: str = "period", name: str = "n_distinct") -> DataFrame:
    """period and its exact number of distinct numbers."""
    return states.groupBy(period).agg(F.sum(F.bitmap_count("bits")).alias(name))
