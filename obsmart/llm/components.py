"""Connected components as DataFrame rounds of large-star and small-star.

Every round turns the edges so that nodes hang from smaller ones; the edges end as stars around
the least node of each component. Each round is a few aggregations and joins on the node, with
map-side combine for hubs, and its edges are stored, so lineage stays short and nothing but two
numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmart.llm.storage import stored

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of ``edges`` (u, v of one ordered type).

    Null ends and self-loops carry no link and are ignored; repeated edges count once; without
    edges the result is empty.
    """
    e = (edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
         .where("a <> b").where(edges["u"].isNotNull() & edges["v"].isNotNull())
         .select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    e, before = stored(e), None
    for _ in range(MAX_ROUNDS):
        n, mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not n or (n, mark) == before:
            break
        before = n, mark
        e = stored(_small_star(_large_star(e)))
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
