"""Mixing sources to target weights with a time-varying curriculum.

Targets: a source's share of all words follows its weight; a target stops at ``max_repeats`` times
the source's size, and the excess goes to the other sources by weight (one water level over the
sources). Curriculum: a source's weight may change over training time t in [0, 1] as a straight
line from ``start`` to ``end``. Its integral, scaled to the target, is the source's cumulative
token demand; a document that covers the words [a, b) of its source's supply is trained at the
time at which demand reaches a. The supply repeats the source's documents, in a fixed pseudo-random
order, until the target is met. The plan takes part of the last copy, so that it meets the target to
the word; :func:`mix`, which returns texts, takes that copy whole or not at all, whichever comes
nearer to the target: no text is cut.

DataFrame functions only. The running sum inside a source is made in two steps (sums of hash
buckets, then inside each bucket), so a source that holds a third of all rows is spread over many
tasks; only ids and numbers are shuffled.

Defined results
    null text: size 0, nothing taken. A null source is a source of its own and comes last in code
    point order. Equal doc_ids are ordered by a hash of their text; fully equal rows each count
    with their own words. An empty table gives an empty result. Further columns are passed
    through, except those named like an output column, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsmart.llm.storage import stored
from obsmart.llm.text import WORD, whole

WEIGHTS = (5.0, 2.0, 1.0)        # by source in code point order, repeating
MAX_REPEATS = 3
ROWS_PER_BUCKET = 2000
# Slope of each source's weight over training time, in source order and repeating: 1 rises from
# nothing to twice its mean, -1 falls from twice its mean to nothing, 0 stays level.
SLOPES = (0.0, -0.5, 0.5)
PLAN = ["size", "source_size", "target", "taken", "position"]


def size_of(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size (one row per source) with weight, slope and target.

    One window over the sources (not the documents). Sources are capped in order of size / weight;
    the level after capping the first j is (all words - their caps) / (weights left), and the first
    level that the next source can bear is the water level.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(order) - 1

    def turn(values) -> Column:
        return F.get(F.array(*[F.lit(float(v)) for v in values]), F.pmod(rank, F.lit(len(values))))

    s = sizes.withColumns({"weight": turn(weights), "slope": turn(slopes)})
    s = s.withColumn("cap", F.col("source_size") * max_repeats)
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = s.withColumns({"capped": F.coalesce(F.sum("cap").over(before), F.lit(0)),
                       "weighed": F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
                       "words": F.sum("source_size").over(everything),
                       "weight_sum": F.sum("weight").over(everything)})
    level = (F.col("words") - F.col("capped")) / (F.col("weight_sum") - F.col("weighed"))
    s = s.withColumn("fits", F.when(level <= F.col("ratio"), level))
    s = s.withColumn("level", F.min(F.when(F.col("fits").isNotNull(), F.struct("ratio", "fits")))
                     .over(everything)["fits"])
    return s.withColumn("target", F.when(F.col("fits").isNull(), F.col("cap").cast("double"))
                        .otherwise(F.col("level") * F.col("weight"))).select(
        "source", "source_size", "weight", "slope", "target")


def time_of(share: Column, slope: Column) -> Column:
    """The time at which a source with weight 1 + slope * (2 t - 1) has asked for ``share`` of its
    tokens: the root in [0, 1] of (1 - slope) t + slope t^2 = share, in the form that stays exact
    at slope 0."""
    b = 1 - slope
    return F.when(share <= 0, F.lit(0.0)).otherwise(
        2 * share / (b + F.sqrt(F.greatest(F.lit(0.0), b * b + 4 * slope * share))))


def plan_mix(docs: DataFrame, weights=WEIGHTS, slopes=SLOPES, max_repeats: int = MAX_REPEATS,
             rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row per document, without its text: its own columns plus ``PLAN``. ``copies`` holds
    (words, position) of each repeat; position is the first repeat's time, null if not taken."""
    own = [c for c in docs.columns if c not in ("text", "copies", *PLAN)]
    d = stored(docs.select(*own, size_of(F.col("text")).alias("size"),
                           F.xxhash64(F.lit(3), "doc_id").alias("__key"), F.xxhash64("text").alias("__text")))
    return _planned(d, own, weights, slopes, max_repeats, rows_per_bucket).drop("__text")


def _planned(d: DataFrame, own: list[str], weights, slopes, max_repeats, rows_per_bucket) -> DataFrame:
    rows = d.count()
    d = d.withColumn("__bucket", F.pmod("__key", F.lit(max(1, rows // rows_per_bucket))))
    buckets = stored(d.groupBy("source", "__bucket").agg(F.sum("size").alias("__sum")))
    targets = stored(source_targets(buckets.groupBy("source").agg(F.sum("__sum").alias("source_size")),
                                    weights, slopes, max_repeats))
    earlier = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("__base", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)))
    b = buckets.join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))) \
        .select(F.col("source").alias("__s"), F.col("__bucket").alias("__b"), "__base", "source_size", "slope", "target")
    inside = (Window.partitionBy("source", "__bucket").orderBy("__key", "doc_id", "__text")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("__before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = d.join(b, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    ask = F.round("target").cast("long")
    start = F.col("__base") + F.col("__before")

    def copy(k: int) -> Column:
        begin = F.col("source_size") * k + start
        return F.struct(F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), ask - begin)).alias("words"),
                        time_of(begin / F.nullif(F.col("target"), F.lit(0.0)), F.col("slope")).alias("position"))

    copies = F.filter(F.array(*[copy(k) for k in range(max_repeats)]), lambda c: c["words"] > 0)
    d = d.withColumn("copies", copies)
    return d.select(*own, "size", "source_size", "target",
                    F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]).alias("taken"),
                    F.get("copies", F.lit(0))["position"].alias("position"), "copies", "__text")


def mix(docs: DataFrame, weights=WEIGHTS, slopes=SLOPES, max_repeats: int = MAX_REPEATS,
        rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The training order itself: a row per copy that is taken, with the columns of ``docs``, range
    sorted by position. The copy that meets its source's target midway is whole in it if the plan
    takes at least half of its words, else left out."""
    own = ["doc_id", "source"]
    d = stored(docs.select(*own, size_of(F.col("text")).alias("size"),
                           F.xxhash64(F.lit(3), "doc_id").alias("__key"), F.xxhash64("text").alias("__text")))
    plan = _planned(d, own, weights, slopes, max_repeats, rows_per_bucket)
    key = ["__doc", "__text", "__source"]
    plan = plan.withColumn("copies", F.filter("copies", lambda c: 2 * c["words"] >= F.col("size")))
    plan = stored(plan.where(F.size("copies") > 0)
                  .select(F.col("doc_id").alias("__doc"), "__text", F.col("source").alias("__source"), "copies")
                  .groupBy(*key).agg(F.flatten(F.collect_list("copies")).alias("__copies"),
                                     F.count(F.lit(1)).alias("__rows")))
    if not plan.where("__rows > 1").isEmpty():
        docs = docs.dropDuplicates(["doc_id", "source", "text"])
    return _copies(docs, plan)


def _copies(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` joined to their planned copies: of rows with equal doc_id, source and text, one
    stands for all and carries the copies of each."""
    d = docs.select("*", F.xxhash64("text").alias("__hash"))
    d = d.join(plan, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__text"))
               & F.col("source").eqNullSafe(F.col("__source")))
    d = d.select(*docs.columns, F.explode("__copies").alias("__copy"))
    return (d.select(*docs.columns, F.col("__copy.position").alias("__position"))
            .repartitionByRange("__position", "doc_id").sortWithinPartitions("__position", "doc_id").drop("__position"))
