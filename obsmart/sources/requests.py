"""Requests against what has landed: which are done, to be sent (again), or given up.

The raw layer holds two logs: ``_landings`` (which landing brought which range and entity) and
``_rejected`` (every response that brought none, with its reason, under the number of the run that
got it). A plan of requests is reconciled with both, so a run that was cut off, throttled or refused
goes on with exactly what is missing, and no request is sent more often than allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.schemas import REQUEST_ATTEMPTS
from obsmart.sinks.folders import is_empty
from obsmart.sources.raw import read_landings, triage

REJECTED = "_rejected"
STATES = ("done", "open", "fatal", "given_up")


def _state(max_attempts: int):
    return (F.when(F.col("_good") > 0, "done").when(F.col("_fatal") > 0, "fatal")
            .when(F.col("attempts") >= max_attempts, "given_up").otherwise("open"))


def reconcile(plan: DataFrame, tries: DataFrame, *, entity: str = "slug", max_attempts: int = REQUEST_ATTEMPTS) -> DataFrame:
    """``plan`` (<entity>, chunk_start, chunk_end, ...; one row a request) with ``attempts``,
    ``last_reason`` and ``state``.

    ``tries``: (<entity>, range_start, range_end, outcome, reason, seq), any number a request, in the
    order of ``seq``. A request is ``done`` if any try was good, ``fatal`` if one was refused (it is
    not repeated), ``given_up`` after ``max_attempts`` tries, else ``open``. Tries without a request
    are ignored, a NULL entity or day matches nothing. Tries are counted before the join (combined
    map-side), so a request with very many of them is one row there.
    """
    said = (tries.groupBy(F.col(entity).alias("_e"), F.col("range_start").alias("_s"), F.col("range_end").alias("_t"))
            .agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("outcome") == "good").alias("_good"),
                 F.count_if(F.col("outcome") == "fatal").alias("_fatal"),
                 F.max(F.struct("seq", "reason")).getField("reason").alias("last_reason")))
    on = (plan[entity] == said["_e"]) & (plan["chunk_start"] == said["_s"]) & (plan["chunk_end"] == said["_t"])
    out = plan.join(said, on, "left").drop("_e", "_s", "_t")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("attempts", "_good", "_fatal")})
    return out.withColumn("state", _state(max_attempts)).drop("_good", "_fatal")


def tries_of(responses: DataFrame, *, entity: str, seq: str) -> DataFrame:
    """Responses (<entity>, range_start, range_end, status, body, <seq>) as tries for ``reconcile``."""
    return triage(responses).select(entity, "range_start", "range_end", "outcome", "reason", F.col(seq).alias("seq"))


def read_rejected(spark: SparkSession, path: str, entity: str = "city") -> DataFrame:
    """(run, range, <entity>, status, outcome, reason) of the responses that brought no payload."""
    schema = f"range string, `{entity}` string, status int, outcome string, reason string, run bigint"
    if is_empty(spark, f"{path}/{REJECTED}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{REJECTED}")


def write_rejected(rejected: DataFrame, path: str, run: int, entity: str = "city") -> None:
    """Log (range, <entity>, status, outcome, reason) under ``run``; a repeated run replaces its rows."""
    rows = rejected.select("range", F.col(entity).cast("string").alias(entity), F.col("status").cast("int").alias("status"),
                           "outcome", "reason", F.lit(run).cast("long").alias("run"))
    (rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run").parquet(f"{path}/{REJECTED}"))


def next_run(spark: SparkSession, path: str, entity: str = "city") -> int:
    """The number after the last landing and the last run with rejected responses."""
    landed = read_landings(spark, path, entity).agg(F.max("landing")).first()[0] or 0
    tried = read_rejected(spark, path, entity).agg(F.max("run")).first()[0] or 0
    return max(landed, tried) + 1


def request_states(spark: SparkSession, path: str, plan: DataFrame, *, key: str = "slug", entity: str = "city",
                   max_attempts: int = REQUEST_ATTEMPTS) -> DataFrame:
    """``plan`` reconciled with the logs of the raw layer at ``path``."""
    good = read_landings(spark, path, entity).select("range", entity, F.lit("good").alias("outcome"),
                                                      F.lit(None).cast("string").alias("reason"), F.col("landing").alias("seq"))
    bad = read_rejected(spark, path, entity).select("range", entity, "outcome", "reason", F.col("run").alias("seq"))
    both = good.unionByName(bad)
    tries = both.select(F.col(entity).alias(key), F.to_date(F.substring_index("range", "_", 1)).alias("range_start"),
                        F.to_date(F.substring_index("range", "_", -1)).alias("range_end"), "outcome", "reason", "seq")
    return reconcile(plan, tries, entity=key, max_attempts=max_attempts)


def next_requests(states: DataFrame) -> DataFrame:
    """The requests to send now, with the number of the attempt."""
    return (states.where(F.col("state") == "open").withColumn("attempt", F.col("attempts") + 1)
            .drop("state", "attempts"))
