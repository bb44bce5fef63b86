"""Incremental runs: new raw payload files trigger a re-run of their periods.

A Structured Streaming file source watches the raw layer; ``trigger(availableNow=True)``
processes every file that arrived since the last run and stops (a scheduled job without a
long-running query). Each micro-batch only tells which periods received payloads: the
distinct ``range`` keys of the batch, a handful of rows. Every such period is then re-run
through the batch steps, which are idempotent: the period's days are rebuilt from all of
its raw payloads (not just the new files), so a late or corrected payload replaces its
days whole, and the mart and serving table follow. Progress lives in the streaming
checkpoint, so a restarted job continues where it stopped.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.plans.runs import Layers, run_steps
from obsmart.sinks.lake import next_landing
from obsmart.sources.raw import RANGE_PATTERN

RANGE_IN_PATH = r"range=(\d{4}-\d{2}-\d{2}_\d{4}-\d{2}-\d{2})"


def raw_stream(spark: SparkSession, raw_path: str, *, max_files: int | None = None) -> DataFrame:
    """Streaming frame of newly landed payload files: ``(range, range_start, range_end, landing)``.

    The range comes from the file path, so the stream does not depend on partition
    discovery of a folder that may still be empty when the query starts. Files are read
    whole (only their path matters), so both raw layouts work.
    """
    reader = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.load(raw_path)
    rng = F.regexp_extract(F.col("_metadata.file_path"), RANGE_IN_PATH, 1)
    return df.select(
        rng.alias("range"),
        F.to_date(F.regexp_extract(rng, RANGE_PATTERN, 1)).alias("range_start"),
        F.to_date(F.regexp_extract(rng, RANGE_PATTERN, 2)).alias("range_end"),
        F.expr("try_cast(regexp_extract(_metadata.file_path, 'landing=([0-9]+)/', 1) AS bigint)").alias("landing"),
    ).where(F.col("range") != "")


def rerun_periods(spark: SparkSession, layers: Layers, dim: DataFrame, periods, *,
                  load_ts: datetime | None = None, layout: str = "folders",
                  propagate: bool = False) -> list[dict]:
    """Re-run the chain after the landing, gates included (``plans.runs.run_steps``), for each
    ``(start, end)`` period; a period that fails a gate raises and is not served. ``propagate=True`` also rebuilds (and reloads) the days whose norms depend on it."""
    done = []
    for start, end in sorted(set(periods)):
        steps = run_steps(spark, layers, dim, start, end, load_ts=load_ts, layout=layout, propagate=propagate)
        step = {"period": (start, end), "staging": steps["transform"]["rows"], "mart": steps["aggregate"]}
        if "load" in steps:
            step["served"] = steps["load"]
        done.append(step)
    return done


def run_available(spark: SparkSession, layers: Layers, dim: DataFrame, checkpoint: str, *,
                  load_ts: datetime | None = None, max_files: int | None = None,
                  layout: str = "folders", propagate: bool = False) -> list[dict]:
    """Process every raw file that arrived since the last call, then stop.

    ``checkpoint`` is the streaming query's own folder (on shared storage). Returns what was
    re-run, per period.
    """
    log: list[dict] = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        found = batch.groupBy("range_start", "range_end").agg(F.max("landing").alias("landing")).collect()
        newest, done = max((r.landing or 0 for r in found), default=0), next_landing(spark, layers.raw) - 1
        if newest > done:       # the batch is taken again by the next call
            raise RuntimeError(f"landing {newest} is not in the landing log yet")
        periods = [(r.range_start, r.range_end) for r in found]
        log.extend(rerun_periods(batch.sparkSession, layers, dim, periods, load_ts=load_ts,
                                 layout=layout, propagate=propagate))

    query = (raw_stream(spark, layers.raw, max_files=max_files).writeStream
             .foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return log
