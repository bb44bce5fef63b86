"""The chain for a period: extract -> transform -> staging gate -> aggregate -> load -> mart gate.

Each step reads its input layer and writes its output layer, so every step (and the whole
chain) can be re-run for any period without duplicates, and a failed step leaves the
previous layers intact. Lineage never spans layers: each step starts from written files.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsmart.operators.calendar import check_period, month_chunk_bounds
from obsmart.operators.normalize import assign_day, clean, enrich, unpivot_arrays
from obsmart.operators.quality import (
    DataQualityError, gate, mart_stats, mart_violations, profile_of, refresh_profile, staging_violations,
)
from obsmart.plans.mart import build_mart
from obsmart.plans.propagate import aggregate_changed, load_changed
from obsmart.plans.serving import current, current_table, load_range, load_table
from obsmart.schemas import (
    NORM_WINDOW_DAYS, REQUEST_ATTEMPTS, STAGING_COLUMNS, STAGING_SCHEMA, WEATHER_PERCENT_COLUMNS, WEATHER_RANGES,
    WEATHER_VARIABLES,
)
from obsmart.session import cut_lineage
from obsmart.sinks.folders import is_empty
from obsmart.sinks.lake import overwrite_days, write_raw
from obsmart.sinks.tables import create_bucketed, write_bucketed
from obsmart.sources.lake import read_days
from obsmart.sources.raw import fetch_plan, read_raw, triage
from obsmart.sources.requests import next_requests, next_run, read_rejected, request_states, write_rejected

DIM_ATTRS = {"name": "city_name", "country": "country", "lat": "latitude", "lon": "longitude"}


@dataclass
class Layers:
    raw: str
    staging: str
    mart: str
    serving: str
    staging_table: str | None = None    # a bucketed catalog table instead of the staging path
    serving_table: str | None = None    # a bucketed catalog table instead of the serving path
    daily: str | None = None            # unrounded daily rows, for re-runs of what changed
    profile: str | None = None          # the stored quality profile (per entity and day)


def create_staging_table(spark: SparkSession, layers: Layers, *, buckets: int = 64) -> None:
    """Register ``layers.staging_table`` at ``layers.staging``: day partitions, bucketed by
    place and sorted by (place, ts). The rollup, the norm window and the quality profile then
    read co-located rows and run without shuffling the staging."""
    fields = [T.StructField(f.name, f.dataType) for f in STAGING_SCHEMA.fields]
    schema = T.StructType(fields + [T.StructField("dt", T.DateType())])
    create_bucketed(spark, layers.staging_table, layers.staging, schema, partition="dt",
                    bucket="city", sort=("city", "ts"), buckets=buckets)


def read_staging(spark: SparkSession, layers: Layers, start, end, *, lookback: int = 0) -> DataFrame:
    """Staging rows of ``[start - lookback, end]`` from the path layer or the bucketed table."""
    if not layers.staging_table:
        return read_days(spark, layers.staging, start, end, lookback=lookback)
    start, end = check_period(start, end)
    return spark.table(layers.staging_table).where(
        F.col("dt").between(F.lit(start - timedelta(days=lookback)), F.lit(end)))


def write_staging(rows: DataFrame, layers: Layers, period=None) -> int:
    """Replace the staging days present in ``rows``; with ``period``, also remove its days that no
    longer have rows (unless there are none at all)."""
    if layers.staging_table:
        return write_bucketed(rows, layers.staging_table, overwrite=True, period=period)
    return overwrite_days(rows, layers.staging, sort_within=("city", "ts"), period=period)


@dataclass
class RunReport:
    steps: dict = field(default_factory=dict)
    next_requests: DataFrame | None = None      # what is still to be requested (see ``sources.requests``)


class OpenRequests(DataQualityError):
    """Requests of the period have brought no payload yet; ``next_requests`` are to be sent next."""

    def __init__(self, message: str, next_requests: DataFrame):
        super().__init__(message)
        self.next_requests = next_requests


def extract_range(landed: DataFrame, raw_path: str, start, end, *, entity: str = "city",
                  layout: str = "folders", run: int | None = None) -> dict:
    """Landed responses ``(status, <entity>, body[, range_start, range_end])`` -> raw layer.

    Good payloads land under their request's range (the chunk columns, e.g. joined from
    ``sources.raw.fetch_plan``), else under the period's range, as landing number ``run`` (by default
    the next one). All other responses go to the layer's log of rejected ones under the same number;
    they are returned as a frame too, with the numbers of retryable and fatal ones."""
    spark = landed.sparkSession
    start, end = check_period(start, end)
    t = triage(landed)
    if "range_start" in landed.columns and "range_end" in landed.columns:   # per request chunk
        rng = F.concat_ws("_", F.date_format("range_start", "yyyy-MM-dd"),
                          F.date_format("range_end", "yyyy-MM-dd"))
    else:
        rng = F.lit(f"{start:%Y-%m-%d}_{end:%Y-%m-%d}")
    t = t.withColumn("range", rng)
    run = run if run is not None else next_run(spark, raw_path, entity)
    good = t.where(F.col("outcome") == "good").select("range", entity, "body")
    written = write_raw(good, raw_path, entity=entity, layout=layout, landing=run)
    rejected = t.where(F.col("outcome") != "good").select("range", entity, "status", "outcome", "reason")
    write_rejected(rejected, raw_path, run, entity)
    logged = read_rejected(spark, raw_path, entity).where(F.col("run") == run)
    n = logged.agg(F.count_if(F.col("outcome") == "retry"), F.count_if(F.col("outcome") == "fatal")).first()
    return {"written": written, "run": run, "rejected": logged.select(entity, "status", "outcome", "reason", "range"),
            "retry": n[0], "fatal": n[1]}


def requests_of(landed: DataFrame, dim: DataFrame, start, end) -> DataFrame:
    """The requests that a period needs: a place and month chunk each where the responses name their
    chunks, else a place each."""
    if "range_start" in landed.columns and "range_end" in landed.columns:
        return fetch_plan(dim, start, end, WEATHER_VARIABLES)
    start, end = check_period(start, end)
    return dim.select("slug", F.lit(start).alias("chunk_start"), F.lit(end).alias("chunk_end"))


def transform_payloads(payloads: DataFrame, dim: DataFrame, start, end, *,
                       variables=WEATHER_VARIABLES, entity: str = "city",
                       percent_columns=WEATHER_PERCENT_COLUMNS, strict: bool = False,
                       repairs: Observation | None = None, dropped: Observation | None = None,
                       unmatched: Observation | None = None) -> DataFrame:
    """Payload rows -> clean hourly staging rows of ``[start, end]`` (with ``dt``).

    Observations: ``repairs`` per clipped column; ``dropped``: rows without a readable time
    (no_time; an error if ``strict``) or without an entity (no_entity); ``unmatched``: rows
    without a dimension entry."""
    keep = tuple(c for c in ("landing", "landed_at", "range_end", entity) if c in payloads.columns)
    rows = unpivot_arrays(payloads, variables, keep=keep, ts="ts", strict=strict)
    if dropped is not None:
        rows = rows.observe(dropped, F.count_if(F.col("ts").isNull()).alias("no_time"),
                            F.count_if(F.col(entity).isNull()).alias("no_entity"))
    rows = assign_day(rows, "ts", "dt", start, end)
    rows = clean(rows, keys=(entity, "ts"), percent_columns=percent_columns, observation=repairs)
    rows = enrich(rows, dim, fact_key=entity, dim_key="slug", attrs=DIM_ATTRS, observation=unmatched)
    cols = [c for c in STAGING_COLUMNS if c in rows.columns] if entity == "city" else rows.columns
    return rows.select(*[c for c in cols if c not in ("landing", "landed_at", "range_end", "_pos", "dt")], "dt")


def transform_range(spark: SparkSession, layers: Layers, dim: DataFrame, start, end, *,
                    layout: str = "folders", chunks: bool = True, **kw) -> dict:
    """raw -> staging for ``[start, end]``: every touched day is replaced whole.

    Raw ranges read (all in one job): the calendar-month chunks of the period -- the ranges
    the chain extracts, one request per place and chunk -- and the period itself as one
    range. For a period within one month both are the period. ``chunks=False``: only the
    period's own range.
    """
    repairs, dropped, unmatched = Observation("repairs"), Observation("dropped"), Observation("unmatched")
    ranges = None
    if chunks:
        ranges = month_chunk_bounds(start, end)
        whole = check_period(start, end)
        if whole not in ranges:
            ranges.append(whole)
    payloads = read_raw(spark, layers.raw, start, end, layout=layout, ranges=ranges)
    rows = transform_payloads(payloads, dim, start, end, repairs=repairs, dropped=dropped,
                              unmatched=unmatched, **kw)
    n = write_staging(rows, layers, period=(start, end))
    if n == 0:   # no raw payload (or only empty ones) for the period: stop the chain here
        raise DataQualityError(f"staging: no rows from raw for {start}..{end}"
                               + (" (month chunks)" if chunks else ""))
    return {"rows": n, "repaired": dict(repairs.get), "dropped": dict(dropped.get) | dict(unmatched.get)}


def staging_gate(spark: SparkSession, layers: Layers, dim: DataFrame, start, end, *, touched=None) -> int:
    """Raise on any staging violation in ``[start, end]``; else return the rows checked.

    With ``Layers.profile`` the checks read the stored profile, of which only the days ``touched``
    (a period; by default the whole one) are made anew from the staging."""
    how = dict(entity="city", ts="ts", day="dt", metrics=list(WEATHER_VARIABLES.values()), ranges=WEATHER_RANGES)
    if layers.profile:
        first, last = check_period(*(touched or (start, end)))
        refresh_profile(spark, read_staging(spark, layers, first, last), layers.profile, first, last, **how)
        profile = read_days(spark, layers.profile, start, end)
    else:
        profile = profile_of(read_staging(spark, layers, start, end), start=start, end=end, **how)
    gate(staging_violations(None, start=start, end=end, expected=dim.select(F.col("slug").alias("city")), profile=profile, **how), name="staging")
    return profile.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def aggregate_range(spark: SparkSession, layers: Layers, start, end, *,
                    processed_at=True, propagate: bool = False) -> int:
    """staging -> mart for ``[start, end]``, with ``NORM_WINDOW_DAYS`` of history read.

    ``propagate=True`` also rewrites the ``NORM_WINDOW_DAYS`` days after ``end`` whose norms
    depend on the re-run days (only days that have staging rows produce mart rows).
    """
    start, end = check_period(start, end)
    if propagate:
        end = end + timedelta(days=NORM_WINDOW_DAYS)
    hourly = read_staging(spark, layers, start, end, lookback=NORM_WINDOW_DAYS)
    mart = build_mart(hourly, start=start, end=end, processed_at=processed_at)
    return overwrite_days(mart, layers.mart, sort_within=("city",), period=(start, end))


def mart_gate(spark: SparkSession, layers: Layers, start, end, n_entities: int) -> dict:
    """Raise when the served mart of ``[start, end]`` is incomplete or inconsistent."""
    start, end = check_period(start, end)
    if layers.serving_table:
        served = current_table(spark, layers.serving_table, start, end)
    else:
        served = current(spark, layers.serving, start, end)
    row = mart_stats(served, start=start, end=end).first()
    stats = spark.createDataFrame([row])
    gate(mart_violations(stats, n_entities=n_entities, n_days=(end - start).days + 1), name="mart")
    return row.asDict()


def run_range(spark: SparkSession, layers: Layers, dim: DataFrame, start, end, *,
              load_ts: datetime, landed: DataFrame | None = None,
              layout: str = "folders", chunks: bool = True,
              propagate: bool | str = False, max_attempts: int = REQUEST_ATTEMPTS) -> RunReport:
    """The whole chain for a period; the first failing step stops the rest. Responses in ``landed``
    are landed first and the period's requests reconciled with all landings so far: while any is
    without a payload the chain stops with ``OpenRequests``, which has the requests to send next.
    ``layout`` is the raw layer's layout (see ``sinks.lake.write_raw``); ``chunks`` as in
    ``transform_range``; ``propagate=True`` also rebuilds and reloads the days after the
    period whose norms depend on it, ``"changed"`` only those that a change reaches (``run_steps``)."""
    start, end = check_period(start, end)
    report = RunReport()
    if landed is not None:
        got = extract_range(landed, layers.raw, start, end, layout=layout)
        report.steps |= {"extract": got["written"], "retry": got["retry"]}
        if got["fatal"]:
            first = got["rejected"].where(F.col("outcome") == "fatal").limit(10).collect()
            raise DataQualityError(f"extract: {got['fatal']} fatal responses, e.g. "
                                   + "; ".join(f"{r[0]}: {r['reason']}" for r in first))
        states = cut_lineage(request_states(spark, layers.raw, requests_of(landed, dim, start, end), max_attempts=max_attempts))
        counts = dict(states.groupBy("state").count().collect())
        report.steps["requests"] = counts
        report.next_requests = next_requests(states)
        if counts.get("open") or counts.get("given_up"):
            raise OpenRequests(f"extract: {counts.get('open', 0)} requests are still open, {counts.get('given_up', 0)} given up "
                               f"after {max_attempts} attempts", report.next_requests)
    report.steps |= run_steps(spark, layers, dim, start, end, load_ts=load_ts, layout=layout,
                              chunks=chunks, propagate=propagate)
    return report


def run_steps(spark: SparkSession, layers: Layers, dim: DataFrame, start, end, *,
              load_ts: datetime | None, layout: str = "folders", chunks: bool = True,
              propagate: bool | str = False) -> dict:
    """Everything after the landing, with both gates; ``load_ts=None`` stops before the load.
    ``propagate="changed"`` (with ``Layers.daily`` and path layers): only mart rows that a changed
    daily row reaches are rebuilt, and only rows that differ are loaded."""
    if propagate == "changed" and (not layers.daily or layers.serving_table):
        raise ValueError('propagate="changed" needs Layers.daily and a serving path')
    steps = {"transform": transform_range(spark, layers, dim, start, end, layout=layout, chunks=chunks)}
    steps["staging_dq"] = staging_gate(spark, layers, dim, start, end)
    if propagate == "changed":
        done = aggregate_changed(spark, layers, read_staging(spark, layers, start, end), start, end)
        steps |= {"aggregate": done["rebuilt"], "propagation": done}
    else:
        steps["aggregate"] = aggregate_range(spark, layers, start, end, propagate=propagate)
    if load_ts is None:
        return steps
    last = end + timedelta(days=NORM_WINDOW_DAYS) if propagate else end
    if propagate == "changed":
        served = None if is_empty(spark, layers.serving) else current(spark, layers.serving, start, last)
        steps["load"] = load_changed(spark, layers.mart, served, layers.serving, start, last, load_ts=load_ts)
    elif layers.serving_table:
        steps["load"] = load_table(spark, layers.mart, layers.serving_table, start, last, load_ts=load_ts)
    else:
        steps["load"] = load_range(spark, layers.mart, layers.serving, start, last, load_ts=load_ts)
    steps["mart_dq"] = mart_gate(spark, layers, start, end, dim.count())
    return steps
