"""Registered queries over the driver's tables, each with an independent SQL oracle.

Role mapping (no weather data in the tables):

* ``events``   -- hourly observations: entity ``event_type``, time ``ts``, metric ``value``.
  Landed as column-oriented payloads (one per type and day, as the source API delivers
  them), unpacked, cleaned and rolled up exactly like the weather chain.
* ``lineitem`` -- a multi-metric daily series: entity ``l_returnflag``, day of
  ``l_shipdate``; four metrics map onto the eight daily aggregates of the weather mart.
* ``orders``   -- versions per customer (latest-version reads) and per-customer periods
  (fetch plan); ``customer`` is the dimension that enriches it.

Every query reads whole tables. The oracle SQL (DuckDB dialect) recomputes each result
from the same tables without the library.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.operators.calendar import as_day, expected_grid, lookback_start, month_chunks_between
from obsmart.operators.normalize import (
    assign_day, clean, clip_columns, enrich, keep_last, repair_counts, to_ntz, unpivot_arrays,
)
from obsmart.operators.quality import (
    first_violations, mart_stats, mart_violations, profile_entities, profile_of, profile_span, staging_violations,
)
from obsmart.operators.rollup import daily
from obsmart.operators.versions import conform
from obsmart.plans import reports
from obsmart.plans.mart import build_mart
from obsmart.plans.serving import resolve
from obsmart.schemas import NORM_WINDOW_DAYS, DailySpec, Roles
from obsmart.sources.lake import partition_inventory_of
from obsmart.sources.raw import fetch_plan, land_payloads, triage

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Parameters of the registered queries.
EMPTY_TAIL_DAYS = 3          # the checked period runs this many days past the data: empty days
EVENTS_RANGES = {"value": (0.0, 400.0)}
RELOAD_PERIOD = (date(1997, 1, 1), date(1997, 12, 31))     # a re-run of one year
LOAD_TS_1 = datetime(2026, 1, 1, 0, 0, 0)
LOAD_TS_2 = datetime(2026, 1, 2, 0, 0, 0)
PIVOT_FLAGS = {"A": "flag_a", "N": "flag_n", "R": "flag_r"}
YEARS = (1996, 1997)
WET_THRESHOLD = 250000.0
SCALE = 2                                                  # decimals of the source values

EV_ROLES = Roles(entity="event_type", ts="ts", day="dt", metrics=("value",))
EV_SPEC = DailySpec(
    aggs=(("value_min", "min", "value"), ("value_max", "max", "value"),
          ("value_avg", "avg", "value"), ("value_sum", "sum", "value")),
    count_col="hours_count", value="value_avg", norm="value_norm_30d", anomaly="value_anomaly")

LI_ROLES = Roles(entity="l_returnflag", ts="l_shipdate", day="dt",
                 metrics=("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
LI_SPEC = DailySpec(
    aggs=(("qty_min", "min", "l_quantity"), ("qty_max", "max", "l_quantity"),
          ("qty_avg", "avg", "l_quantity"), ("price_sum", "sum", "l_extendedprice"),
          ("disc_max", "max", "l_discount"), ("tax_avg", "avg", "l_tax"),
          ("disc_avg", "avg", "l_discount"), ("price_avg", "avg", "l_extendedprice")),
    count_col="rows_count", value="qty_avg", norm="qty_norm_30d", anomaly="qty_anomaly")


OR_ROLES = Roles(entity="o_orderpriority", ts="o_orderdate", day="dt", metrics=("o_totalprice",))
OR_SPEC = DailySpec(
    aggs=(("price_min", "min", "o_totalprice"), ("price_max", "max", "o_totalprice"),
          ("price_avg", "avg", "o_totalprice"), ("price_sum", "sum", "o_totalprice")),
    count_col="orders_count", value="price_avg", norm="price_norm_30d", anomaly="price_anomaly")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------------------------
# Shared Spark building blocks
# --------------------------------------------------------------------------------------------

def events_shape(spark, sf_dir) -> tuple[date, date, int]:
    """The checked period, first day of the events to ``EMPTY_TAIL_DAYS`` past the last day, and the
    number of types (one-row statistic, so the checks cover the whole table at any scale)."""
    r = table(spark, sf_dir, "events").agg(F.min(F.to_date("ts")).alias("s"), F.max(F.to_date("ts")).alias("e"),
                                           F.count_distinct("event_type").alias("n")).first()
    return r.s, r.e + timedelta(days=EMPTY_TAIL_DAYS), r.n


def checks_of(hours: DataFrame, metrics=("value",)) -> DataFrame:
    """All staging checks of hourly rows by type. Period and types come from the profile, so the rows
    are read once."""
    how = dict(entity="event_type", ts="ts", day="dt", metrics=list(metrics), ranges=EVENTS_RANGES)
    profile = profile_of(hours, **how)
    first, last = profile_span(profile)
    return staging_violations(None, start=first, end=last + timedelta(days=EMPTY_TAIL_DAYS), profile=profile,
                              expected=profile_entities(profile, "event_type"), **how)


def events_hourly(spark, sf_dir) -> DataFrame:
    """Events as hourly observations (time truncated to the hour, duplicates kept)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"),
                     "value", F.to_date("ts").alias("dt"))


def events_payloads(spark, sf_dir) -> DataFrame:
    """Events landed as column-oriented payloads, one per type and day."""
    ev = table(spark, sf_dir, "events")
    return land_payloads(ev, entity="event_type", ts="ts", metrics={"value": "value"},
                         order=["event_id"], period="day")


def events_rows(spark, sf_dir) -> DataFrame:
    """Payloads unpacked: one row per type and hour of each landed day."""
    return unpivot_arrays(events_payloads(spark, sf_dir), {"value": "value"},
                          keep=("range_end", "event_type"), ts="ts")


def events_staging(spark, sf_dir) -> DataFrame:
    rows = assign_day(events_rows(spark, sf_dir), "ts", "dt")
    return clean(rows, keys=("event_type", "ts")).drop("range_end", "_pos")


def events_mart(spark, sf_dir) -> DataFrame:
    return build_mart(events_staging(spark, sf_dir), roles=EV_ROLES, spec=EV_SPEC,
                      exact_scale=SCALE, processed_at=None)


def lineitem_obs(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", *LI_ROLES.metrics)
    return assign_day(li, "l_shipdate", "dt")


def lineitem_mart(spark, sf_dir, start=None, end=None) -> DataFrame:
    obs = lineitem_obs(spark, sf_dir)
    if start is not None:  # a re-run reads its period plus the norm's history only
        obs = obs.where(F.col("dt").between(F.lit(lookback_start(as_day(start), NORM_WINDOW_DAYS)), F.lit(end)))
    return build_mart(obs, start=start, end=end, roles=LI_ROLES, spec=LI_SPEC,
                      exact_scale=SCALE, processed_at=None)


# --------------------------------------------------------------------------------------------
# Registered queries
# --------------------------------------------------------------------------------------------

def q_unpivot_arrays(spark, sf_dir):
    rows = events_rows(spark, sf_dir)
    return rows.select("event_type", to_ntz("ts").alias("ts"), "value")


def q_keep_last(spark, sf_dir):
    h = events_hourly(spark, sf_dir).drop("dt")
    return keep_last(h, ["event_type", "ts"], ["event_id"])


def q_clip_columns(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return clip_columns(ev, ["value"], 0.0, 100.0)


def q_repair_counts(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return repair_counts(ev, ["value"], 0.0, 100.0)


def q_enrich(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    customer = table(spark, sf_dir, "customer")
    return enrich(orders, customer, fact_key="o_custkey", dim_key="c_custkey",
                  attrs={"c_name": "c_name", "c_nationkey": "c_nationkey",
                         "c_mktsegment": "c_mktsegment"})


def q_daily_rollup(spark, sf_dir):
    return daily(lineitem_obs(spark, sf_dir), entity="l_returnflag", day="dt", aggs=LI_SPEC.aggs,
                 count_col="rows_count", exact_scale=SCALE)


def q_lineitem_mart(spark, sf_dir):
    return lineitem_mart(spark, sf_dir)


def q_orders_mart(spark, sf_dir):
    """A sparse daily series (days without orders leave gaps in the calendar window)."""
    obs = assign_day(table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice"),
                     "o_orderdate", "dt")
    return build_mart(obs, roles=OR_ROLES, spec=OR_SPEC, exact_scale=SCALE, processed_at=None)


def q_events_mart(spark, sf_dir):
    return events_mart(spark, sf_dir)


def q_top_anomalies(spark, sf_dir):
    return reports.top_anomalies(lineitem_mart(spark, sf_dir), n=15, entity="l_returnflag",
                                 name="l_returnflag", value="qty_avg", norm="qty_norm_30d",
                                 anomaly="qty_anomaly")


def q_events_top_anomalies(spark, sf_dir):
    return reports.top_anomalies(events_mart(spark, sf_dir), n=15, entity="event_type",
                                 name="event_type", value="value_avg", norm="value_norm_30d",
                                 anomaly="value_anomaly")


def q_anomaly_counts(spark, sf_dir):
    return reports.anomaly_counts(lineitem_mart(spark, sf_dir), years=YEARS, threshold=5.0,
                                  name="l_returnflag", anomaly="qty_anomaly")


def q_climate(spark, sf_dir):
    return reports.climate(lineitem_mart(spark, sf_dir), group=("l_returnflag",), value="qty_avg",
                           low="qty_min", high="qty_max", wet="price_sum",
                           wet_threshold=WET_THRESHOLD, exact_scale=SCALE)


def q_monthly_pivot(spark, sf_dir):
    return reports.monthly_pivot(lineitem_mart(spark, sf_dir), entities=PIVOT_FLAGS,
                                 entity="l_returnflag", value="qty_avg", exact_scale=SCALE)


def q_year_over_year(spark, sf_dir):
    return reports.year_over_year(lineitem_mart(spark, sf_dir), entity_value="N",
                                  entity="l_returnflag", value="qty_avg", exact_scale=SCALE)


def q_overview(spark, sf_dir):
    return reports.overview(lineitem_mart(spark, sf_dir), entity="l_returnflag")


def q_sql_overview(spark, sf_dir):
    """The overview written in Spark SQL over a temporary view of the mart (SQL entry point)."""
    lineitem_mart(spark, sf_dir).createOrReplaceTempView("obsmart_lineitem_daily")
    return spark.sql("SELECT count(*) AS rows, count(DISTINCT l_returnflag) AS entities, "
                     "min(dt) AS first_day, max(dt) AS last_day FROM obsmart_lineitem_daily")


def q_serving_reload(spark, sf_dir):
    first = conform(lineitem_mart(spark, sf_dir), count_col="rows_count", load_ts=LOAD_TS_1)
    again = conform(lineitem_mart(spark, sf_dir, *RELOAD_PERIOD), count_col="rows_count",
                    load_ts=LOAD_TS_2)
    served = resolve(first.unionByName(again), keys=("l_returnflag", "dt"))
    return served.withColumn("loaded_at", to_ntz("loaded_at"))


def q_latest_version(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return resolve(orders, keys=("o_custkey",), version=("o_orderdate", "o_orderkey"))


def q_staging_checks(spark, sf_dir):
    return checks_of(events_hourly(spark, sf_dir))


def q_parsed_checks(spark, sf_dir):
    return checks_of(events_staging(spark, sf_dir))


def q_gate_preview(spark, sf_dir):
    return first_violations(q_staging_checks(spark, sf_dir), 50)


def _events_stats(spark, sf_dir, start, end):
    return mart_stats(events_mart(spark, sf_dir), start=start, end=end,
                      entity="event_type", count_col="hours_count", expected_count=24,
                      low="value_min", mid="value_avg", high="value_max")


def q_mart_stats(spark, sf_dir):
    return _events_stats(spark, sf_dir, *events_shape(spark, sf_dir)[:2])


def q_lineitem_mart_stats(spark, sf_dir):
    return mart_stats(lineitem_mart(spark, sf_dir), entity="l_returnflag", count_col="rows_count",
                      expected_count=8, low="qty_min", mid="qty_avg", high="qty_max")


def q_mart_checks(spark, sf_dir):
    start, end, types = events_shape(spark, sf_dir)
    return mart_violations(_events_stats(spark, sf_dir, start, end), n_entities=types, n_days=(end - start).days + 1)


def q_expected_grid(spark, sf_dir):
    types = table(spark, sf_dir, "events").select("event_type")
    return expected_grid(types, "event_type", *events_shape(spark, sf_dir)[:2])


def q_month_chunks(spark, sf_dir):
    span = table(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")).alias("s"),
                                              F.max(F.to_date("o_orderdate")).alias("e"))
    return span.select(F.inline(month_chunks_between("s", "e")))


def q_fetch_plan(spark, sf_dir):
    periods = (table(spark, sf_dir, "orders").groupBy("o_custkey")
               .agg(F.min(F.to_date("o_orderdate")).alias("s"), F.max(F.to_date("o_orderdate")).alias("e")))
    return fetch_plan(periods, "s", "e", ["o_totalprice"], entity="o_custkey", params=())


def q_triage(spark, sf_dir):
    """Responses of every kind: by day of the month modulo 7 there is none, a busy or broken server, a
    refusal, a cut-off body, an error body, or the payload itself."""
    n = F.dayofmonth("range_start") % 7
    status = F.when(n == 0, None).when(n == 1, 429).when(n == 2, 503).when(n == 3, 404).otherwise(200).cast("int")
    body = (F.when(n.isin(1, 2, 3), F.lit("no payload")).when(n == 4, F.expr("substring(body, 1, 20)"))
            .when(n == 5, F.lit('{"error": true, "reason": "closed"}')).otherwise(F.col("body")))
    landed = events_payloads(spark, sf_dir).withColumns({"status": status, "body": body})
    return triage(landed).select("event_type", "range", "status", "outcome", "reason")


def q_partition_inventory(spark, sf_dir):
    """Rows and parts of the newest 12 partitions (by name; every table is one)."""
    found = partition_inventory_of(spark, [f"{sf_dir}/{t}.parquet" for t in TABLES])
    return found.select("partition", "rows", "parts")


def queries():
    from obsmart.plans import catalog_layers

    return catalog_layers.queries() | {
        "unpivot_arrays": q_unpivot_arrays,
        "keep_last": q_keep_last,
        "clip_columns": q_clip_columns,
        "repair_counts": q_repair_counts,
        "enrich": q_enrich,
        "daily_rollup": q_daily_rollup,
        "lineitem_mart": q_lineitem_mart,
        "events_mart": q_events_mart,
        "orders_mart": q_orders_mart,
        "top_anomalies": q_top_anomalies,
        "events_top_anomalies": q_events_top_anomalies,
        "anomaly_counts": q_anomaly_counts,
        "climate": q_climate,
        "monthly_pivot": q_monthly_pivot,
        "year_over_year": q_year_over_year,
        "overview": q_overview,
        "sql_overview": q_sql_overview,
        "serving_reload": q_serving_reload,
        "latest_version": q_latest_version,
        "staging_checks": q_staging_checks,
        "parsed_checks": q_parsed_checks,
        "gate_preview": q_gate_preview,
        "mart_stats": q_mart_stats,
        "mart_checks": q_mart_checks,
        "lineitem_mart_stats": q_lineitem_mart_stats,
        "expected_grid": q_expected_grid,
        "month_chunks": q_month_chunks,
        "fetch_plan": q_fetch_plan,
        "triage": q_triage,
        "partition_inventory": q_partition_inventory,
    }


# --------------------------------------------------------------------------------------------
# Oracle SQL (DuckDB). Written from the semantics, not from the Spark plans above.
# --------------------------------------------------------------------------------------------

def _units(x: str, scale: int = SCALE) -> str:
    """A value with ``scale`` decimals as an integer count of 10^-scale units."""
    return f"CAST(round(({x}) * {10 ** scale}) AS BIGINT)"


def _hu(num: str, den: str) -> str:
    """HALF_UP(num / den) for integers, den > 0."""
    return (f"(CASE WHEN ({den}) > 0 THEN sign(CAST({num} AS HUGEINT)) * "
            f"((abs(CAST({num} AS HUGEINT)) * 2 + ({den})) // (CAST({den} AS HUGEINT) * 2)) END)")


def _exact_avg(x: str) -> str:
    """Exact sum (integer units) as a double, divided by the count: the unrounded average."""
    return f"(CAST(sum({_units(x)}) AS DOUBLE) / {10 ** SCALE}.0 / CAST(count({x}) AS DOUBLE))"


def _exact_sum(x: str) -> str:
    """Exact sum of values with ``SCALE`` decimals, as a double."""
    return f"(CAST(sum({_units(x)}) AS DOUBLE) / {10 ** SCALE}.0)"


def _avg_rounded(x: str, digits: int) -> str:
    """HALF_UP of the true average to ``digits`` decimals, in integer arithmetic."""
    s = f"sum({_units(x)})"
    if digits >= SCALE:
        num, den = f"{s} * {10 ** (digits - SCALE)}", f"count({x})"
    else:
        num, den = s, f"count({x}) * {10 ** (SCALE - digits)}"
    return f"(CAST({_hu(num, den)} AS DOUBLE) / {10 ** digits}.0)"


def _r(x: str, digits: int = 2) -> str:
    """Rounding of an inexact double (no exact ties); + 0.0 turns -0.0 into 0.0."""
    return f"(round({x}, {digits}) + 0.0)"


def _mart_sql(src: str, entity: str, count_col: str, aggs, value: str, norm: str, anomaly: str,
              where: str = "", suffix: str = "") -> str:
    """CTE text: daily rollup of ``src`` (columns dt, entity, metrics) + trailing norm, as ``mart``
    (every name with ``suffix``)."""
    daily_cols = [f"count(*) AS {count_col}"]
    final_cols = ["dt", entity, count_col]
    for out, fn, col in aggs:
        if fn in ("min", "max"):
            daily_cols.append(f"{fn}({col}) AS {out}")
            final_cols.append(f"{_r(out)} AS {out}")
        elif fn == "sum":
            daily_cols.append(f"{_exact_sum(col)} AS {out}")
            final_cols.append(f"{_r(out)} AS {out}")
        else:
            daily_cols.append(f"{_exact_avg(col)} AS {out}")
            daily_cols.append(f"{_avg_rounded(col, 2)} AS {out}__r")
            final_cols.append(f"{out}__r AS {out}")
    final_cols += [f"{_r(norm)} AS {norm}", f"{_r(f'{value} - {norm}')} AS {anomaly}"]
    return f"""
daily{suffix} AS (SELECT dt, {entity}, {", ".join(daily_cols)} FROM {src} GROUP BY dt, {entity}),
normed{suffix} AS (
  SELECT *, CASE WHEN count({value}) OVER w >= 25 THEN avg({value}) OVER w END AS {norm}
  FROM daily{suffix}
  WINDOW w AS (PARTITION BY {entity} ORDER BY date_diff('day', DATE '1970-01-01', dt)
               RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING)),
mart{suffix} AS (SELECT {", ".join(final_cols)} FROM normed{suffix} {where})"""


_EV_HOURS = """
ev_h AS (SELECT event_type, date_trunc('hour', ts) AS hr, arg_max(value, event_id) AS value
         FROM events GROUP BY event_type, date_trunc('hour', ts)),
ev_days AS (SELECT DISTINCT event_type, CAST(hr AS DATE) AS dt FROM ev_h),
ev_grid AS (SELECT event_type, dt, unnest(generate_series(CAST(dt AS TIMESTAMP),
                   CAST(dt AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS ts FROM ev_days),
ev_rows AS (SELECT g.event_type, g.dt, g.ts, h.value FROM ev_grid g
            LEFT JOIN ev_h h ON g.event_type = h.event_type AND g.ts = h.hr)"""

_LI_SRC = """
li AS (SELECT l_returnflag, CAST(l_shipdate AS DATE) AS dt, l_quantity, l_extendedprice,
              l_discount, l_tax FROM lineitem)"""


def _ev_mart() -> str:
    return "WITH " + _EV_HOURS.strip() + "," + _mart_sql(
        "ev_rows", "event_type", "hours_count", EV_SPEC.aggs, "value_avg", "value_norm_30d",
        "value_anomaly")


def _li_mart(where: str = "", src: str = "li") -> str:
    return "WITH " + _LI_SRC.strip() + "," + _mart_sql(
        src, "l_returnflag", "rows_count", LI_SPEC.aggs, "qty_avg", "qty_norm_30d",
        "qty_anomaly", where)


_SPAN = f"""span AS (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) + {EMPTY_TAIL_DAYS} AS e
          FROM events)"""


def _checks_sql(src_cte: str, src: str) -> str:
    lo, hi = EVENTS_RANGES["value"]
    return f"""WITH {src_cte.strip()}, {_SPAN},
s AS (SELECT * FROM {src} WHERE dt BETWEEN (SELECT s FROM span) AND (SELECT e FROM span)),
l1 AS (SELECT dt, event_type, ts, count(*) AS n,
              count(*) FILTER (WHERE value IS NULL OR isnan(value)) AS nn,
              count(*) FILTER (WHERE NOT isnan(value) AND (value < {lo} OR value > {hi})) AS oor
       FROM s GROUP BY dt, event_type, ts),
l2 AS (SELECT dt, event_type, sum(n) AS nrows, sum(n - 1) AS dups, count(ts) AS hours,
              coalesce(sum(n) FILTER (WHERE ts IS NULL), 0) AS null_ts, sum(nn) AS nn, sum(oor) AS oor
       FROM l1 GROUP BY dt, event_type),
l3 AS (SELECT dt, sum(nrows) AS nrows, sum(dups) AS dups,
              sum(nrows) FILTER (WHERE event_type IS NULL) AS null_entity, sum(null_ts) AS null_ts,
              sum(nn) AS nn, sum(oor) AS oor FROM l2 GROUP BY dt),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS dt FROM span),
types AS (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL),
v AS (
  SELECT dt, 'empty' AS rule, NULL AS field, NULL AS entity, 0.0 AS observed, 1.0 AS limit_low,
         NULL AS limit_high FROM days WHERE dt NOT IN (SELECT dt FROM l3)
  UNION ALL SELECT dt, 'null_key', 'event_type', NULL, null_entity, NULL, 0.0 FROM l3 WHERE null_entity > 0
  UNION ALL SELECT dt, 'null_key', 'ts', NULL, null_ts, NULL, 0.0 FROM l3 WHERE null_ts > 0
  UNION ALL SELECT dt, 'duplicates', NULL, NULL, dups, NULL, 0.0 FROM l3 WHERE dups > 0
  UNION ALL SELECT dt, 'null_share', 'value', NULL, nn / nrows, NULL, 0.05 FROM l3 WHERE nn / nrows > 0.05
  UNION ALL SELECT dt, 'out_of_range', 'value', NULL, oor, {lo}, {hi} FROM l3 WHERE oor > 0
  UNION ALL SELECT dt, 'incomplete_hours', 'ts', event_type, hours, 24.0, 24.0 FROM l2
            WHERE event_type IS NOT NULL AND hours <> 24
  UNION ALL SELECT l3.dt, 'missing_entity', 'event_type', t.event_type, 0.0, 1.0, NULL
            FROM l3 JOIN types t ON TRUE
            WHERE NOT EXISTS (SELECT 1 FROM l2 WHERE l2.dt = l3.dt AND l2.event_type = t.event_type))
SELECT 'staging' AS layer, CAST(dt AS DATE) AS dt, rule, CAST(field AS VARCHAR) AS field,
       CAST(entity AS VARCHAR) AS entity, CAST(observed AS DOUBLE) AS observed,
       CAST(limit_low AS DOUBLE) AS limit_low, CAST(limit_high AS DOUBLE) AS limit_high FROM v"""


def _ev_stats() -> str:
    return _ev_mart() + f""", {_SPAN},
st AS (SELECT count(*) AS rows, count(DISTINCT event_type) AS entities, count(DISTINCT dt) AS days,
              count(*) FILTER (WHERE hours_count <> 24) AS incomplete_days,
              count(*) FILTER (WHERE NOT (value_min <= value_avg AND value_avg <= value_max)) AS bad_order,
              count(*) FILTER (WHERE value_avg IS NULL OR isnan(value_avg)) AS nan_avg
       FROM mart WHERE dt BETWEEN (SELECT s FROM span) AND (SELECT e FROM span))"""


def oracle_reports() -> dict[str, str]:
    """The reports over the mart of the line items."""
    sql = {}
    sql["top_anomalies"] = _li_mart() + """
SELECT dt, l_returnflag, qty_avg, qty_norm_30d, qty_anomaly,
       CASE WHEN qty_anomaly > 0 THEN 'тепло' ELSE 'холод' END AS kind
FROM mart WHERE qty_anomaly IS NOT NULL
ORDER BY abs(qty_anomaly) DESC, dt, l_returnflag LIMIT 15"""
    years = ", ".join(
        f"count(*) FILTER (WHERE abs(qty_anomaly) > 5 AND year(dt) = {y}) AS y{y}" for y in YEARS)
    sql["anomaly_counts"] = _li_mart() + f"""
SELECT l_returnflag, {years}, count(*) FILTER (WHERE abs(qty_anomaly) > 5) AS total,
       {_r('stddev_pop(qty_anomaly)')} AS anomaly_stddev
FROM mart GROUP BY l_returnflag"""
    sql["climate"] = _li_mart() + f"""
SELECT l_returnflag, {_avg_rounded('qty_avg', 1)} AS avg_temp, min(qty_min) AS abs_min,
       max(qty_max) AS abs_max,
       arg_min(dt, {{'v': qty_min, 'd': dt}}) FILTER (WHERE qty_min IS NOT NULL) AS coldest_day,
       arg_max(dt, {{'v': qty_max, 'd': -date_diff('day', DATE '1970-01-01', dt)}})
           FILTER (WHERE qty_max IS NOT NULL) AS hottest_day,
       CAST({_hu(f"sum({_units('price_sum')}) * 36525", f"count(DISTINCT dt) * {10 ** (SCALE + 2)}")}
            AS DOUBLE) AS precip_per_year_mm,
       count(*) FILTER (WHERE price_sum >= {WET_THRESHOLD}) AS rainy_days
FROM mart GROUP BY l_returnflag"""
    pivot = ", ".join(
        f"{_avg_rounded(f'CASE WHEN l_returnflag = {chr(39)}{k}{chr(39)} THEN qty_avg END', 1)} AS {a}"
        for k, a in PIVOT_FLAGS.items())
    sql["monthly_pivot"] = _li_mart() + f"""
SELECT CAST(date_trunc('month', dt) AS DATE) AS month, {pivot}
FROM mart GROUP BY CAST(date_trunc('month', dt) AS DATE)"""
    units = _hu(f"sum({_units('qty_avg')})", f"count(qty_avg) * {10 ** (SCALE - 1)}")
    sql["year_over_year"] = _li_mart() + f""",
m AS (SELECT CAST(month(dt) AS INTEGER) AS month_num, CAST(year(dt) AS INTEGER) AS year, {units} AS u
      FROM mart WHERE l_returnflag = 'N' GROUP BY month(dt), year(dt))
SELECT month_num, year, CAST(u AS DOUBLE) / 10.0 AS avg_temp,
       CAST(u - lag(u) OVER (PARTITION BY month_num ORDER BY year) AS DOUBLE) / 10.0 AS diff_vs_prev_year
FROM m"""
    sql["overview"] = _li_mart() + """
SELECT count(*) AS rows, count(DISTINCT l_returnflag) AS entities, min(dt) AS first_day,
       max(dt) AS last_day FROM mart"""
    return sql


def oracle_sql() -> dict[str, str]:
    from obsmart.plans import catalog_layers

    rs, re_ = RELOAD_PERIOD
    sql = catalog_layers.oracle_sql()
    sql["partition_inventory"] = " UNION ALL ".join(       # a table is one file
        f"SELECT '{t}.parquet' AS partition, count(*) AS rows, CAST(1 AS BIGINT) AS parts FROM {t}" for t in TABLES
    ) + " ORDER BY partition DESC LIMIT 12"
    sql["unpivot_arrays"] = "WITH " + _EV_HOURS.strip() + "\nSELECT event_type, ts, value FROM ev_rows"
    sql["keep_last"] = """
SELECT event_type, ts, event_id, value FROM (
  SELECT event_type, date_trunc('hour', ts) AS ts, event_id, value,
         row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn
  FROM events) WHERE rn = 1"""
    sql["clip_columns"] = """
SELECT event_id, event_type,
       CASE WHEN value < 0 THEN 0.0 WHEN value > 100 THEN 100.0 ELSE value END AS value FROM events"""
    sql["repair_counts"] = "SELECT count(*) FILTER (WHERE value < 0 OR value > 100) AS value FROM events"
    sql["enrich"] = """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderdate, c.c_name, c.c_nationkey, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""
    daily_cols = ", ".join(
        f"{fn}({col}) AS {out}" if fn in ("min", "max") else
        f"{_exact_sum(col)} AS {out}" if fn == "sum" else f"{_exact_avg(col)} AS {out}"
        for out, fn, col in LI_SPEC.aggs)
    sql["daily_rollup"] = ("WITH " + _LI_SRC.strip() +
                           f"\nSELECT dt, l_returnflag, count(*) AS rows_count, {daily_cols} "
                           "FROM li GROUP BY dt, l_returnflag")
    sql["lineitem_mart"] = _li_mart() + "\nSELECT * FROM mart"
    sql["events_mart"] = _ev_mart() + "\nSELECT * FROM mart"
    sql["orders_mart"] = ("WITH ord AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS dt, "
                          "o_totalprice FROM orders)," + _mart_sql(
                              "ord", "o_orderpriority", "orders_count", OR_SPEC.aggs, "price_avg",
                              "price_norm_30d", "price_anomaly") + "\nSELECT * FROM mart")
    sql |= oracle_reports()
    sql["events_top_anomalies"] = _ev_mart() + """
SELECT dt, event_type, value_avg, value_norm_30d, value_anomaly,
       CASE WHEN value_anomaly > 0 THEN 'тепло' ELSE 'холод' END AS kind
FROM mart WHERE value_anomaly IS NOT NULL
ORDER BY abs(value_anomaly) DESC, dt, event_type LIMIT 15"""
    sql["sql_overview"] = sql["overview"]
    sql["serving_reload"] = _li_mart() + f"""
SELECT * REPLACE (CAST(rows_count AS INTEGER) AS rows_count), CASE WHEN dt BETWEEN DATE '{rs}' AND DATE '{re_}'
               THEN TIMESTAMP '{LOAD_TS_2:%Y-%m-%d %H:%M:%S}'
               ELSE TIMESTAMP '{LOAD_TS_1:%Y-%m-%d %H:%M:%S}' END AS loaded_at,
       CAST(year(dt) * 100 + month(dt) AS INTEGER) AS month
FROM mart"""
    sql["latest_version"] = """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1"""
    sql["staging_checks"] = _checks_sql(
        "h AS (SELECT event_type, date_trunc('hour', ts) AS ts, CAST(ts AS DATE) AS dt, value FROM events)",
        "h")
    sql["parsed_checks"] = _checks_sql(_EV_HOURS, "ev_rows")
    sql["gate_preview"] = f"""SELECT * FROM ({sql["staging_checks"]})
ORDER BY dt NULLS FIRST, rule NULLS FIRST, field NULLS FIRST, entity NULLS FIRST LIMIT 50"""
    sql["mart_stats"] = _ev_stats() + "\nSELECT * FROM st"
    sql["mart_checks"] = _ev_stats() + """,
n AS (SELECT CAST(e - s + 1 AS DOUBLE) AS n_days, (SELECT CAST(count(DISTINCT event_type) AS DOUBLE) FROM events) AS t FROM span),
c AS (
  SELECT 'rows' AS rule, rows AS observed, t * n_days AS lo, t * n_days AS hi FROM st, n
  UNION ALL SELECT 'entities', entities, t, t FROM st, n
  UNION ALL SELECT 'days', days, n_days, n_days FROM st, n
  UNION ALL SELECT 'incomplete_days', incomplete_days, 0.0, 0.0 FROM st
  UNION ALL SELECT 'bad_order', bad_order, 0.0, 0.0 FROM st
  UNION ALL SELECT 'nan_avg', nan_avg, 0.0, 0.0 FROM st)
SELECT 'mart' AS layer, CAST(NULL AS DATE) AS dt, rule, CAST(NULL AS VARCHAR) AS field,
       CAST(NULL AS VARCHAR) AS entity, CAST(observed AS DOUBLE) AS observed,
       CAST(lo AS DOUBLE) AS limit_low, CAST(hi AS DOUBLE) AS limit_high
FROM c WHERE observed < lo OR observed > hi"""
    sql["lineitem_mart_stats"] = _li_mart() + """
SELECT count(*) AS rows, count(DISTINCT l_returnflag) AS entities, count(DISTINCT dt) AS days,
       count(*) FILTER (WHERE rows_count <> 8) AS incomplete_days,
       count(*) FILTER (WHERE NOT (qty_min <= qty_avg AND qty_avg <= qty_max)) AS bad_order,
       count(*) FILTER (WHERE qty_avg IS NULL OR isnan(qty_avg)) AS nan_avg
FROM mart"""
    sql["expected_grid"] = f"""WITH {_SPAN},
d AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS dt FROM span)
SELECT t.event_type, d.dt
FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL) t, d"""
    chunks = """
SELECT CAST(greatest(m, s) AS DATE) AS chunk_start, CAST(least(last_day(m), e) AS DATE) AS chunk_end{extra}
FROM (SELECT *, CAST(unnest(generate_series(CAST(date_trunc('month', s) AS DATE),
                                            CAST(date_trunc('month', e) AS DATE), INTERVAL 1 MONTH)) AS DATE) AS m
      FROM p)"""
    sql["month_chunks"] = ("WITH p AS (SELECT min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e FROM orders)"
                           + chunks.format(extra=""))
    sql["fetch_plan"] = ("WITH p AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS s, "
                         "max(CAST(o_orderdate AS DATE)) AS e FROM orders GROUP BY o_custkey)"
                         + chunks.format(extra=", o_custkey, 'o_totalprice' AS variables, 'UTC' AS timezone"))
    sql["triage"] = "WITH " + _EV_HOURS.strip() + """
SELECT event_type, strftime(dt, '%Y-%m-%d') || '_' || strftime(dt, '%Y-%m-%d') AS range,
       CAST(CASE n WHEN 0 THEN NULL WHEN 1 THEN 429 WHEN 2 THEN 503 WHEN 3 THEN 404 ELSE 200 END AS INTEGER) AS status,
       CASE WHEN n <= 2 THEN 'retry' WHEN n <= 5 THEN 'fatal' ELSE 'good' END AS outcome,
       CASE n WHEN 0 THEN 'no response' WHEN 1 THEN '429: no payload' WHEN 2 THEN '503: no payload'
              WHEN 3 THEN '404: no payload' WHEN 4 THEN 'malformed body' WHEN 5 THEN 'closed' END AS reason
FROM (SELECT DISTINCT event_type, dt, extract(day FROM dt) % 7 AS n FROM ev_days)"""
    return sql
