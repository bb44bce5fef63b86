"""Registered queries of the layers: landings, requests, propagation, checks that fire, reports over
the latest versions. Each with its SQL oracle, like ``plans.catalog``, whose data roles they share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmart.functions.numeric import exact_avg_rounded, exact_stddev
from obsmart.functions.temporal import year_month
from obsmart.functions.text import readable_size
from obsmart.operators.calendar import month_chunks_between
from obsmart.operators.distinct import distinct_count, distinct_states, merged_states
from obsmart.operators.normalize import assign_day, clean, to_ntz, unpivot_arrays
from obsmart.operators.quality import mart_stats, mart_violations
from obsmart.operators.rollup import daily
from obsmart.operators.versions import conform
from obsmart.plans import catalog as base
from obsmart.plans import reports
from obsmart.plans.mart import build_mart
from obsmart.plans.propagate import changed_days, rebuilt_rows
from obsmart.plans.serving import resolve, version_stats
from obsmart.schemas import DailySpec, Roles
from obsmart.sources.raw import fetch_plan, land_payloads
from obsmart.sources.requests import reconcile, tries_of

LATE_TYPES = ("click", "view")          # types whose months land once more, with other values
ATTEMPTS = 3
RERUN_YEAR = 1997                       # the year that is loaded again with corrected quantities
CORRECTED_DAYS = ("1997-03-03", "1997-03-17")       # days with a corrected row
PLAIN_SPEC = DailySpec(
    aggs=(("root_min", "min", "root"), ("root_max", "max", "root"), ("root_avg", "avg", "root"), ("root_sum", "sum", "root")),
    count_col="rows_count", value="root_avg", norm="root_norm_30d", anomaly="root_anomaly")


# --------------------------------------------------------------------------------------------
# Landings and requests
# --------------------------------------------------------------------------------------------

def q_overlapping_ranges(spark, sf_dir) -> DataFrame:
    """Events landed by month, then every second day again (values doubled), then the months of two
    types again (values plus 1000): every hour has the value of its last landing."""
    ev = base.table(spark, sf_dir, "events")
    landings = [(ev, "month"),
                (ev.where(F.dayofmonth("ts") % 2 == 0).withColumn("value", F.col("value") * 2), "day"),
                (ev.where(F.col("event_type").isin(*LATE_TYPES)).withColumn("value", F.col("value") + 1000), "month")]
    raw = None
    for n, (rows, period) in enumerate(landings, 1):
        p = land_payloads(rows, entity="event_type", ts="ts", metrics={"value": "value"}, order=["event_id"], period=period)
        p = p.withColumn("landing", F.lit(n).cast("long"))
        raw = p if raw is None else raw.unionByName(p)
    rows = unpivot_arrays(raw, {"value": "value"}, keep=("landing", "range_end", "event_type"), ts="ts")
    rows = clean(assign_day(rows, "ts", "dt"), keys=("event_type", "ts"))
    return rows.select("event_type", to_ntz("ts").alias("ts"), "value", "landing")


def q_request_states(spark, sf_dir) -> DataFrame:
    """A request for every customer and month between the first and the last order; every order is a
    response to the request of its month, good, throttled, broken, refused or none."""
    orders = base.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("d"))
    periods = orders.groupBy("o_custkey").agg(F.min("d").alias("s"), F.max("d").alias("e"))
    plan = fetch_plan(periods, "s", "e", ["o_totalprice"], entity="o_custkey", params=())
    chunks = periods.select("o_custkey", F.inline(month_chunks_between("s", "e")))
    month = orders.join(chunks.withColumnsRenamed({"chunk_start": "range_start", "chunk_end": "range_end"}), "o_custkey").where(
        F.trunc("d", "MM") == F.trunc("range_start", "MM"))
    n = F.col("o_orderkey") % 9
    responses = month.withColumns({
        "status": F.when(n <= 1, 200).when(n <= 4, 429).when(n <= 6, 503).when(n == 7, 404).otherwise(None).cast("int"),
        "body": F.when(n <= 1, F.lit('{"hourly": {}}')).otherwise(F.concat(F.lit("order "), F.col("o_orderkey")))})
    states = reconcile(plan, tries_of(responses, entity="o_custkey", seq="o_orderkey"), entity="o_custkey", max_attempts=ATTEMPTS)
    return states.select("o_custkey", "chunk_start", "chunk_end", "attempts", "last_reason", "state")


def q_readable_sizes(spark, sf_dir) -> DataFrame:
    """Rows and bytes of text per source, as the partition report writes sizes."""
    docs = base.table(spark, sf_dir, "documents")
    size = F.sum(F.octet_length("text"))
    return (docs.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), size.alias("bytes"))
            .withColumn("size", readable_size("bytes")))


# --------------------------------------------------------------------------------------------
# Re-runs: what a correction reaches, and reports over the latest versions
# --------------------------------------------------------------------------------------------

def _corrected_rows(li: DataFrame) -> DataFrame:
    """Line items with another quantity on a few days, for one flag."""
    hit = F.col("dt").isin(*[F.lit(d).cast("date") for d in CORRECTED_DAYS]) & (F.col("l_returnflag") == "N")
    return li.withColumn("l_quantity", F.when(hit, F.col("l_quantity") + 7).otherwise(F.col("l_quantity")))


def q_changed_norms(spark, sf_dir) -> DataFrame:
    """The mart rows that the correction of two days of one flag reaches, rebuilt from daily rows."""
    li = base.lineitem_obs(spark, sf_dir)
    how = dict(entity="l_returnflag", day="dt", aggs=base.LI_SPEC.aggs, count_col="rows_count", exact_scale=base.SCALE)
    old, new = daily(li, keep_state=True, **how), daily(_corrected_rows(li), keep_state=True, **how)
    changed = changed_days(old, new, entity="l_returnflag")
    return rebuilt_rows(new, changed, roles=base.LI_ROLES, spec=base.LI_SPEC, exact_scale=base.SCALE, processed_at=None)


def served(spark, sf_dir) -> DataFrame:
    """Latest versions of two loads: the whole mart, then one year with corrected quantities."""
    li = base.lineitem_obs(spark, sf_dir)
    again = F.year("dt") == RERUN_YEAR
    fixed = li.withColumn("l_quantity", F.when(again & (F.col("l_quantity") > 25), F.col("l_quantity") - 1).otherwise(F.col("l_quantity")))
    how = dict(roles=base.LI_ROLES, spec=base.LI_SPEC, exact_scale=base.SCALE, processed_at=None)
    first = conform(build_mart(li, **how), count_col="rows_count", load_ts=base.LOAD_TS_1)
    second = conform(build_mart(fixed, start=f"{RERUN_YEAR}-01-01", end=f"{RERUN_YEAR}-12-31", **how), count_col="rows_count", load_ts=base.LOAD_TS_2)
    return resolve(first.unionByName(second), keys=("l_returnflag", "dt"))


def q_version_stats(spark, sf_dir) -> DataFrame:
    """Orders as versions of their customer and month: rows, keys and superseded rows a month."""
    orders = base.table(spark, sf_dir, "orders").select("o_custkey", year_month(F.to_date("o_orderdate")).alias("month"))
    return version_stats(orders, keys=("o_custkey",))


def q_distinct_merged(spark, sf_dir) -> DataFrame:
    """Distinct parts, suppliers, orders and days of every month, every year and all time: states are
    made per month, and the longer periods come from these alone (year as yyyy00, all time as 0)."""
    lineitem = base.table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    counts = []
    for name, number in (("parts", F.col("l_partkey")), ("suppliers", F.col("l_suppkey")),
                         ("orders", F.col("l_orderkey")), ("days", F.unix_date(day))):
        months = distinct_states(lineitem, year_month(day), number)
        years = merged_states(months, F.col("period") - F.col("period") % 100)
        ever = merged_states(years, F.lit(0))
        counts.append(distinct_count(months.unionByName(years).unionByName(ever), name=name))
    return reduce(lambda a, b: a.join(b, "period"), counts)


def q_served_overview(spark, sf_dir) -> DataFrame:
    return reports.overview(served(spark, sf_dir), entity="l_returnflag")


def q_served_climate(spark, sf_dir) -> DataFrame:
    return reports.climate(served(spark, sf_dir), group=("l_returnflag",), value="qty_avg", low="qty_min", high="qty_max",
                           wet="price_sum", wet_threshold=base.WET_THRESHOLD, exact_scale=base.SCALE)


def q_served_monthly_pivot(spark, sf_dir) -> DataFrame:
    return reports.monthly_pivot(served(spark, sf_dir), entities=base.PIVOT_FLAGS, entity="l_returnflag", value="qty_avg", exact_scale=base.SCALE)


def q_served_year_over_year(spark, sf_dir) -> DataFrame:
    return reports.year_over_year(served(spark, sf_dir), entity_value="N", entity="l_returnflag", value="qty_avg", exact_scale=base.SCALE)


def q_served_top_anomalies(spark, sf_dir) -> DataFrame:
    return reports.top_anomalies(served(spark, sf_dir), n=15, entity="l_returnflag", name="l_returnflag", value="qty_avg",
                                 norm="qty_norm_30d", anomaly="qty_anomaly")


def q_served_anomaly_counts(spark, sf_dir) -> DataFrame:
    return reports.anomaly_counts(served(spark, sf_dir), years=base.YEARS, threshold=5.0, name="l_returnflag", anomaly="qty_anomaly")


def q_plain_mart(spark, sf_dir) -> DataFrame:
    """The mart in plain double arithmetic, as the chain computes it, on values with all digits."""
    li = base.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", F.sqrt("l_extendedprice").alias("root"))
    return build_mart(assign_day(li, "l_shipdate", "dt"), roles=Roles(entity="l_returnflag", ts="l_shipdate", day="dt", metrics=("root",)),
                      spec=PLAIN_SPEC, processed_at=None)


def q_half_even(spark, sf_dir) -> DataFrame:
    """Daily averages rounded half to even, exactly: beside the half-up ones, where both differ."""
    li = base.lineitem_obs(spark, sf_dir)
    up, even = (exact_avg_rounded("l_extendedprice", base.SCALE, 2, mode) for mode in ("half_up", "half_even"))
    found = li.groupBy("dt", "l_returnflag").agg(F.count("l_extendedprice").alias("n"), up.alias("half_up"), even.alias("half_even"))
    return found.where("half_up <> half_even OR n % 2 = 1")


def q_exact_spread(spark, sf_dir) -> DataFrame:
    """Exact standard deviations of prices and quantities per flag and line status."""
    li = base.table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(*[
        F.round(exact_stddev(c, base.SCALE), 6).alias(name)
        for c, name in (("l_extendedprice", "price_spread"), ("l_quantity", "qty_spread"), ("l_discount", "disc_spread"))])


# --------------------------------------------------------------------------------------------
# Checks that fire: every rule has at least one violation
# --------------------------------------------------------------------------------------------

def dirty_hours(spark, sf_dir) -> DataFrame:
    """Events by hour with missing types and times, missing, NaN and too large values, and a type that is
    absent on some days."""
    h = base.events_hourly(spark, sf_dir)
    k = F.col("event_id")
    h = h.where(~((F.col("event_type") == LATE_TYPES[0]) & (F.dayofmonth("dt") % 5 == 0)))
    return h.withColumns({
        "event_type": F.when(k % 97 != 0, F.col("event_type")), "ts": F.when(k % 89 != 0, F.col("ts")),
        "value": F.when(k % 11 == 0, F.lit(float("nan"))).when(k % 13 == 0, None)
                  .when(k % 17 == 0, F.col("value") + 1000).otherwise(F.col("value"))})


def q_dirty_checks(spark, sf_dir) -> DataFrame:
    return base.checks_of(dirty_hours(spark, sf_dir), metrics=("value", "weight"))


def q_dirty_clean(spark, sf_dir) -> DataFrame:
    """The dirty hours cleaned: rows without a key dropped, the last of every key kept, values clipped."""
    rows = clean(dirty_hours(spark, sf_dir), keys=("event_type", "ts"), order=["event_id"], percent_columns=("value",))
    return rows.select("event_type", "ts", "event_id", F.nanvl("value", F.lit(None).cast("double")).alias("value"))


def q_dirty_mart_checks(spark, sf_dir) -> DataFrame:
    """The checks of a mart whose averages are missing, not a number or out of order on some days."""
    start, end, types = base.events_shape(spark, sf_dir)
    d = F.dayofmonth("dt")
    mart = base.events_mart(spark, sf_dir).where(F.col("event_type") != LATE_TYPES[1])
    mart = mart.withColumn("value_avg", F.when(d % 7 == 0, F.lit(None)).when(d % 7 == 1, F.lit(float("nan")))
                           .when(d % 7 == 2, F.col("value_max") + 1).otherwise(F.col("value_avg")))
    stats = mart_stats(mart, start=start, end=end, entity="event_type", count_col="hours_count", expected_count=23,
                       low="value_min", mid="value_avg", high="value_max")
    return mart_violations(stats, n_entities=types, n_days=(end - start).days + 1)


def queries():
    return {name[2:]: f for name, f in globals().items() if name.startswith("q_")}


# --------------------------------------------------------------------------------------------
# Oracle SQL
# --------------------------------------------------------------------------------------------

def _served_mart() -> str:
    """``mart``: one year from the corrected source, all else from the first load."""
    li = base.LI_SPEC
    own = ("l_returnflag", "rows_count", li.aggs, "qty_avg", "qty_norm_30d", "qty_anomaly")
    fixed = f"""
li2 AS (SELECT * REPLACE (CASE WHEN year(dt) = {RERUN_YEAR} AND l_quantity > 25 THEN l_quantity - 1 ELSE l_quantity END AS l_quantity) FROM li)"""
    return ("WITH " + base._LI_SRC.strip() + "," + fixed + "," + base._mart_sql("li", *own, suffix="1") + ","
            + base._mart_sql("li2", *own, suffix="2") + f""",
mart AS (SELECT * FROM mart1 WHERE year(dt) <> {RERUN_YEAR} UNION ALL SELECT * FROM mart2 WHERE year(dt) = {RERUN_YEAR})""")


def _over_served(report: str) -> str:
    """The oracle of a report over the mart, put over the served mart."""
    return report.replace(base._li_mart(), _served_mart(), 1)


_DIRTY = f"""dh AS (
  SELECT CASE WHEN event_id % 97 <> 0 THEN event_type END AS event_type,
         CASE WHEN event_id % 89 <> 0 THEN date_trunc('hour', ts) END AS ts, CAST(ts AS DATE) AS dt,
         CASE WHEN event_id % 11 = 0 THEN CAST('nan' AS DOUBLE) WHEN event_id % 13 = 0 THEN NULL
              WHEN event_id % 17 = 0 THEN value + 1000 ELSE value END AS value, event_id
  FROM events WHERE NOT (event_type = '{LATE_TYPES[0]}' AND extract(day FROM ts) % 5 = 0))"""


def oracle_sql() -> dict[str, str]:
    sql = {}
    late = ", ".join(f"'{t}'" for t in LATE_TYPES)
    sql["overlapping_ranges"] = f"""
WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hr, arg_max(value, event_id) AS value
           FROM events GROUP BY event_type, date_trunc('hour', ts)),
months AS (SELECT DISTINCT event_type, CAST(date_trunc('month', hr) AS DATE) AS m FROM h),
grid AS (SELECT event_type, unnest(generate_series(CAST(m AS TIMESTAMP), CAST(m + INTERVAL 1 MONTH AS TIMESTAMP) - INTERVAL 1 HOUR,
                                                   INTERVAL 1 HOUR)) AS ts FROM months),
days AS (SELECT DISTINCT event_type, CAST(hr AS DATE) AS d FROM h),
judged AS (
  SELECT g.event_type, g.ts, h.value,
         CASE WHEN g.event_type IN ({late}) THEN 3 WHEN d.d IS NOT NULL AND extract(day FROM g.ts) % 2 = 0 THEN 2 ELSE 1 END AS landing
  FROM grid g LEFT JOIN h ON g.event_type = h.event_type AND g.ts = h.hr
  LEFT JOIN days d ON g.event_type = d.event_type AND CAST(g.ts AS DATE) = d.d)
SELECT event_type, ts, CASE landing WHEN 3 THEN value + 1000 WHEN 2 THEN value * 2 ELSE value END AS value,
       CAST(landing AS BIGINT) AS landing FROM judged"""
    sql["request_states"] = f"""
WITH p AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e FROM orders GROUP BY o_custkey),
plan AS (SELECT o_custkey, m, CAST(greatest(m, s) AS DATE) AS chunk_start, CAST(least(last_day(m), e) AS DATE) AS chunk_end
         FROM (SELECT *, CAST(unnest(generate_series(CAST(date_trunc('month', s) AS DATE),
                                     CAST(date_trunc('month', e) AS DATE), INTERVAL 1 MONTH)) AS DATE) AS m FROM p)),
said AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS attempts,
                count(*) FILTER (WHERE o_orderkey % 9 <= 1) AS good, count(*) FILTER (WHERE o_orderkey % 9 = 7) AS fatal,
                max(o_orderkey) AS last_key FROM orders GROUP BY ALL)
SELECT plan.o_custkey, chunk_start, chunk_end, coalesce(attempts, 0) AS attempts,
       CASE WHEN last_key % 9 <= 1 THEN NULL WHEN last_key % 9 <= 4 THEN '429: order ' || last_key
            WHEN last_key % 9 <= 6 THEN '503: order ' || last_key WHEN last_key % 9 = 7 THEN '404: order ' || last_key
            WHEN last_key IS NOT NULL THEN 'no response' END AS last_reason,
       CASE WHEN good > 0 THEN 'done' WHEN fatal > 0 THEN 'fatal' WHEN attempts >= {ATTEMPTS} THEN 'given_up' ELSE 'open' END AS state
FROM plan LEFT JOIN said ON plan.o_custkey = said.o_custkey AND plan.m = said.m"""
    sql["readable_sizes"] = """
SELECT source, count(*) AS rows, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
       CASE WHEN sum(strlen(text)) >= 1073741824 THEN printf('%.2f GiB', sum(strlen(text)) / 1073741824.0)
            WHEN sum(strlen(text)) >= 1048576 THEN printf('%.2f MiB', sum(strlen(text)) / 1048576.0)
            WHEN sum(strlen(text)) >= 1024 THEN printf('%.2f KiB', sum(strlen(text)) / 1024.0)
            ELSE printf('%.2f B', CAST(sum(strlen(text)) AS DOUBLE)) END AS size
FROM documents GROUP BY source"""
    sql["distinct_merged"] = """
WITH l AS (SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS m, CAST(l_shipdate AS DATE) AS dt, * FROM lineitem),
p AS (SELECT m AS period, * FROM l UNION ALL SELECT m - m % 100, * FROM l UNION ALL SELECT 0, * FROM l)
SELECT period, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
       count(DISTINCT l_orderkey) AS orders, count(DISTINCT dt) AS days FROM p GROUP BY period"""
    sql["version_stats"] = """
WITH k AS (SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month, o_custkey, count(*) AS n FROM orders GROUP BY ALL)
SELECT month, CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, CAST(sum(n - 1) AS BIGINT) AS superseded FROM k GROUP BY month"""
    days = ", ".join(f"DATE '{d}'" for d in CORRECTED_DAYS)
    own = ("l_returnflag", "rows_count", base.LI_SPEC.aggs, "qty_avg", "qty_norm_30d", "qty_anomaly")
    sql["changed_norms"] = ("WITH " + base._LI_SRC.strip() + f""",
li2 AS (SELECT * REPLACE (CASE WHEN dt IN ({days}) AND l_returnflag = 'N' THEN l_quantity + 7 ELSE l_quantity END AS l_quantity) FROM li),"""
                            + base._mart_sql("li2", *own) + f""",
hit AS (SELECT DISTINCT l_returnflag, dt AS c FROM li WHERE dt IN ({days}) AND l_returnflag = 'N')
SELECT * FROM mart WHERE EXISTS (SELECT 1 FROM hit WHERE hit.l_returnflag = mart.l_returnflag
                                 AND mart.dt BETWEEN hit.c AND hit.c + 30)""")
    mine = base.oracle_reports()
    for name in ("overview", "climate", "monthly_pivot", "year_over_year", "top_anomalies", "anomaly_counts"):
        sql[f"served_{name}"] = _over_served(mine[name])
    sql["plain_mart"] = """
WITH li AS (SELECT l_returnflag, CAST(l_shipdate AS DATE) AS dt, sqrt(l_extendedprice) AS root FROM lineitem),
d AS (SELECT dt, l_returnflag, count(*) AS rows_count, min(root) AS lo, max(root) AS hi, avg(root) AS mid, sum(root) AS total
      FROM li GROUP BY dt, l_returnflag),
n AS (SELECT *, CASE WHEN count(mid) OVER w >= 25 THEN avg(mid) OVER w END AS norm FROM d
      WINDOW w AS (PARTITION BY l_returnflag ORDER BY date_diff('day', DATE '1970-01-01', dt) RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING))
SELECT dt, l_returnflag, rows_count, round(lo, 2) AS root_min, round(hi, 2) AS root_max, round(mid, 2) AS root_avg,
       round(total, 2) AS root_sum, round(norm, 2) AS root_norm_30d, round(mid - norm, 2) + 0.0 AS root_anomaly FROM n"""
    u = base._units("l_extendedprice")
    sql["half_even"] = f"""
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS dt, l_returnflag, count(l_extendedprice) AS n, CAST(sum({u}) AS HUGEINT) AS s
           FROM lineitem GROUP BY ALL),
q AS (SELECT *, s // n AS lower, 2 * (s % n) AS rest FROM d),
r AS (SELECT dt, l_returnflag, n, CAST(lower + CASE WHEN rest >= n THEN 1 ELSE 0 END AS DOUBLE) / 100.0 AS half_up,
             CAST(lower + CASE WHEN rest > n OR rest = n AND lower % 2 = 1 THEN 1 ELSE 0 END AS DOUBLE) / 100.0 AS half_even FROM q)
SELECT * FROM r WHERE half_up <> half_even OR n % 2 = 1"""
    spreads = ", ".join(f"round(sqrt(CAST(count({c}) * sum(CAST({base._units(c)} AS HUGEINT) * {base._units(c)}) "
                        f"- sum(CAST({base._units(c)} AS HUGEINT)) * sum(CAST({base._units(c)} AS HUGEINT)) AS DOUBLE)) / count({c}) / 100.0, 6) AS {name}"
                        for c, name in (("l_extendedprice", "price_spread"), ("l_quantity", "qty_spread"), ("l_discount", "disc_spread")))
    sql["exact_spread"] = f"SELECT l_returnflag, l_linestatus, {spreads} FROM lineitem GROUP BY ALL"
    checks = base._checks_sql(_DIRTY, "dh")
    absent = "  UNION ALL SELECT dt, 'column_missing', 'weight', NULL, NULL, NULL, NULL FROM l3"
    sql["dirty_checks"] = checks.replace("  UNION ALL SELECT dt, 'duplicates'", absent + "\n  UNION ALL SELECT dt, 'duplicates'", 1)
    sql["dirty_clean"] = f"""
WITH {_DIRTY},
last AS (SELECT *, row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id DESC) AS rn FROM dh
         WHERE event_type IS NOT NULL AND ts IS NOT NULL)
SELECT event_type, ts, event_id,
       CASE WHEN isnan(value) THEN NULL WHEN value < 0 THEN 0.0 WHEN value > 100 THEN 100.0 ELSE value END AS value
FROM last WHERE rn = 1"""
    sql["dirty_mart_checks"] = base._ev_mart() + f""", {base._SPAN},
m AS (SELECT * REPLACE (CASE extract(day FROM dt) % 7 WHEN 0 THEN NULL WHEN 1 THEN CAST('nan' AS DOUBLE)
                             WHEN 2 THEN value_max + 1 ELSE value_avg END AS value_avg)
      FROM mart WHERE event_type <> '{LATE_TYPES[1]}'),
n AS (SELECT CAST(e - s + 1 AS DOUBLE) AS n, (SELECT CAST(count(DISTINCT event_type) AS DOUBLE) FROM events) AS t FROM span),
c AS (
  SELECT 'rows' AS rule, CAST(count(*) AS DOUBLE) AS observed, any_value(t * n) AS lo, any_value(t * n) AS hi FROM m, n
  UNION ALL SELECT 'entities', count(DISTINCT event_type), any_value(t), any_value(t) FROM m, n
  UNION ALL SELECT 'days', count(DISTINCT dt), any_value(n), any_value(n) FROM m, n
  UNION ALL SELECT 'incomplete_days', count(*) FILTER (WHERE hours_count <> 23), 0, 0 FROM m
  UNION ALL SELECT 'bad_order', count(*) FILTER (WHERE value_avg > value_max AND NOT isnan(value_avg)
                                                 OR isnan(value_avg) AND value_max IS NOT NULL), 0, 0 FROM m
  UNION ALL SELECT 'nan_avg', count(*) FILTER (WHERE value_avg IS NULL OR isnan(value_avg)), 0, 0 FROM m)
SELECT 'mart' AS layer, CAST(NULL AS DATE) AS dt, rule, CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS entity,
       observed, CAST(lo AS DOUBLE) AS limit_low, CAST(hi AS DOUBLE) AS limit_high FROM c WHERE observed < lo OR observed > hi"""
    return sql
