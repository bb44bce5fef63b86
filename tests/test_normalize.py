"""Payloads to staging rows: made-up payloads whose every value names its place and hour."""

import glob
from datetime import date, datetime, timedelta, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from obsmart.operators.normalize import assign_day, clean, unpivot_arrays
from obsmart.plans.runs import transform_payloads
from obsmart.schemas import STAGING_COLUMNS, WEATHER_VARIABLES
from obsmart.sinks.lake import overwrite_days
from tests.conftest import payload_frame

DAY = date(2026, 10, 7)
EVE = date(2024, 2, 28)
NAMES = list(WEATHER_VARIABLES)


def made(hours, start=EVE, **changed):
    """A payload of ``hours`` hours: variable number v is 10 v + hour / 100 at each hour."""
    begin = datetime(start.year, start.month, start.day)
    hourly = {"time": [f"{begin + timedelta(hours=h):%Y-%m-%dT%H:%M}" for h in range(hours)]}
    hourly |= {name: [10 * v + h / 100 for h in range(hours)] for v, name in enumerate(NAMES)}
    return {"latitude": -1.0, "hourly": {k: x for k, x in (hourly | changed).items() if x is not ...}}


def staged(spark, places, *items, start=EVE, end=EVE + timedelta(2), **kw):
    return transform_payloads(payload_frame(spark, items, str(start), str(end)), places, start, end, **kw)


def test_every_value_arrives_in_its_row(spark, places):
    df = staged(spark, places, ("london", made(60)))
    assert df.columns == STAGING_COLUMNS + ["dt"]
    rows = df.orderBy("ts").collect()
    assert len(rows) == 60 and {r.dt for r in rows} == {EVE, date(2024, 2, 29), date(2024, 3, 1)}
    for h, r in enumerate(rows):
        assert r.ts.astimezone(timezone.utc) == datetime(2024, 2, 28, tzinfo=timezone.utc) + timedelta(hours=h)
        assert [r[c] for c in WEATHER_VARIABLES.values()] == [10 * v + h / 100 for v in range(len(NAMES))]
        assert (r.city, r.country, r.latitude) == ("london", "GB", 51.5074)       # the dimension's


def test_absent_variables_and_values(spark, places):
    first, second = list(WEATHER_VARIABLES.values())[:2]
    rows = staged(spark, places, ("london", made(5, **{NAMES[0]: ..., NAMES[1]: [1, None, 3, None, 5]}))).orderBy("ts").collect()
    assert [r[first] for r in rows] == [None] * 5 and [r[second] for r in rows] == [1, None, 3, None, 5]


@pytest.mark.parametrize("body", [{}, {"hourly": None}, {"hourly": {"time": []}}, {"hourly": {NAMES[0]: [1]}}])
def test_payloads_without_hours_give_no_rows(spark, places, body):
    df = staged(spark, places, ("london", body))
    assert df.isEmpty() and df.columns == STAGING_COLUMNS + ["dt"]


def test_one_row_per_key_and_a_count_of_the_rest(spark, places, scratch):
    shorter, no_time = made(2), made(1, time=[None])
    dropped, unmatched = Observation("dropped"), Observation("unmatched")
    df = staged(spark, places, ("moscow", made(30)), ("london", made(30)), ("moscow", shorter), ("london", no_time),
                ("atlantis", made(3)), dropped=dropped, unmatched=unmatched)
    assert overwrite_days(df, scratch, sort_within=("city", "ts")) == 60
    assert dropped.get == {"no_time": 1, "no_entity": 0} and unmatched.get == {"unmatched": 3}
    for name in glob.glob(f"{scratch}/dt=*/*.parquet"):
        t = pq.read_table(name)
        keys = list(zip(t.column("city").to_pylist(), t.column("ts").to_pylist()))
        assert keys == sorted(set(keys))
        assert str(t.schema.field("ts").type) == "timestamp[us, tz=UTC]"


def test_later_landing_then_newer_range_then_last_position_wins(spark):
    at = lambda n: datetime(2026, 1, 1, 0, 0, n)
    hour = "2024-02-28T00:00"
    rows = [("a", at(2), EVE, [1, 2]), ("a", at(1), EVE + timedelta(9), [8]), ("b", at(1), EVE, [3]), ("b", at(1), EVE + timedelta(1), [4]), ("c", None, EVE, [5, 6])]
    bodies = [(c, t, e, '{"hourly": {"time": [%s], "x": %s}}' % (", ".join([f'"{hour}"'] * len(v)), v)) for c, t, e, v in rows]
    p = spark.createDataFrame(bodies, "city string, landed_at timestamp, range_end date, body string")
    out = clean(unpivot_arrays(p, {"x": "x"}, keep=("landed_at", "range_end", "city")))
    assert {r.city: r.x for r in out.collect()} == {"a": 2.0, "b": 4.0, "c": 6.0}


def test_positions_beyond_a_million_keep_their_order(spark):
    df = spark.createDataFrame([("a", 1, EVE, 2**21, 1.0), ("a", 1, EVE + timedelta(1), 0, 2.0)], "city string, ts int, range_end date, _pos int, x double")
    assert clean(df).first().x == 2.0


def test_only_percentages_are_clipped(spark, places):
    variables = {v: k for k, v in WEATHER_VARIABLES.items()}
    high, low = [101.5, 99.0], [-3.0, 0.0]
    repairs = Observation("repairs")
    df = staged(spark, places, ("london", made(2, **{variables["humidity_pct"]: high, variables["cloud_cover_pct"]: low, variables["temperature_c"]: [200, -200]})), repairs=repairs)
    rows = sorted(df.collect(), key=lambda r: r.ts)
    assert [(r.humidity_pct, r.cloud_cover_pct, r.temperature_c) for r in rows] == [(100.0, 0.0, 200.0), (99.0, 0.0, -200.0)]
    assert repairs.get == {"humidity_pct": 1, "cloud_cover_pct": 1}


def test_rows_outside_the_period_are_left_out(spark, places):
    assert staged(spark, places, ("london", made(49)), end=EVE).count() == 24
    assert staged(spark, places, ("london", made(49)), start=EVE + timedelta(5), end=EVE + timedelta(6)).isEmpty()


def test_times_with_zones_and_bare_days(spark):
    from obsmart.functions.temporal import to_utc

    want = {"2024-02-29": (2024, 2, 29, 0, 0, 0), "2024-02-29T12:30": (2024, 2, 29, 12, 30, 0), "2024-02-29 12:30:15.5": (2024, 2, 29, 12, 30, 15),
            "2024-02-29T12:30Z": (2024, 2, 29, 12, 30, 0), "2024-02-29T12:30+02:00": (2024, 2, 29, 10, 30, 0), "2024-02-29T12:30:00-0530": (2024, 2, 29, 18, 0, 0),
            "2024-02-29T23:59:59+01": (2024, 2, 29, 22, 59, 59), "junk": None, "2024-02-29T": None, "2024-02-29T25:00": None, "": None, None: None}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = {r.t: r.u for r in spark.createDataFrame([(t,) for t in want], "t string").select("t", F.unix_seconds(to_utc("t")).alias("u")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {t: w and int(datetime(*w, tzinfo=timezone.utc).timestamp()) for t, w in want.items()}


def test_parallel_arrays_shorter_padded_longer_cut(spark):
    body = '{"hourly": {"time": ["2026-10-07T00:00", "2026-10-07T01:00"], "a": [1], "b": [1, 2, 3]}}'
    p = spark.createDataFrame([("x", body)], "city string, body string")
    rows = unpivot_arrays(p, {"a": "a", "b": "b"}, keep=("city",)).orderBy("ts").collect()
    assert [(r.a, r.b) for r in rows] == [(1.0, 1.0), (None, 2.0)]


def test_number_coercion(spark):
    body = '{"hourly": {"time": ["2026-10-07T00:00","2026-10-07T01:00","2026-10-07T02:00","2026-10-07T03:00","2026-10-07T04:00"], "a": ["1.5", "junk", null, true, "NaN"]}}'
    p = spark.createDataFrame([("x", body)], "city string, body string")
    rows = unpivot_arrays(p, {"a": "a"}, keep=("city",)).orderBy("ts").collect()
    assert [r.a for r in rows] == [1.5, None, None, None, None]


def test_junk_time_is_null_or_fails_when_strict(spark):
    body = '{"hourly": {"time": ["2026-10-07T00:00", "not a time"], "a": [1, 2]}}'
    p = spark.createDataFrame([("x", body)], "city string, body string")
    rows = unpivot_arrays(p, {"a": "a"}, keep=("city",)).collect()
    assert sum(r.ts is None for r in rows) == 1
    with pytest.raises(PySparkException):
        unpivot_arrays(p, {"a": "a"}, keep=("city",), strict=True).collect()


def test_utc_day_independent_of_session_zone(spark):
    df = spark.createDataFrame([("2026-10-07T23:30",)], "t string")
    from obsmart.functions.temporal import to_utc
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        out = assign_day(df.select(to_utc("t").alias("ts")), "ts", "dt").first()
        assert out.dt == DAY
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_variables_map_is_the_documented_one():
    assert list(WEATHER_VARIABLES.values()) == STAGING_COLUMNS[6:]


def test_enrich_counts_the_unmatched_and_wants_a_unique_key(spark):
    from obsmart.operators.normalize import enrich

    facts = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "k long, v double")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (None, "x"), (None, "y")], "k long, name string")
    how = dict(fact_key="k", dim_key="k", attrs={"name": "name"})
    obs = Observation("e")
    out = enrich(facts, dim, observation=obs, **how)
    assert sorted((r.k, r.name) for r in out.collect()) == [(1, "a"), (2, "b")] and obs.get["unmatched"] == 1
    assert enrich(facts, dim, how="left", **how).count() == 3
    # at any size, with no broadcast bound to hide behind
    large = spark.range(1_200_000).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    assert enrich(facts, large, **how).count() == 3
    with pytest.raises(ValueError, match="not unique"):
        enrich(facts, large.unionByName(large.limit(1)), **how)

def test_keep_last_fast_path_takes_whole_rows(spark):
    from obsmart.operators.normalize import keep_last

    rows = [("a", 1, 10, 1.0, 100), ("a", 1, 30, 3.0, 300), ("a", 1, 20, 2.0, 200),
            ("a", 1, 30, 4.0, 400), ("b", 1, 5, None, 7)]          # a tie on the order for "a"
    df = spark.createDataFrame(rows, "k string, t int, o long, v double, w long").repartition(3)
    out = keep_last(df, ["k", "t"], ["o"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    got = {r.k: (r.o, r.v, r.w) for r in out.collect()}
    assert got["b"] == (5, None, 7)
    assert got["a"] in {(30, 3.0, 300), (30, 4.0, 400)}            # one whole row, never mixed
    both = keep_last(df, ["k", "t"], ["o", "v"]).where("k = 'a'").first()
    assert (both.o, both.v, both.w) == (30, 4.0, 400)                # struct order breaks the tie


def test_keep_last_null_order_loses_but_keeps_values(spark):
    from obsmart.operators.normalize import keep_last

    df = spark.createDataFrame([("a", None, 1.0), ("b", None, 2.0), ("b", 3, 3.0)],
                               "k string, o long, v double")
    fast = {r.k: r.v for r in keep_last(df, ["k"], ["o"]).collect()}
    wide = {r.k: r.v for r in keep_last(df, ["k"], ["o", "v"]).collect()}
    assert fast == wide == {"a": 1.0, "b": 3.0}
