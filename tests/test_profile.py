"""The stored quality profile: same checks, and a re-run of one day reads one day."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from obsmart.operators.quality import DataQualityError, profile_of, refresh_profile, staging_violations
from obsmart.plans import catalog, catalog_layers
from obsmart.plans.runs import Layers, run_range, staging_gate, transform_range
from obsmart.sinks.folders import folders
from obsmart.sinks.lake import write_raw
from obsmart.sources.lake import read_days
from tests.test_chain import END, START, payload
from tests.test_plans import SF, plan_of

HOW = dict(entity="event_type", ts="ts", day="dt", metrics=["value", "weight"], ranges=catalog.EVENTS_RANGES)


def lines(df):
    return sorted(map(repr, df.collect()))


def test_every_rule_fires(spark):
    found = {(r.rule, r.field) for r in catalog_layers.q_dirty_checks(spark, SF).collect()}
    assert found == {("empty", None), ("null_key", "event_type"), ("null_key", "ts"), ("duplicates", None), ("missing_entity", "event_type"),
                     ("incomplete_hours", "ts"), ("column_missing", "weight"), ("null_share", "value"), ("out_of_range", "value")}
    assert {r.rule for r in catalog_layers.q_dirty_mart_checks(spark, SF).collect()} == {"rows", "entities", "days", "incomplete_days", "bad_order", "nan_avg"}


def test_stored_profile_gives_the_same_checks(spark, scratch):
    rows = catalog_layers.dirty_hours(spark, SF)
    first, last = rows.agg(F.min("dt"), F.max("dt")).first()
    types = rows.select("event_type").distinct()
    want = lines(staging_violations(rows, start=first, end=last, expected=types, **HOW))
    middle = first + timedelta(days=(last - first).days // 2)
    for period in ((first, middle), (middle + timedelta(1), last), (middle, middle)):      # in pieces, one of them twice
        refresh_profile(spark, rows, scratch, *period, **HOW)
    stored = read_days(spark, scratch)
    assert lines(staging_violations(None, start=first, end=last, expected=types, profile=stored, **HOW)) == want
    whole = profile_of(rows, **HOW)
    assert sorted(map(repr, stored.select(*whole.columns).collect())) == sorted(map(repr, whole.collect()))
    assert refresh_profile(spark, rows.limit(0), scratch, middle, middle, **HOW) == 0 and str(middle) not in folders(spark, scratch, "dt")


def test_events_are_read_once(spark):
    plan = plan_of(catalog.q_staging_checks(spark, SF))
    assert not [x for x in plan.splitlines() if "FileScan parquet" in x]         # all that is left reads the profile


def test_a_rerun_of_one_day_checks_one_day(spark, places, scratch):
    layers = Layers(*(f"{scratch}/{n}" for n in ("raw", "staging", "mart", "serving")), profile=f"{scratch}/profile")
    rows = [(f"{START}_{END}", c, payload(s, START, END)) for c, s in (("moscow", 0.0), ("london", 8.0))]
    write_raw(spark.createDataFrame(rows, "range string, city string, body string"), layers.raw)
    run_range(spark, layers, places, START, END, load_ts=datetime(2026, 1, 1))
    files = {d: spark.read.parquet(p).inputFiles() for d, p in folders(spark, layers.profile, "dt").items()}
    assert len(files) == 40
    day = date(2025, 1, 20)
    one = [(f"{day}_{day}", "london", payload(1.0, day, day, drop_hour=7))]
    write_raw(spark.createDataFrame(one, "range string, city string, body string"), layers.raw)
    transform_range(spark, layers, places, day, day)        # the day has london alone, without an hour
    with pytest.raises(DataQualityError, match="2 violations") as e:
        staging_gate(spark, layers, places, START, END, touched=(day, day))
    assert "missing_entity" in str(e.value) and "incomplete_hours" in str(e.value)
    now = {d: spark.read.parquet(p).inputFiles() for d, p in folders(spark, layers.profile, "dt").items()}
    assert {d for d in now if now[d] != files[d]} == {str(day)}
