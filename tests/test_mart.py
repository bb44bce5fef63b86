from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from obsmart.operators.norms import trailing_norm
from obsmart.operators.rollup import daily, round_metrics
from obsmart.plans.mart import build_mart
from obsmart.plans.runs import transform_payloads
from obsmart.schemas import WEATHER_DAILY_AGGS
from tests.conftest import payload_frame

DAY = date(2026, 10, 7)


def test_golden_day(spark, places, sample_payload):
    hourly = transform_payloads(payload_frame(spark, [("moscow", sample_payload)]), places, DAY, DAY)
    r = build_mart(hourly, start=DAY, end=DAY, processed_at=None).first()
    assert r.hours_count == 24
    assert (r.temp_min, r.temp_max, r.temp_avg) == (6.8, 15.5, 11.15)
    assert (r.precip_sum, r.wind_max, r.humidity_avg) == (0.0, 12.2, 72.33)
    assert (r.pressure_avg, r.cloud_cover_avg) == (1013.47, 28.96)
    assert r.temp_norm_30d is None and r.temp_anomaly is None
    assert (r.city_name, r.latitude) == ("Москва", 55.7558)


def series(spark, days, gap=(), value=lambda i: float(i), city="a"):
    start = date(2026, 1, 1)
    rows = [(start + timedelta(days=i), city, value(i)) for i in range(days) if i not in gap]
    return spark.createDataFrame(rows, "dt date, city string, temp_avg double")


def norms(df, **kw):
    return {r.dt: r for r in trailing_norm(df, entity="city", **kw).collect()}


def test_norm_needs_25_filled_days(spark):
    # day index 25 has 25 filled days behind it, index 24 only 24
    n = norms(series(spark, 40))
    assert n[date(2026, 1, 25)].temp_norm_30d is None             # index 24
    assert n[date(2026, 1, 26)].temp_norm_30d == pytest.approx(12.0)  # mean of 0..24
    assert n[date(2026, 1, 26)].temp_anomaly == pytest.approx(13.0)


def test_norm_is_a_calendar_window(spark):
    # a 10-day gap (indexes 30..39) is not skipped over: the window stays 30 calendar days
    gap = set(range(30, 40))
    n = norms(series(spark, 70, gap=gap))
    base = date(2026, 1, 1)
    assert n[base + timedelta(days=45)].temp_norm_30d is None     # 15..44 minus gap: 20 days
    assert n[base + timedelta(days=64)].temp_norm_30d is None     # 34..63 minus gap: 24 days
    expect = [i for i in range(35, 65) if i not in gap]           # 35..64 minus gap: 25 days
    assert n[base + timedelta(days=65)].temp_norm_30d == pytest.approx(sum(expect) / len(expect))


def test_norm_per_entity_and_null_values(spark):
    df = series(spark, 40).unionByName(series(spark, 40, city="b", value=lambda i: None))
    out = trailing_norm(df, entity="city").where("city = 'b'").agg(F.count("temp_norm_30d")).first()[0]
    assert out == 0


def test_one_window_operator(spark):
    import re
    plan = trailing_norm(series(spark, 40), entity="city")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bWindow \[", plan)) == 1          # count and avg share one operator


def test_round_last(spark):
    # anomaly is computed unrounded and rounded once at the end
    df = spark.createDataFrame([(date(2026, 1, 1), "a", 1.004, 1.0)], "dt date, city string, temp_avg double, temp_norm_30d double")
    df = df.withColumn("temp_anomaly", F.col("temp_avg") - F.col("temp_norm_30d"))
    r = round_metrics(df, ["temp_avg", "temp_norm_30d", "temp_anomaly"]).first()
    assert (r.temp_avg, r.temp_anomaly) == (1.0, 0.0)


def test_metric_null_all_day_gives_null(spark):
    df = spark.createDataFrame([(DAY, "a", None, 1.0)] * 3, "dt date, city string, temperature_c double, precipitation_mm double")
    r = daily(df, entity="city", aggs=WEATHER_DAILY_AGGS).first()
    assert r.hours_count == 3 and r.temp_avg is None and r.temp_max is None and r.precip_sum == 3.0
    assert r.wind_max is None   # column absent -> NULL


def test_exact_average_rounding_is_half_up_of_true_value(spark):
    # 592.715 is stored as 592.71499999...; the exact path rounds the true average up
    df = spark.createDataFrame([(DAY, "a", 1185.43), (DAY, "a", 0.0)], "dt date, city string, temperature_c double")
    d = daily(df, entity="city", aggs=(("temp_avg", "avg", "temperature_c"),), exact_scale=2, keep_state=True)
    assert round_metrics(d, ["temp_avg"], 2, exact_scale=2).first().temp_avg == 592.72


def test_lookback_read_prunes_partitions(spark, scratch):
    from obsmart.sinks.lake import overwrite_days
    from obsmart.sources.lake import read_days

    df = series(spark, 60).withColumn("v", F.lit(1.0))
    overwrite_days(df, scratch)
    r = read_days(spark, scratch, "2026-02-10", "2026-02-20", lookback=30)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and r.count() == 41


def test_exact_rollup_is_identical_under_any_partitioning(spark):
    from obsmart.plans import catalog
    obs = catalog.lineitem_obs(spark, "/root/testdata/sf0.001")
    results = []
    for parts in (1, 7, 23):
        d = daily(obs.repartition(parts), entity="l_returnflag", aggs=catalog.LI_SPEC.aggs,
                  count_col="rows_count", exact_scale=2)
        results.append(sorted(map(tuple, d.collect())))
    assert results[0] == results[1] == results[2]
