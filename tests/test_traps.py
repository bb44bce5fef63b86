"""The NULL / NaN / order traps of SURVEY §1.4, one test each (N5-N8, N10, N15, N16 are
covered next to their operators in test_normalize, test_quality, test_mart, test_calendar)."""

from datetime import date

from pyspark.sql import functions as F

from obsmart.functions import clip, nan_to_null, round_to, to_number
from obsmart.operators.quality import mart_stats, staging_violations
from obsmart.operators.rollup import daily
from obsmart.plans import reports

D = date(2026, 1, 1)


def test_n1_metric_null_all_day(spark):
    df = spark.createDataFrame([(D, "a", None)] * 24, "dt date, city string, temperature_c double")
    d = daily(df, entity="city", aggs=(("temp_min", "min", "temperature_c"),
                                       ("temp_avg", "avg", "temperature_c"),
                                       ("temp_max", "max", "temperature_c")))
    r = d.first()
    assert r.hours_count == 24 and r.temp_avg is None
    assert mart_stats(d).first().nan_avg == 1


def test_n2_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    r = df.agg(F.max(nan_to_null("x")).alias("m"), F.max("x").alias("raw")).first()
    assert r.m == 1.0 and r.raw != r.raw        # Spark's own max would be NaN
    assert spark.createDataFrame([("NaN",)], "s string").select(to_number("s")).first()[0] is None


def test_n3_nan_is_not_out_of_range(spark):
    df = spark.createDataFrame([(D, "a", D.isoformat() + " 00:00:00", float("nan")),
                                (D, "a", D.isoformat() + " 01:00:00", 70.0)],
                               "dt date, city string, ts string, temperature_c double")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    v = staging_violations(df, start=D, end=D, metrics=["temperature_c"],
                           ranges={"temperature_c": (-90.0, 60.0)}, hours_per_day=2).collect()
    got = {r.rule: r.observed for r in v}
    assert got["out_of_range"] == 1.0            # only the 70, not the NaN
    assert got["null_share"] == 0.5              # NaN counts as missing


def test_n4_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (102.0,), (-1.0,), (50.0,)], "x double")
    got = [r.c for r in df.select(clip("x", 0, 100).alias("c")).collect()]
    assert got[0] is None and got[1] != got[1] and got[2:] == [100.0, 0.0, 50.0]


def test_n9_rounding_modes(spark):
    df = spark.createDataFrame([(2.5, 0.285)], "a double, b double")
    r = df.select(round_to("a", 0).alias("u"), round_to("a", 0, "half_even").alias("e"),
                  round_to("b", 2).alias("b")).first()
    assert (r.u, r.e, r.b) == (3.0, 2.0, 0.29)


def _mart(spark, rows):
    return spark.createDataFrame(rows, "dt date, city string, city_name string, country string, "
                                       "temp_min double, temp_max double, temp_avg double, "
                                       "precip_sum double")


def test_n11_arg_min_ignores_null_and_takes_earliest_tie(spark):
    m = _mart(spark, [(date(2026, 1, 3), "a", "A", "X", 1.0, 5.0, 2.0, 0.0),
                      (date(2026, 1, 1), "a", "A", "X", None, None, 2.0, 0.0),
                      (date(2026, 1, 2), "a", "A", "X", 1.0, 5.0, 2.0, 0.0)])
    r = reports.climate(m).first()
    assert r.coldest_day == date(2026, 1, 2) and r.hottest_day == date(2026, 1, 2)


def test_n12_empty_conditional_average_is_null(spark):
    m = _mart(spark, [(date(2026, 1, 3), "a", "A", "X", 1.0, 5.0, 2.0, 0.0)])
    r = reports.monthly_pivot(m, entities={"a": "a", "b": "b"}).first()
    assert r.a == 2.0 and r.b is None


def test_n13_null_condition_counts_as_false(spark):
    m = spark.createDataFrame([(D, "A", None), (D, "A", 6.0)], "dt date, city_name string, temp_anomaly double")
    r = reports.anomaly_counts(m, years=(2026,)).first()
    assert (r.total, r.y2026) == (1, 1)


def test_n14_nulls_last_in_reports(spark):
    m = _mart(spark, [(D, "a", "A", "X", 1.0, 5.0, None, 0.0), (D, "b", "B", "X", 1.0, 5.0, 3.0, 0.0)])
    assert [r.city_name for r in reports.climate(m).collect()] == ["B", "A"]
    m2 = m.withColumn("temp_anomaly", F.col("temp_avg")).withColumn("temp_norm_30d", F.lit(0.0))
    assert [r.city_name for r in reports.top_anomalies(m2).collect()] == ["B"]


def test_readable_size(spark):
    from obsmart.functions import readable_size
    df = spark.createDataFrame([(0,), (1023,), (1536,), (5 * 2**30,), (None,)], "b long")
    got = [r.s for r in df.select(readable_size("b").alias("s")).collect()]
    assert got == ["0.00 B", "1023.00 B", "1.50 KiB", "5.00 GiB", None]
