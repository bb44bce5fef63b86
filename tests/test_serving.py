from datetime import date, datetime

from pyspark.sql import functions as F

from obsmart.operators.versions import conform, latest
from obsmart.plans.serving import compact, current, load_range
from obsmart.sinks.lake import overwrite_days
from obsmart.sources.lake import read_days


def mart(spark, value=1.0, days=40):
    rows = [(date(2026, 1, 1).fromordinal(date(2026, 1, 1).toordinal() + i), c, 24, value)
            for i in range(days) for c in ("a", "b")]
    return (spark.createDataFrame(rows, "dt date, city string, hours_count long, temp_avg double")
            .withColumn("processed_at", F.lit(datetime(2026, 3, 1, 12, 0, 0, 123456)).cast("timestamp")))


def test_latest_picks_greatest_version_and_breaks_ties(spark):
    rows = [("a", date(2026, 1, 1), 1, 10.0), ("a", date(2026, 1, 1), 2, 20.0),
            ("b", date(2026, 1, 1), 5, 1.0), ("b", date(2026, 1, 1), 5, 2.0)]
    df = spark.createDataFrame(rows, "city string, dt date, loaded_at int, v double")
    got = {r.city: r.v for r in latest(df, ["city", "dt"], ["loaded_at", "v"]).collect()}
    assert got == {"a": 20.0, "b": 2.0}


def test_conform_casts(spark):
    c = conform(mart(spark), load_ts=datetime(2026, 3, 2))
    r = c.first()
    assert c.schema["hours_count"].dataType.typeName() == "integer"
    assert r.month == 202601 and r.processed_at.microsecond == 123000


def test_load_twice_equals_load_once(spark, scratch):
    m, s = f"{scratch}/mart", f"{scratch}/serving"
    overwrite_days(mart(spark), m)
    assert load_range(spark, m, s, "2026-01-01", "2026-02-09", load_ts=datetime(2026, 3, 1)) == 80
    once = sorted(tuple(r) for r in current(spark, s).drop("loaded_at").collect())
    overwrite_days(mart(spark, value=2.0), m)            # a re-run of the period with new values
    load_range(spark, m, s, "2026-01-10", "2026-01-20", load_ts=datetime(2026, 3, 2))
    cur = current(spark, s)
    assert cur.count() == 80
    assert cur.where("temp_avg = 2.0").count() == 22
    load_range(spark, m, s, "2026-01-10", "2026-01-20", load_ts=datetime(2026, 3, 2))
    assert sorted(tuple(r) for r in current(spark, s).collect()) == \
        sorted(tuple(r) for r in cur.collect())
    assert len(once) == 80
    # compaction keeps only the latest rows, same logical content
    before = sorted(tuple(r) for r in current(spark, s).collect())
    assert compact(spark, s, "2026-01-01", "2026-02-28") == 80
    assert spark.read.parquet(s).count() == 80
    assert sorted(tuple(r) for r in current(spark, s).collect()) == before


def test_dynamic_overwrite_replaces_only_written_days(spark, scratch):
    overwrite_days(mart(spark, 1.0, days=10), scratch)
    overwrite_days(mart(spark, 2.0, days=3), scratch)
    df = read_days(spark, scratch)
    assert df.count() == 20
    assert df.where("temp_avg = 2.0").count() == 6


def test_bucketed_table_resolves_without_shuffle(spark, scratch):
    from obsmart.operators.versions import conform
    from obsmart.plans.serving import compact_table, create_table, current_table, load_table

    m = f"{scratch}/mart"
    overwrite_days(mart(spark), m)
    schema = conform(mart(spark), load_ts=datetime(2026, 3, 1)).schema
    create_table(spark, "served_test", f"{scratch}/served_tbl", schema, buckets=4)
    try:
        assert load_table(spark, m, "served_test", "2026-01-01", "2026-02-09",
                          load_ts=datetime(2026, 3, 1)) == 80
        overwrite_days(mart(spark, value=2.0), m)
        load_table(spark, m, "served_test", "2026-01-10", "2026-01-20", load_ts=datetime(2026, 3, 2))
        cur = current_table(spark, "served_test")
        assert cur.count() == 80 and cur.where("temp_avg = 2.0").count() == 22
        plan = cur._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("SortAggregate")[-1]     # nothing below the aggregate
        before = sorted(tuple(r) for r in cur.collect())
        assert compact_table(spark, "served_test", "2026-01-01", "2026-02-28") == 80
        assert spark.table("served_test").count() == 80
        import glob
        files = glob.glob(f"{scratch}/served_tbl/month=*/*.parquet")
        assert len(files) <= 4 * 2                                   # one per bucket and month
        assert sorted(tuple(r) for r in current_table(spark, "served_test").collect()) == before
    finally:
        spark.sql("DROP TABLE IF EXISTS served_test")


def test_sql_view_of_latest_versions(spark, scratch):
    from obsmart.plans import reports
    from obsmart.plans.serving import register_view

    m, s = f"{scratch}/mart", f"{scratch}/serving"
    overwrite_days(mart(spark), m)
    load_range(spark, m, s, "2026-01-01", "2026-02-09", load_ts=datetime(2026, 3, 1))
    load_range(spark, m, s, "2026-01-01", "2026-01-05", load_ts=datetime(2026, 3, 2))
    daily = register_view(spark, s, "daily_city_test")
    got = spark.sql("SELECT count(*) AS rows, count(DISTINCT city) AS entities, min(dt) AS first_day, "
                    "max(dt) AS last_day FROM daily_city_test").first()
    assert tuple(got) == tuple(reports.overview(daily).first()) == (80, 2, date(2026, 1, 1), date(2026, 2, 9))


def test_snapshot_serves_several_reports_without_resolving_again(spark, scratch):
    from obsmart.plans import reports
    from obsmart.plans.serving import snapshot

    m, s = f"{scratch}/mart", f"{scratch}/serving"
    overwrite_days(mart(spark), m)
    load_range(spark, m, s, "2026-01-01", "2026-02-09", load_ts=datetime(2026, 3, 1))
    load_range(spark, m, s, "2026-01-01", "2026-01-05", load_ts=datetime(2026, 3, 2))
    snap = snapshot(spark, s)
    r = reports.overview(snap)
    r.collect()
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "max_by" not in plan          # versions not resolved again
    assert tuple(r.first()) == (80, 2, date(2026, 1, 1), date(2026, 2, 9))
