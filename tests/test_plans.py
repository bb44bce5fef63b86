"""Physical-plan properties the library relies on at scale (checked on the executed plans)."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from obsmart.operators.normalize import keep_last
from obsmart.plans import catalog

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    df.write.format("noop").mode("overwrite").save()          # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_no_cartesian_product_and_no_row_udf(spark, key):
    plan = plan_of(E.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "MapInPandas" not in plan and "FlatMapGroupsInPandas" not in plan


def test_keep_last_combines_before_the_shuffle(spark):
    plan = plan_of(keep_last(catalog.events_hourly(spark, SF), ["event_type", "ts"], ["event_id"]))
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning")   # below it


def test_mart_plan_two_exchanges_one_window(spark):
    plan = plan_of(catalog.lineitem_mart(spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert len(re.findall(r"\bWindow \[", plan)) == 1
    assert "partial_count" in plan                                         # map-side combine
    scan = [l for l in plan.splitlines() if "FileScan parquet" in l][0]
    assert "l_orderkey" not in scan and "l_linestatus" not in scan          # columns pruned


def test_staging_checks_read_the_checkpointed_profile(spark):
    # the session has a shared checkpoint folder: the staging is scanned once, into the
    # per entity-day profile; the checks read the profile and never group a whole day
    plan = plan_of(catalog.q_staging_checks(spark, SF))
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l]
    assert not [s for s in scans if "value" in s]                            # no staging rescan
    assert "ExistingRDD" in plan or "LogicalRDD" in plan                     # the checkpoint
    assert "Window" not in plan


def test_landing_reduces_per_hour_before_gathering(spark):
    plan = plan_of(catalog.events_payloads(spark, SF))
    assert "partial_max_by" in plan and "partial_collect_list" in plan


def test_enrich_leaves_the_strategy_to_spark(spark):
    from obsmart.operators.normalize import enrich
    orders = catalog.table(spark, SF, "orders")
    customer = catalog.table(spark, SF, "customer")
    how = dict(fact_key="o_custkey", dim_key="c_custkey", attrs={"c_name": "c_name"})
    assert "BroadcastHashJoin" in plan_of(enrich(orders, customer, **how))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_of(enrich(orders, customer, **how))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_without_global_sort(spark):
    plan = plan_of(catalog.q_top_anomalies(spark, SF))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_period_filter_reaches_the_scan(spark):
    df = catalog.table(spark, SF, "events").where(F.to_date("ts") >= F.lit("2024-01-10"))
    plan = plan_of(df)
    assert "DataFilters" in plan and "ts" in plan


def test_serving_read_prunes_month_folders(spark, tmp_path):
    from obsmart.sources.lake import read_months

    path = str(tmp_path / "serving")
    (spark.range(0, 90).select(F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("dt"))
     .withColumn("month", (F.year("dt") * 100 + F.month("dt")).cast("int"))
     .write.partitionBy("month").parquet(path))
    df = read_months(spark, path, "2026-02-03", "2026-02-10")
    plan = plan_of(df)
    assert "PartitionFilters" in plan and "202602" in plan
    assert df.count() == 8
