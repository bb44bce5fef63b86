"""Exact distinct counts from stored bitmaps, against sets."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from obsmart.operators.distinct import distinct_count, distinct_states, merged_states, replaced_states

KINDS = "period int, n bigint"


def counted(states):
    return {r.period: r.n_distinct for r in distinct_count(states).collect()}


def states_of(df):
    return distinct_states(df, F.col("period"), F.col("n"))


def test_against_sets(spark):
    rng = random.Random(5)
    edges = [0, 1, -1, 32_767, 32_768, 32_769, -32_767, -32_768, -32_769, 2**40, -(2**40)]
    rows = [(rng.choice([202401, 202402, 202511]), rng.choice([*edges, None, rng.randint(-200_000, 200_000)])) for _ in range(3000)]
    rows += rows[:500] + [(202601, None), (None, 4)]
    months = states_of(spark.createDataFrame(rows, KINDS).repartition(7))
    want = {m: len({n for p, n in rows if p == m and n is not None}) for m, _ in rows}
    assert counted(months) == want and want[202601] == 0
    years = counted(merged_states(months, (F.col("period") / 100).cast("int")))
    assert years[2024] == len({n for p, n in rows if p in (202401, 202402) and n is not None})
    whole = merged_states(merged_states(months, F.col("period") % 7), F.lit(0))
    assert counted(whole) == {0: len({n for _, n in rows if n is not None})}
    assert counted(states_of(spark.createDataFrame([], KINDS))) == {}


def test_stored_states_of_touched_months(spark, scratch):
    """A re-run of a month, also one that lost its rows, replaces its states; the others stay as stored."""
    rows = [(m, n) for m in (1, 2, 3) for n in range(m * 10, m * 10 + 20)]
    states_of(spark.createDataFrame(rows, KINDS)).write.parquet(f"{scratch}/states")
    stored = spark.read.parquet(f"{scratch}/states")
    again = states_of(spark.createDataFrame([(2, 5), (2, 5), (2, 45)], KINDS))
    after = replaced_states(stored, again, spark.createDataFrame([(2,), (3,)], "period int"))
    assert counted(after) == {1: 20, 2: 2}
    assert counted(merged_states(after, F.lit(0))) == {0: 22}


def test_days_and_plan(spark):
    """Days count by their number; neither Expand nor a shuffle of rows: the first aggregate is partial."""
    days = [(date(1969, 12, 25) + timedelta(days=i % 20),) for i in range(100)]
    df = spark.createDataFrame(days, "dt date")
    states = distinct_states(df, F.lit(1), F.unix_date("dt"))
    assert counted(states) == {1: 20}
    plan = distinct_count(states)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "partial_bitmap_construct_agg" in plan
