"""Exact rounding at ties and exact spread, against Python's decimal arithmetic."""

import random
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from obsmart.functions.numeric import div_half_even, div_half_up, exact_avg_rounded, exact_stddev
from obsmart.operators.rollup import daily, round_metrics


def test_divisions_at_ties(spark):
    rows = [(n, d) for n in range(-40, 41) for d in (1, 2, 3, 4, 8)] + [(5, 0), (None, 2), (10 ** 18 + 1, 2), (-(10 ** 18) - 1, 2)]
    df = spark.createDataFrame(rows, "n bigint, d bigint")
    for r in df.select("n", "d", div_half_even("n", "d").alias("even"), div_half_up("n", "d").alias("up")).collect():
        if r.n is None or r.d == 0:
            assert r.even is None and r.up is None
            continue
        x = Decimal(r.n) / Decimal(r.d) if r.d != 3 else Decimal(r.n * 10 ** 9 // 3) / 10 ** 9
        assert (r.even, r.up) == (int(x.quantize(Decimal(1), ROUND_HALF_EVEN)), int(x.quantize(Decimal(1), ROUND_HALF_UP)))


@pytest.mark.parametrize("mode,rounding", [("half_even", ROUND_HALF_EVEN), ("half_up", ROUND_HALF_UP)])
def test_averages_round_by_their_true_value(spark, mode, rounding):
    rng = random.Random(3)
    groups = {g: [Decimal(rng.randint(-500, 500)) / 100 for _ in range(rng.choice([1, 2, 4, 8]))] for g in range(200)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g int, v double").withColumn("dt", F.lit("2025-01-01"))
    want = {g: float((sum(vs) / len(vs)).quantize(Decimal("0.01"), rounding)) for g, vs in groups.items()}
    assert {r.g: r.a for r in df.groupBy("g").agg(exact_avg_rounded("v", 2, 2, mode).alias("a")).collect()} == want
    rolled = daily(df, entity="g", aggs=(("a", "avg", "v"),), exact_scale=2, keep_state=True)
    assert {r.g: r.a for r in round_metrics(rolled, ["a"], 2, mode, exact_scale=2).collect()} == want


def test_spread_does_not_depend_on_partitions(spark):
    rng = random.Random(4)
    values = [rng.randint(10 ** 9, 10 ** 9 + 50) / 100 for _ in range(3000)]
    units = [round(v * 100) for v in values]
    n, true = len(units), len(units) * sum(u * u for u in units) - sum(units) ** 2
    got = {spark.createDataFrame([(v,) for v in values], "v double").repartition(k).agg(exact_stddev("v", 2).alias("s")).first().s for k in (1, 3, 17)}
    assert len(got) == 1 and abs(Fraction(got.pop()) ** 2 - Fraction(true, n * n * 10 ** 4)) < Fraction(1, 10 ** 12)
    assert spark.createDataFrame([(None,)], "v double").agg(exact_stddev("v", 2).alias("s")).first().s is None
