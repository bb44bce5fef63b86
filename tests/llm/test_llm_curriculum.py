"""Targets by repeated resharing, schedules by integration, supply to the word."""

import random

import pytest
from llm_cases import awkward
from pyspark.sql import functions as F

from obsmart.llm.curriculum import mix, plan_mix, time_of
from obsmart.llm.text import WORD


def reshared(sizes, weights, cap=3):
    """Targets as told: share by weight, stop at the cap, reshare the excess until none is above."""
    target, full, total = dict.fromkeys(sizes, 0.0), set(), float(sum(sizes.values()))
    while True:
        free = [s for s in sizes if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        for s in free:
            target[s] = left * weights[s] / sum(weights[x] for x in free)
        over = [s for s in free if target[s] > cap * sizes[s] + 1e-9]
        if not over:
            return target
        for s in over:
            target[s] = cap * sizes[s]
        full |= set(over)


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken_words(spark, seed):
    rng = random.Random(seed)
    sources = ["a", "B", "é", "zz", None, "c1", "c2"]
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)) if rng.random() < 0.95 else None, rng.choices(sources, [9, 1, 1, 3, 2, 1, 5])[0]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = plan_mix(df, rows_per_bucket=30).collect()
    assert len(got) == 400
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = reshared(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size and (r.position is None) == (r.taken == 0)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    again = plan_mix(df.repartition(7), rows_per_bucket=30).collect()
    key = lambda r: (r.doc_id, r.taken, r.position)
    assert sorted(map(str, map(key, got))) == sorted(map(str, map(key, again)))


@pytest.mark.parametrize("slope", [-1.0, -0.5, 0.0, 0.5, 1.0])
def test_time_inverts_the_integral(spark, slope):
    df = spark.range(11).select((F.col("id") / 10).alias("share")).select("share", time_of(F.col("share"), F.lit(slope)).alias("t"))
    for r in df.collect():
        assert abs((1 - slope) * r.t + slope * r.t ** 2 - r.share) < 1e-9


def test_training_order_holds_the_planned_copies_whole(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{i}.{k}" for k in range(rng.choice([3, 5, 400]))) + " \n", "abc"[i % 3]) for i in range(90)] + [(5, "twice the same row", "a")] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mix(df, rows_per_bucket=10)
    assert out.columns == df.columns
    texts = {r[:2] for r in rows}
    assert {(r.doc_id, r.text) for r in out.collect()} <= texts                     # no text is cut
    # by definition: every copy of the plan whose words are at least half of the document's
    copies = [(r.doc_id, r.size) for r in plan_mix(df, rows_per_bucket=10).collect() for c in r.copies if 2 * c.words >= r.size]
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, _ in copies)
    words = F.regexp_count("text", F.lit(WORD))
    got = {r.source: r.n for r in out.groupBy("source").agg(F.sum(words).alias("n")).collect()}
    for r in plan_mix(df, rows_per_bucket=10).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("size").alias("longest")).collect():
        assert abs(got[r.source] - r.taken) <= r.longest / 2                        # as near as a whole copy allows


def test_awkward_rows(spark):
    out = plan_mix(awkward(spark)).collect()
    assert len(out) == 13 and all(r.taken == 0 for r in out if r.size == 0)
    assert sum(r.source is None for r in out) == 3
    assert mix(awkward(spark)).columns == awkward(spark).columns
    assert plan_mix(awkward(spark, [])).count() == 0 and mix(awkward(spark, [])).count() == 0
    assert plan_mix(awkward(spark, [(1, None, "en", "s")])).first().taken == 0
