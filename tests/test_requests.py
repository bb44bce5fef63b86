"""Requests reconciled with landings: states by definition, and a chain that goes on with what is missing."""

import random
from collections import defaultdict
from datetime import date, datetime

import pytest

from obsmart.operators.quality import DataQualityError
from obsmart.plans.runs import Layers, OpenRequests, extract_range, run_range
from obsmart.sources.raw import fetch_plan
from obsmart.sources.requests import next_requests, reconcile, request_states
from tests.test_chain import END, START, payload

DAY = date(2025, 1, 1)


def test_states_against_their_definition(spark):
    rng = random.Random(2)
    plan = [(f"p{i}", DAY, date(2025, 1, 1 + i % 3)) for i in range(60)]
    tries = [(e, s, t, rng.choice(["good", "retry", "retry", "retry", "fatal"]), f"r{n}", n)
             for n, (e, s, t) in enumerate(rng.choices(plan, k=120) + [("nobody", DAY, DAY), (None, DAY, DAY)])]
    got = reconcile(spark.createDataFrame(plan, "slug string, chunk_start date, chunk_end date"),
                    spark.createDataFrame(tries, "slug string, range_start date, range_end date, outcome string, reason string, seq int"), max_attempts=3)
    of = defaultdict(list)
    for e, s, t, outcome, reason, _ in tries:
        of[e, s, t].append((outcome, reason))
    want = {}
    for request in plan:
        seen = of[request]
        outcomes = {o for o, _ in seen}
        state = "done" if "good" in outcomes else "fatal" if "fatal" in outcomes else "given_up" if len(seen) >= 3 else "open"
        want[request] = (len(seen), seen[-1][1] if seen else None, state)
    assert {(r.slug, r.chunk_start, r.chunk_end): (r.attempts, r.last_reason, r.state) for r in got.collect()} == want
    assert {w[2] for w in want.values()} == {"done", "fatal", "given_up", "open"}
    asked = {(r.slug, r.chunk_start, r.chunk_end): r.attempt for r in next_requests(got).collect()}
    assert asked == {k: v[0] + 1 for k, v in want.items() if v[2] == "open"}


def responses(spark, plan, answers):
    """A response for every request that ``answers`` (by place and month) speaks of."""
    rows = [(*answers[r.slug, r.chunk_start.month], r.slug, r.chunk_start, r.chunk_end) for r in plan if (r.slug, r.chunk_start.month) in answers]
    return spark.createDataFrame(rows, "status int, body string, city string, range_start date, range_end date")


def test_a_throttled_chain_goes_on_with_what_is_missing(spark, places, scratch):
    layers = Layers(*(f"{scratch}/{n}" for n in ("raw", "staging", "mart", "serving")))
    plan = fetch_plan(places, START, END, ["temperature_2m"]).collect()          # 2 places, 2 months
    body = {(r.slug, r.chunk_start.month): payload(0.0, r.chunk_start, r.chunk_end) for r in plan}
    first = {k: (200, b) for k, b in body.items()} | {("london", 1): (429, "slow down"), ("moscow", 2): (None, None)}
    how = dict(load_ts=datetime(2026, 1, 1), max_attempts=3)
    with pytest.raises(OpenRequests, match="2 requests are still open") as stop:
        run_range(spark, layers, places, START, END, landed=responses(spark, plan, first), **how)
    assert {(r.slug, r.chunk_start.month, r.attempt, r.last_reason) for r in stop.value.next_requests.collect()} == {
        ("london", 1, 2, "429: slow down"), ("moscow", 2, 2, "no response")}
    second = {("london", 1): (503, "down"), ("moscow", 2): (200, body["moscow", 2])}
    with pytest.raises(OpenRequests, match="1 requests are still open") as stop:
        run_range(spark, layers, places, START, END, landed=responses(spark, plan, second), **how)
    assert [(r.slug, r.attempt) for r in stop.value.next_requests.collect()] == [("london", 3)]
    rep = run_range(spark, layers, places, START, END, landed=responses(spark, plan, {("london", 1): (200, body["london", 1])}), **how)
    assert rep.steps["requests"] == {"done": 4} and rep.steps["retry"] == 0 and rep.steps["load"] == 80
    assert rep.next_requests.isEmpty()
    # a correction that is throttled leaves the payload that has landed: nothing is open
    rep = run_range(spark, layers, places, START, END, landed=responses(spark, plan, {("london", 1): (429, "later")}), **how)
    assert rep.steps["extract"] == 0 and rep.steps["retry"] == 1 and rep.steps["requests"] == {"done": 4}


def test_requests_are_given_up(spark, places, scratch):
    layers = Layers(*(f"{scratch}/{n}" for n in ("raw", "staging", "mart", "serving")))
    plan = fetch_plan(places, START, START, ["temperature_2m"]).collect()
    answers = {("moscow", 1): (200, payload(0.0, START, START)), ("london", 1): (500, "")}
    for attempt in (1, 2):
        with pytest.raises(DataQualityError, match=f"{2 - attempt} requests are still open, {attempt - 1} given up"):
            run_range(spark, layers, places, START, START, load_ts=datetime(2026, 1, 1), landed=responses(spark, plan, answers), max_attempts=2)


def test_a_repeated_run_counts_once(spark, places, scratch):
    plan = fetch_plan(places, START, START, ["temperature_2m"])
    said = responses(spark, plan.collect(), {("london", 1): (429, ""), ("moscow", 1): (429, "")})
    for _ in range(3):
        out = extract_range(said, scratch, START, START, run=5)
        assert (out["written"], out["retry"], out["fatal"], out["run"]) == (0, 2, 0, 5)
    assert {r.attempts for r in request_states(spark, scratch, plan).collect()} == {1}
    assert extract_range(said, scratch, START, START)["run"] == 6
