"""Property tests against brute-force Python references on small random inputs."""

import os
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsmart.functions import exact_avg_rounded
from obsmart.operators.calendar import month_chunks_between

SETTINGS = settings(max_examples=int(os.environ.get("OBSMART_EXAMPLES", "25")), deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
days = st.dates(min_value=date(1999, 1, 1), max_value=date(2031, 12, 31))


def brute_chunks(start, end):
    out, d = [], start
    while d <= end:
        first = d
        while d + timedelta(days=1) <= end and (d + timedelta(days=1)).month == first.month:
            d += timedelta(days=1)
        out.append((first, d))
        d += timedelta(days=1)
    return out


@SETTINGS
@given(a=days, span=st.integers(min_value=0, max_value=800))
def test_month_chunks_match_brute_force(spark, a, span):
    b = a + timedelta(days=span)
    df = spark.createDataFrame([(a, b)], "s date, e date").select(F.inline(month_chunks_between("s", "e")))
    got = [(r.chunk_start, r.chunk_end) for r in df.collect()]
    assert got == brute_chunks(a, b)


@SETTINGS
@given(cents=st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=40),
       digits=st.integers(min_value=0, max_value=3))
def test_exact_average_rounding_matches_decimal(spark, cents, digits):
    rows = [(c / 100.0,) for c in cents]
    got = spark.createDataFrame(rows, "x double").agg(exact_avg_rounded("x", 2, digits)).first()[0]
    exact = (Decimal(sum(cents)) / Decimal(100) / Decimal(len(cents)))
    want = float(exact.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))
    assert got == want


# --- staging checks against a brute-force per-day implementation (pandas) -----------------

import pandas as pd  # noqa: E402

from obsmart.operators.quality import staging_violations  # noqa: E402

DAYS = [date(2026, 3, 1), date(2026, 3, 2), date(2026, 3, 3)]      # the last one stays empty
EXPECTED = {"a", "b"}
LOW, HIGH = 0.0, 10.0

row = st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from(DAYS[:2]),
                st.one_of(st.none(), st.integers(min_value=0, max_value=23)),
                st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 5.0, 10.0, 11.0])))


def brute_checks(rows) -> set:
    """Each rule from its definition, over plain (place, day, hour, value) tuples."""
    by_day = {d: [r for r in rows if r[1] == d] for d in DAYS}
    out = {(d, "empty", None, None, 0.0) for d, rs in by_day.items() if not rs}
    for d, rs in by_day.items():
        if rs:
            count = len(rs)
            numbers = {
                ("null_key", "city"): sum(r[0] is None for r in rs), ("null_key", "ts"): sum(r[2] is None for r in rs),
                ("duplicates", None): count - len({(r[0], r[2]) for r in rs}),
                ("out_of_range", "v"): sum(r[3] is not None and not LOW <= r[3] <= HIGH for r in rs)}
            out |= {(d, rule, field, None, float(n)) for (rule, field), n in numbers.items() if n}
            absent = sum(r[3] is None for r in rs)
            if absent * 20 > count:
                out.add((d, "null_share", "v", None, round(absent / count, 9)))
            places = {r[0] for r in rs} - {None}
            out |= {(d, "missing_entity", "city", p, 0.0) for p in EXPECTED - places}
            hours = {p: len({r[2] for r in rs if r[0] == p and r[2] is not None}) for p in places}
            out |= {(d, "incomplete_hours", "ts", p, float(n)) for p, n in hours.items() if n != 24}
    return out


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=60))
def test_staging_checks_match_brute_force(spark, rows):
    from datetime import datetime
    data = [(c, d, None if h is None else datetime(d.year, d.month, d.day, h), v) for c, d, h, v in rows]
    sdf = spark.createDataFrame(data, "city string, dt date, ts timestamp_ntz, v double")
    exp = spark.createDataFrame([(e,) for e in sorted(EXPECTED)], "city string")
    got = {(r.dt, r.rule, r.field, r.entity,
            round(r.observed, 9) if r.rule == "null_share" else r.observed)
           for r in staging_violations(sdf, start=DAYS[0], end=DAYS[-1], expected=exp, metrics=["v"],
                                       ranges={"v": (LOW, HIGH)}).collect()}
    assert got == brute_checks(rows)


# --- trailing calendar norm against pandas' time-based rolling window -----------------------

from obsmart.operators.norms import trailing_norm  # noqa: E402


@SETTINGS
@given(present=st.lists(st.booleans(), min_size=40, max_size=90),
       values=st.lists(st.one_of(st.none(), st.floats(min_value=-50, max_value=50, allow_nan=False)),
                       min_size=90, max_size=90))
def test_trailing_norm_matches_pandas_rolling(spark, present, values):
    start = date(2025, 1, 1)
    rows = [(start + timedelta(days=i), "a", values[i]) for i, p in enumerate(present) if p]
    if not rows:
        return
    sdf = spark.createDataFrame(rows, "dt date, city string, temp_avg double")
    got = {r.dt: r.temp_norm_30d for r in trailing_norm(sdf, entity="city").collect()}
    s = pd.Series([v if v is not None else float("nan") for _, _, v in rows],
                  index=pd.to_datetime([d for d, _, _ in rows]), dtype="float64")
    want = s.rolling("30D", closed="left", min_periods=25).mean()
    for (d, _, _), w in zip(rows, want):
        g = got[d]
        if pd.isna(w):
            assert g is None
        else:
            assert g is not None and abs(g - w) < 1e-9


# --- keep-last against pandas drop_duplicates(keep="last") in concatenation order ------------

from obsmart.operators.normalize import keep_last  # noqa: E402


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(min_value=0, max_value=5),
                               st.one_of(st.none(), st.floats(min_value=-5, max_value=5, allow_nan=False))),
                     min_size=1, max_size=50))
def test_keep_last_matches_pandas(spark, rows):
    data = [(c, h, v, pos) for pos, (c, h, v) in enumerate(rows)]
    sdf = spark.createDataFrame(data, "city string, h int, v double, pos long").repartition(4)
    got = sorted((r.city, r.h, r.v) for r in keep_last(sdf, ["city", "h"], ["pos"]).collect())
    pdf = pd.DataFrame(data, columns=["city", "h", "v", "pos"]).drop_duplicates(["city", "h"], keep="last")
    want = sorted((c, h, None if pd.isna(v) else v) for c, h, v in zip(pdf.city, pdf.h, pdf.v))
    assert got == want
