"""Order columns packed into one value: the same order as the columns, and a hash aggregate."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from obsmart.operators.normalize import clean, keep_last, packed_order
from obsmart.plans import catalog
from tests.test_plans import SF, plan_of

KINDS = {
    "boolean": [None, False, True],
    "tinyint": [None, -128, -1, 0, 127],
    "smallint": [None, -(2 ** 15), 0, 2 ** 15 - 1],
    "int": [None, -(2 ** 31), -1, 0, 1, 2 ** 31 - 1],
    "bigint": [None, -(2 ** 63), -1, 0, 1, 2 ** 63 - 1],
    "date": [None, dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(9999, 12, 31)],
    "timestamp_ntz": [None, dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 3, 31, 2, 30, 0, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999)],
}


def rank(v):
    return (v is not None, v if v is not None else 0)


@pytest.mark.parametrize("kinds,packs", [(("bigint", "date", "int"), "decimal(38,0)"), (("date", "int"), "bigint"), (("boolean", "tinyint", "smallint", "int"), "bigint"),
                                         (("int", "bigint", "tinyint"), "decimal(38,0)"), (("timestamp_ntz", "bigint"), "decimal(38,0)"), (("smallint", "timestamp_ntz"), "decimal(38,0)"),
                                         (("timestamp_ntz",), "bigint"), (("bigint", "bigint"), None), (("timestamp_ntz", "timestamp_ntz", "bigint"), None)])
def test_same_order(spark, kinds, packs):
    rng = random.Random(1)
    rows = [tuple(rng.choice(KINDS[k]) for k in kinds) for _ in range(120)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} {k}" for i, k in enumerate(kinds)))
    packed = packed_order([F.col(c) for c in df.columns], [f.dataType for f in df.schema.fields])
    if packs is None:
        assert packed is None
        return
    out = df.withColumn("p", packed)
    assert out.schema["p"].dataType.simpleString() == packs
    got = out.collect()
    by_value = sorted({tuple(map(rank, r[:-1])): r.p for r in got}.items())
    assert [p for _, p in by_value] == sorted({p for _, p in by_value})      # strictly increasing with the values


def test_instants_follow_the_instant(spark):
    df = spark.createDataFrame([(1, 5), (1, 4), (0, 9)], "s bigint, n int").select(F.timestamp_seconds("s").alias("t"), "n")
    out = df.withColumn("p", packed_order([F.col("t"), F.col("n")], [f.dataType for f in df.schema.fields])).orderBy("p").collect()
    assert [r.n for r in out] == [9, 4, 5]


def test_values_beyond_the_calendar_fail(spark):
    df = spark.sql("SELECT 1 AS k, date_add(DATE '9999-12-31', 1) AS d, 1 AS n, 2.0D AS x")
    with pytest.raises(PySparkException, match="years 1 to 9999"):
        keep_last(df, ["k"], ["d", "n"]).collect()


def test_text_has_no_packed_form(spark):
    df = spark.createDataFrame([(1, "a", 2, "x"), (1, "b", 1, "y")], "k int, s string, n int, t string")
    assert packed_order([F.col("s")], [df.schema["s"].dataType]) is None
    assert keep_last(df, ["k"], ["s", "n"]).first().t == "y" and keep_last(df, ["k"], ["n"]).first().t == "x"
    assert keep_last(df, ["k"], ["n", "s", "t"]).first().s == "a"            # the order is the row


def test_hash_aggregates(spark):
    rows = catalog.events_rows(spark, SF).withColumn("landing", F.lit(1).cast("long"))
    for df in (clean(rows, keys=("event_type", "ts")), catalog.q_serving_reload(spark, SF)):
        plan = plan_of(df)
        keep = [x for x in plan.splitlines() if "max_by" in x]
        assert keep and all("HashAggregate" in x for x in keep)
