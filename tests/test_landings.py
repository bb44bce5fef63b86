"""The landing log: what landed last wins, whatever happens to files afterwards."""

import json
import os
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from obsmart.operators.normalize import assign_day, clean, unpivot_arrays
from obsmart.sinks.lake import adopt_raw, compact_raw, next_landing, write_raw
from obsmart.sources.raw import read_landings, read_raw

WHOLE = ("2025-01-01", "2025-02-28")
JAN, FEB = ("2025-01-01", "2025-01-31"), ("2025-02-01", "2025-02-28")


def body(value, day="2025-01-05"):
    return json.dumps({"hourly": {"time": [f"{day}T00:00"], "x": [value]}})


def land(spark, path, period, layout, landing=None, **values):
    rows = [("_".join(period), c, body(v)) for c, v in values.items()]
    return write_raw(spark.createDataFrame(rows, "range string, city string, body string"), path, layout=layout, landing=landing)


def values(spark, path, layout, **kw):
    raw = read_raw(spark, path, *WHOLE, all_ranges=True, layout=layout, **kw)
    rows = clean(assign_day(unpivot_arrays(raw, {"x": "x"}, keep=("landing", "range_end", "city"), ts="ts"), "ts", "dt"))
    return {r.city: r.x for r in rows.collect()}


@pytest.mark.parametrize("layout", ["folders", "lines"])
def test_a_payload_does_not_get_younger_by_its_neighbours(spark, scratch, layout):
    """A range lands as a whole (a 1, b 1), then b's chunk (2), then the whole range for a alone (3)."""
    land(spark, scratch, WHOLE, layout, a=1, b=1)
    land(spark, scratch, JAN, layout, b=2)
    land(spark, scratch, WHOLE, layout, a=3)
    assert values(spark, scratch, layout) == {"a": 3.0, "b": 2.0}
    copy = f"{scratch}-copy"
    for d, _, files in os.walk(scratch):                # a copied lake: all files get new times, in any order
        for f in sorted(files, reverse=True):
            os.makedirs(d.replace(scratch, copy, 1), exist_ok=True)
            shutil.copyfile(f"{d}/{f}", f"{d.replace(scratch, copy, 1)}/{f}")
    assert values(spark, copy, layout) == {"a": 3.0, "b": 2.0}


@pytest.mark.parametrize("layout", ["folders", "lines"])
def test_compaction_keeps_numbers_and_drops_what_was_replaced(spark, scratch, layout):
    land(spark, scratch, WHOLE, layout, a=1, b=1, c=1)
    land(spark, scratch, JAN, layout, b=2, c=2)
    land(spark, scratch, WHOLE, layout, a=3)
    land(spark, scratch, JAN, layout, b=4, c=4)             # landing 2 is replaced altogether
    land(spark, scratch, FEB, layout, **{"odd/key=%+ é": 5})
    before = values(spark, scratch, layout)
    assert before == {"a": 3.0, "b": 4.0, "c": 4.0, "odd/key=%+ é": 5.0}
    assert read_raw(spark, scratch, *WHOLE, layout=layout, history=True).count() == 4
    done = compact_raw(spark, scratch, *WHOLE, layout=layout)
    assert done == {"removed": 3, "dropped": 1 if layout == "lines" else 3}
    assert values(spark, scratch, layout) == before and values(spark, scratch, layout, history=True) == before
    log = sorted((r.landing, r["range"], r.city) for r in read_landings(spark, scratch).collect())
    whole, jan, feb = ("_".join(p) for p in (WHOLE, JAN, FEB))
    assert log == [(1, whole, "b"), (1, whole, "c"), (3, whole, "a"), (4, jan, "b"), (4, jan, "c"), (5, feb, "odd/key=%+ é")]
    assert compact_raw(spark, scratch, *WHOLE, layout=layout)["removed"] == 0
    assert next_landing(spark, scratch) == 6


def test_a_landing_counts_when_the_log_lists_it(spark, scratch, monkeypatch):
    from obsmart.sinks import lake

    land(spark, scratch, JAN, "lines", a=1)
    with monkeypatch.context() as m:
        m.setattr(lake, "_log", lambda *args: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            land(spark, scratch, JAN, "lines", a=2)
    assert values(spark, scratch, "lines") == {"a": 1.0}
    land(spark, scratch, JAN, "lines", a=3)                 # the number is used again, its files are replaced
    assert values(spark, scratch, "lines") == {"a": 3.0} and read_landings(spark, scratch).count() == 2


def test_a_repeated_number_replaces_itself(spark, scratch):
    for v in (1, 2):
        assert land(spark, scratch, JAN, "folders", landing=7, a=v) == 1
    assert values(spark, scratch, "folders") == {"a": 2.0} and next_landing(spark, scratch) == 8
    with pytest.raises(ValueError):
        land(spark, scratch, JAN, "folders", landing=0, a=1)


def test_a_layer_without_numbers_is_adopted(spark, scratch):
    folder = f"{scratch}/range={'_'.join(JAN)}"
    os.makedirs(folder)
    for name, v in (("a.json", 1), ("city=b.json", 2), ("c.json", 3)):
        with open(f"{folder}/{name}", "w") as f:
            f.write(body(v))
    assert values(spark, scratch, "folders") == {"a": 1.0, "b": 2.0, "c": 3.0}
    land(spark, scratch, JAN, "folders", b=9)               # lists the others as landing 0 first
    assert read_landings(spark, scratch).where("landing = 0").count() == 3
    assert values(spark, scratch, "folders") == {"a": 1.0, "b": 9.0, "c": 3.0}
    assert read_raw(spark, scratch, *JAN).count() == 3 and adopt_raw(spark, scratch) == 3


def test_only_wanted_ranges_are_listed(spark, scratch):
    for k, period in enumerate((WHOLE, JAN, FEB)):
        land(spark, scratch, period, "folders", a=k)
    files = read_raw(spark, scratch, *JAN).inputFiles()
    assert all("range=2025-01-01_2025-01-31" in f or "_landings" in f for f in files) and len(files) > 0
    assert read_raw(spark, scratch, "2031-01-01", "2031-01-02").isEmpty()
    assert read_raw(spark, scratch, date(2025, 2, 3), date(2025, 2, 4), all_ranges=True).select(F.count_distinct("range")).first()[0] == 2
    assert read_raw(spark, f"{scratch}/none").isEmpty()
