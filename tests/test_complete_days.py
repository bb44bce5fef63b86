"""Days of a stream are released once, by the batch that completes them or by the watermark."""

import json
import os
from datetime import date

from pyspark.sql import functions as F

from obsmart.streaming.complete_days import complete_days


def drop_file(folder, n, rows):
    with open(f"{folder}/.tmp", "w") as f:
        f.writelines(json.dumps({"city": c, "ts": t}) + "\n" for c, t in rows)
    os.rename(f"{folder}/.tmp", f"{folder}/{n:03}.json")


def hours(city, day, which):
    return [(city, f"{day}T{h:02}:00:00Z") for h in which]


def run(spark, folder, out, ck):
    stream = spark.readStream.schema("city string, ts timestamp").option("maxFilesPerTrigger", 1).json(folder)
    (complete_days(stream, delay="2 days").writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
     .trigger(availableNow=True).start().awaitTermination())
    if not os.path.exists(f"{out}/_spark_metadata"):
        return []
    return sorted((r.city, r.dt, r.hours, r.complete) for r in spark.read.parquet(out).collect())


def test_a_day_is_released_once(spark, scratch):
    folder, out, ck = (f"{scratch}/{n}" for n in ("in", "out", "ck"))
    os.makedirs(folder)
    drop_file(folder, 1, hours("a", "2025-03-01", range(0, 10)) + hours("b", "2025-03-01", range(24)) + [("c", None), (None, "2025-03-01T00:00:00Z")])
    assert run(spark, folder, out, ck) == [("b", date(2025, 3, 1), 24, True)]
    drop_file(folder, 2, hours("a", "2025-03-01", range(8, 20)) + hours("b", "2025-03-01", [3]))
    drop_file(folder, 3, hours("a", "2025-03-01", range(20, 24)) + hours("c", "2025-03-02", range(23)))
    first = [("a", date(2025, 3, 1), 24, True), ("b", date(2025, 3, 1), 24, True)]
    assert run(spark, folder, out, ck) == first
    drop_file(folder, 4, hours("a", "2025-03-01", [5]) + hours("d", "2025-03-08", [0]))       # the watermark passes c's day
    drop_file(folder, 5, hours("d", "2025-03-08", [1]))
    assert run(spark, folder, out, ck) == [*first, ("c", date(2025, 3, 2), 23, False)]
    assert run(spark, folder, out, ck) == [*first, ("c", date(2025, 3, 2), 23, False)]
    assert spark.read.parquet(out).select(F.count_distinct("city", "dt")).first()[0] == 3
