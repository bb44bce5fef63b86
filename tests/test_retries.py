"""Failed task attempts are retried without duplicating rows or counts (separate JVM with
task retries enabled; a failure is injected into the first attempt of one task)."""

import json
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import json, sys
    sys.path.insert(0, sys.argv[1])
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F, types as T
    from obsmart.sinks.lake import overwrite_days
    from obsmart.plans.mart import build_mart
    from obsmart.schemas import Roles, DailySpec

    spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())

    @F.udf(T.BooleanType())
    def flaky(x):
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        return True

    rows = (spark.range(0, 48000, numPartitions=4)
            .select((F.col("id") % 20).cast("string").alias("city"),
                    F.timestamp_seconds(F.lit(1735689600) + (F.col("id") / 20).cast("long") * 3600).alias("ts"),
                    (F.col("id") % 97).cast("double").alias("t"))
            .where(flaky("id")))
    out = sys.argv[2]
    n = overwrite_days(rows.withColumn("dt", F.to_date("ts")), out + "/staging")
    back = spark.read.parquet(out + "/staging")
    spec = DailySpec(aggs=(("t_avg", "avg", "t"),), count_col="hours_count", value="t_avg",
                     norm="t_norm", anomaly="t_anom")
    m = overwrite_days(build_mart(back, roles=Roles(entity="city", ts="ts", day="dt", metrics=("t",)),
                                  spec=spec, processed_at=None), out + "/mart")
    print(json.dumps({"written": n, "read": back.count(),
                      "distinct": back.select("city", "ts").distinct().count(), "mart": m}))
""")


def test_retried_tasks_do_not_duplicate(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT)
    proc = subprocess.run([sys.executable, str(script), ROOT, str(tmp_path)], capture_output=True,
                          text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    assert "injected task failure" in proc.stderr          # a task attempt really failed
    result = json.loads(proc.stdout.strip().splitlines()[-1])
    assert result == {"written": 48000, "read": 48000, "distinct": 48000, "mart": 20 * 100}
