"""Writers. Every write is idempotent: re-running a period replaces exactly its partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obsmart.operators.calendar import check_period, day_list
from obsmart.session import cut_lineage
from obsmart.sinks.folders import drop_folders, drop_partitions, folders, is_empty
from obsmart.sources.raw import LOG, raw_files, read_landings, superseded


def _observed_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def one_payload_each(payloads: DataFrame, entity: str) -> DataFrame:
    """(range, <entity>, body), one per range and entity: the last by ``landing`` if there is one,
    then by row order. Line breaks, which JSON text holds between tokens only, become spaces."""
    order = [c for c in ("landing",) if c in payloads.columns] + ["_row"]
    rows = payloads.withColumn("_row", F.monotonically_increasing_id())
    last = rows.groupBy("range", entity).agg(F.max_by("body", F.struct(*order)).alias("body"))
    return last.withColumn("body", F.translate("body", "\r\n", "  "))


def _write_payloads(payloads: DataFrame, path: str, entity: str, layout: str) -> int:
    """(range, <entity>, landing, body) into their folders (dynamic overwrite); how many."""
    if layout == "folders":
        out, obs = _observed_rows(payloads.select("range", entity, "landing", "body"), "write_raw")
        (out.repartition("range", entity).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("range", entity, "landing").text(path))
        return int(obs.get["rows"])
    if layout != "lines":
        raise ValueError("layout must be 'folders' or 'lines'")
    # {"<entity>": "<key>"} with JSON escaping, reopened (its closing brace dropped) so the
    # payload object can follow as a second member.
    head = F.to_json(F.struct(F.col(entity).cast("string").alias(entity)))
    line = F.concat(F.expr("substring(_head, 1, length(_head) - 1)"), F.lit(', "payload": '),
                    F.col("body"), F.lit("}"))
    out = payloads.select("range", "landing", head.alias("_head"), "body").select("range", "landing", line.alias("value"))
    out, obs = _observed_rows(out, "write_raw")
    (out.hint("rebalance", "range", "landing").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("range", "landing").text(path))
    return int(obs.get["rows"])


def _log(rows: DataFrame, path: str, entity: str) -> None:
    """(landing, range, <entity>) into the landing log; a landing's earlier rows are replaced."""
    rows = rows.select("range", F.col(entity).cast("string").alias(entity), "landing")
    (rows.repartition("landing").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("landing").parquet(f"{path}/{LOG}"))


def next_landing(spark: SparkSession, path: str, entity: str = "city") -> int:
    """The number after the last landing in the log."""
    return (read_landings(spark, path, entity).agg(F.max("landing")).first()[0] or 0) + 1


def adopt_raw(spark: SparkSession, path: str, *, entity: str = "city", layout: str = "folders") -> int:
    """List the payloads of a layer without numbers in the landing log (as landing 0), so that later
    landings replace them. Returns how many."""
    files = raw_files(spark, sorted(folders(spark, path, "range").values()), entity=entity, layout=layout)
    rows = cut_lineage(files.where("landing = 0").select("landing", "range", entity).distinct(), required=True)
    n = rows.count()
    if n:
        _log(rows, path, entity)
    return n


def write_raw(payloads: DataFrame, path: str, *, entity: str = "city", layout: str = "folders",
              landing: int | None = None) -> int:
    """Payloads ``(range, <entity>, body)`` -> the raw layer, as one landing. Returns payloads written
    (counted while writing).

    ``landing``: its number; by default the one after the last. Writers that run at the same time
    must be given numbers. Repeating a number replaces what it has written in the same folders. The
    payloads are written first; the landing counts from when the log lists it, so a write that is cut
    off leaves nothing that readers see. Earlier landings are not read or rewritten (see
    ``compact_raw``). ``layout``: as in ``sources.raw``; ``lines`` is for very many entities, in files
    sized by AQE. Of several payloads of one (range, entity) the last is written and counted.
    """
    spark = payloads.sparkSession
    if is_empty(spark, f"{path}/{LOG}") and not is_empty(spark, path):
        adopt_raw(spark, path, entity=entity, layout=layout)
    n = landing if landing is not None else next_landing(spark, path, entity)
    if n < 1:
        raise ValueError("a landing's number must be 1 or more")
    payloads = one_payload_each(payloads, entity).withColumn("landing", F.lit(n).cast("long"))
    written = _write_payloads(payloads, path, entity, layout)
    if written:
        inner = f"landing={n}" if layout == "lines" else f"{entity}=*/landing={n}"
        _log(raw_files(spark, [f"{path}/range=*/{inner}"], entity=entity, layout=layout), path, entity)
    return written


def compact_raw(spark: SparkSession, path: str, start, end, *, entity: str = "city",
                layout: str = "folders") -> dict:
    """Remove the replaced payloads of every range that overlaps ``[start, end]``. What stays keeps
    its landing number. Landings of a range that lose some payloads are rewritten, those that lose
    all are dropped, and the log follows. Returns {"removed": payloads, "dropped": folders}."""
    s, e = check_period(start, end)
    log = cut_lineage(read_landings(spark, path, entity), required=True)
    stale = cut_lineage(superseded(log, entity).where(
        (F.to_date(F.substring_index("range", "_", 1)) <= F.lit(e)) & (F.to_date(F.substring_index("range", "_", -1)) >= F.lit(s))), required=True)
    touched = [(r["range"], r.landing) for r in stale.select("range", "landing").distinct().collect()]     # folder names
    n = stale.count()
    if not touched:
        return {"removed": 0, "dropped": 0}
    numbers = [x for _, x in touched]
    if layout == "lines":
        paths = [f"{path}/range={r}/landing={x}" for r, x in touched if x]
        kept = raw_files(spark, paths, entity=entity, layout=layout).join(stale, ["range", entity, "landing"], "left_anti")
        kept = cut_lineage(kept.select("range", entity, "landing", "body"), required=True)
        left = {(r["range"], r.landing) for r in kept.select("range", "landing").distinct().collect()}
        _write_payloads(kept, path, entity, layout)
        gone = [f"range={r}/landing={x}" for r, x in touched if x and (r, x) not in left]
    else:
        escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        gone = [f"range={r['range']}/{entity}={escaped(r[entity])}/landing={r.landing}" for r in stale.where("landing > 0").collect()]
    dropped = drop_folders(spark, path, gone)
    rest = log.where(F.col("landing").isin(numbers)).join(stale.where("landing > 0"), ["range", entity, "landing"], "left_anti")
    _log(rest, path, entity)
    emptied = set(numbers) - {r.landing for r in rest.select("landing").distinct().collect()}
    drop_folders(spark, f"{path}/{LOG}", [f"landing={x}" for x in emptied])
    return {"removed": n, "dropped": len(dropped)}


def overwrite_days(df: DataFrame, path: str, *, day: str = "dt", sort_within=(),
                   compression: str = "snappy", period=None) -> int:
    """Replace the ``day=`` partitions present in ``df``; other days keep their files.

    The output is rebalanced on the day: AQE coalesces small days into one file each and
    splits a very large day over several tasks (unlike ``repartition(day)``, which sends a
    whole day to one task). ``sort_within`` orders rows inside each file (row-group
    statistics for later filters). Returns the rows written, counted while writing.

    ``period``: ``(start, end)`` that ``df`` stands for. Its days without rows are then removed, after
    the write has been committed, unless there is no row at all (an input that is empty as a whole is
    left to the caller to report). Without it such days keep their old files.
    """
    out = df.hint("rebalance", day)
    if sort_within:
        out = out.sortWithinPartitions(day, *sort_within)
    obs = Observation("overwrite_days")
    seen = [F.collect_set(F.when(F.col(day).between(*map(F.lit, check_period(*period))), F.col(day))).alias("days")] if period else []
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), *seen)      # at most the days of the period
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", compression).partitionBy(day).parquet(path))
    n = int(obs.get["rows"])
    if period and n:
        filled = set(obs.get["days"])
        drop_partitions(df.sparkSession, path, day, [d for d in day_list(*period) if d not in filled])
    return n


def append_months(df: DataFrame, path: str, *, month: str = "month", sort_within=()) -> int:
    """Append rows to a ``month=``-partitioned table (new versions; readers pick the latest)."""
    out = df.hint("rebalance", month)
    if sort_within:
        out = out.sortWithinPartitions(month, *sort_within)
    out, obs = _observed_rows(out, "append_months")
    out.write.mode("append").partitionBy(month).parquet(path)
    return int(obs.get["rows"])


def rewrite_months(df: DataFrame, path: str, *, month: str = "month", sort_within=(), months=None) -> int:
    """Replace whole month partitions with ``df`` (used by compaction). ``df`` usually reads
    the same path, so it is first cut from its lineage into the shared checkpoint folder.
    ``months``: the months that ``df`` stands for; those without rows are removed after the write."""
    df = cut_lineage(df, required=True)
    out = df.hint("rebalance", month)
    if sort_within:
        out = out.sortWithinPartitions(month, *sort_within)
    obs = Observation("rewrite_months")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set(month).alias("months"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(month).parquet(path))
    drop_partitions(df.sparkSession, path, month, sorted(set(months or ()) - set(obs.get["months"])))
    return int(obs.get["rows"])
