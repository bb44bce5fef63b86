"""Raw layer: column-oriented JSON payloads, one per entity and period, numbered as they land.

Every write is a *landing* with a sequence number. Payloads are stored under their number, and
``<root>/_landings`` (the landing log) lists which landing brought which range and entity:

* ``layout="folders"``: ``range=<start>_<end>/<entity>=<key>/landing=<n>/``, one payload a file;
* ``layout="lines"``: ``range=<start>_<end>/landing=<n>/``, JSON lines.

Nothing that has landed is rewritten: a corrected payload is a later landing, and readers leave out
the payloads that a later landing of the same range and entity has replaced. The numbers are part
of the layer, so a copied, merged or compacted lake keeps its order, which file times do not. Layers
of the original pipeline (``range=.../<entity>=<key>.json``, no numbers) are read as they are: the
file time orders them, below every numbered landing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.functions.text import join_values
from obsmart.operators.calendar import as_day, check_period, month_chunks_between
from obsmart.operators.normalize import keep_last
from obsmart.sinks.folders import folders, is_empty

RANGE_PATTERN = r"^(\d{4}-\d{2}-\d{2})_(\d{4}-\d{2}-\d{2})$"
LOG = "_landings"


def range_key(start, end) -> str:
    start, end = check_period(start, end)
    return f"{start:%Y-%m-%d}_{end:%Y-%m-%d}"


def read_landings(spark: SparkSession, path: str, entity: str = "city") -> DataFrame:
    """The landing log: (landing, range, <entity>); payloads without a number are landing 0 once
    the layer has been adopted (``sinks.lake.adopt_raw``)."""
    schema = f"range string, `{entity}` string, landing bigint"
    if is_empty(spark, f"{path}/{LOG}"):
        return spark.createDataFrame([], schema).select("landing", "range", entity)
    return spark.read.schema(schema).parquet(f"{path}/{LOG}").select("landing", "range", entity)


def superseded(landings: DataFrame, entity: str = "city") -> DataFrame:
    """(range, <entity>, landing) of the payloads that a later landing has replaced."""
    last = landings.groupBy("range", entity).agg(F.max("landing").alias("_last"), F.min("landing").alias("_first"))
    again = last.where("_first < _last").select("range", entity, "_last")
    return landings.join(again, ["range", entity]).where("landing < _last").select("range", entity, "landing")


def _unescaped(c: Column) -> Column:
    return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def _wanted_ranges(spark: SparkSession, path: str, start, end, all_ranges: bool, ranges) -> list[str]:
    """Paths of the range folders to read: those that are there and asked for, by their names."""
    there = folders(spark, path, "range")
    if ranges is not None:
        keys = [range_key(s, e) for s, e in ranges]
    elif start is None and end is None:
        keys = sorted(there)
    elif all_ranges:
        s, e = check_period(start, end)
        bounds = {k: k.split("_") for k in sorted(there) if k.count("_") == 1}
        keys = [k for k, (a, b) in bounds.items() if as_day(a) <= e and as_day(b) >= s]
    else:
        keys = [range_key(start, end)]
    return [there[k] for k in dict.fromkeys(keys) if k in there]


def raw_files(spark: SparkSession, paths: list[str], *, entity: str = "city", layout: str = "folders") -> DataFrame:
    """All payloads below ``paths``: (range, <entity>, landing, body, _file_time). What a path says
    is text (``007`` stays ``007``); a file without a number has landing 0."""
    if not paths:
        return spark.createDataFrame([], f"range string, `{entity}` string, landing bigint, body string, _file_time timestamp")
    lines = layout == "lines"
    df = spark.read.option("recursiveFileLookup", True).text(paths, wholetext=not lines)
    where = F.col("_metadata.file_path")

    def said(name: str) -> Column:
        return F.regexp_extract(where, f"/{name}=([^/]*)/", 1)

    if lines:
        key, body = F.get_json_object("value", f"$.{entity}"), F.get_json_object("value", "$.payload")
    else:
        of_file = F.regexp_extract(where, rf"/(?:{entity}=)?([^/]*)\.json$", 1)
        folder = _unescaped(_unescaped(said(entity)))          # of a URI, then of a folder name
        key = F.when(folder == "", _unescaped(of_file)).otherwise(folder)
        key, body = F.when(key != "__HIVE_DEFAULT_PARTITION__", key), F.col("value")
    number = F.coalesce(F.expr("try_cast(nullif(_landing, '') AS bigint)"), F.lit(0))
    return (df.select(said("range").alias("range"), key.alias(entity), said("landing").alias("_landing"),
                      body.alias("body"), F.col("_metadata.file_modification_time").alias("_file_time"))
            .select("range", entity, number.alias("landing"), "body", "_file_time"))


def read_raw(spark: SparkSession, path: str, start=None, end=None, *, entity: str = "city",
             all_ranges: bool = False, layout: str = "folders", ranges=None, history: bool = False) -> DataFrame:
    """Payload rows ``(range, range_start, range_end, <entity>, landing, body)``, of every range and
    entity the one that landed last (``history=True``: all).

    By default only the folder of exactly ``[start, end]`` is listed and read. ``all_ranges=True``
    reads every range that overlaps the period; overlapping hours are then resolved by
    ``payload_order`` (the payload that landed last wins). ``ranges``: exactly these ``(start, end)``
    ranges (e.g. the month chunks of a backfill), all in one scan. ``landing`` orders payloads: the
    landing number, or for files without one their time, below every number.
    """
    files = raw_files(spark, _wanted_ranges(spark, path, start, end, all_ranges, ranges), entity=entity, layout=layout)
    landings = read_landings(spark, path, entity)
    if not is_empty(spark, f"{path}/{LOG}"):
        # a landing that is not in the log has not been committed; the list of replaced payloads is
        # short (corrections only), so the payloads themselves are not shuffled
        done = landings.agg(F.max("landing")).first()[0] or 0
        files = files.where(F.col("landing") <= done)
        if not history:
            files = files.join(superseded(landings, entity), ["range", entity, "landing"], "left_anti")
    early = F.unix_micros("_file_time") - F.lit(1 << 62)
    return files.select(
        "range",
        F.to_date(F.regexp_extract("range", RANGE_PATTERN, 1)).alias("range_start"),
        F.to_date(F.regexp_extract("range", RANGE_PATTERN, 2)).alias("range_end"),
        entity, F.when(F.col("landing") > 0, F.col("landing")).otherwise(early).alias("landing"), "body")


def triage(landed: DataFrame, *, status: str = "status", body: str = "body") -> DataFrame:
    """Classify landed responses: ``retry`` (no status, 429 or >= 500), ``fatal`` (other
    >= 400, no JSON object in the body, or a body whose ``error`` is set), else ``good``;
    ``reason`` says why (status and the whole body, or the payload's own reason)."""
    s = F.col(status)
    b = F.col(body)
    error = F.lower(F.trim(F.get_json_object(b, "$.error")))
    is_error_body = F.coalesce(~error.isin("false", "0", "", "null", "no"), F.lit(False))
    # a body must be one whole JSON object: cut-off text does not parse
    malformed = b.isNull() | ~F.trim(b).startswith("{") | F.try_parse_json(b).isNull()
    outcome = (F.when(s.isNull(), F.lit("retry"))
               .when((s == 429) | (s >= 500), F.lit("retry"))
               .when(s >= 400, F.lit("fatal"))
               .when(malformed | is_error_body, F.lit("fatal"))
               .otherwise(F.lit("good")))
    reason = (F.when(s.isNull(), F.lit("no response"))
              .when(s >= 400, F.concat_ws(": ", s.cast("string"), b))
              .when(malformed, F.lit("malformed body"))
              .when(is_error_body, F.coalesce(F.get_json_object(b, "$.reason"), error)))
    return landed.withColumns({"outcome": outcome, "reason": reason})


def fetch_plan(places: DataFrame, start, end, variables, *, entity: str = "slug",
               params=("lat", "lon"), timezone: str = "UTC") -> DataFrame:
    """One request per place and calendar-month chunk of ``[start, end]``.

    ``start``/``end`` are dates (one period for all) or column names / Columns (a period per
    place). Generated per place row; no join.
    """
    if not isinstance(start, (Column, str)) or not isinstance(end, (Column, str)):
        check_period(start, end)
    chunks = month_chunks_between(start, end)
    return places.select(
        entity, *[p for p in params if p in places.columns], F.inline(chunks),
        join_values(variables).alias("variables"), F.lit(timezone).alias("timezone"),
    )


def land_payloads(obs: DataFrame, *, entity: str, ts: str, metrics: dict[str, str],
                  order=None, period: str = "day", time_format: str = "yyyy-MM-dd'T'HH:mm") -> DataFrame:
    """Observations -> column-oriented payloads, one per (entity, period), as the source API
    delivers them: ``hourly.time`` lists every hour of the period, and each variable array
    holds the last observation of that hour (by ``order``) or null.

    ``metrics`` maps table column -> payload variable. Two aggregation steps: the last value
    per (entity, hour) combines map-side, so the payload step only gathers at most one value
    per hour of the period (24 per day, 744 per month) whatever the input skew. The dense
    arrays are built in linear time from the hours sorted once: each observed value is
    preceded by nulls for the hours missing before it, and the tail is padded.
    """
    if period not in ("day", "month"):
        raise ValueError("period must be 'day' or 'month'")
    hour = F.date_trunc("hour", F.col(ts))
    hourly = obs.select(F.col(entity).alias("_e"), hour.alias("_h"),
                        *[F.col(c).alias(f"_m{i}") for i, c in enumerate(metrics)],
                        *([F.col(o).alias(f"_o{j}") for j, o in enumerate(order)] if order else []))
    order_cols = [f"_o{j}" for j in range(len(order))] if order else ["_h"]
    hourly = keep_last(hourly.where(F.col("_e").isNotNull() & F.col("_h").isNotNull()),
                       ["_e", "_h"], order_cols)
    first = F.to_date("_h") if period == "day" else F.trunc(F.to_date("_h"), "MM")
    idx = F.datediff(F.to_date("_h"), F.col("_ps")) * 24 + F.hour("_h")
    grouped = (hourly.withColumn("_ps", first)
               .groupBy("_e", "_ps")
               .agg(F.array_sort(F.collect_list(F.struct(
                   idx.alias("i"), *[F.col(f"_m{i}").alias(f"v{i}") for i in range(len(metrics))])))
                   .alias("_s")))
    last_day = F.col("_ps") if period == "day" else F.last_day("_ps")
    n_hours = F.datediff(F.date_add(last_day, 1), F.col("_ps")) * 24
    ts_type = hourly.schema["_h"].dataType
    start_ts = F.col("_ps").cast(ts_type)
    hours = F.sequence(start_ts, F.date_add(last_day, 1).cast(ts_type) - F.expr("INTERVAL 1 HOUR"),
                       F.expr("INTERVAL 1 HOUR"))
    arrays = [F.transform(hours, lambda t: F.date_format(t, time_format)).alias("time")]

    def dense(i):
        s = F.col("_s")
        nothing = F.lit(None).cast(hourly.schema[f"_m{i}"].dataType)

        def piece(x, j):
            prev_end = F.when(j == 0, F.lit(0)).otherwise(F.get(s, j - 1).getField("i") + 1)
            return F.concat(F.array_repeat(nothing, x.getField("i") - prev_end),
                            F.array(x.getField(f"v{i}")))
        tail = n_hours - (F.element_at(s, -1).getField("i") + 1)
        return F.concat(F.flatten(F.transform(s, piece)), F.array_repeat(nothing, tail))

    for i, var in enumerate(metrics.values()):
        arrays.append(dense(i).alias(var))
    body = F.to_json(F.struct(F.struct(*arrays).alias("hourly")))
    return grouped.select(
        F.concat_ws("_", F.date_format("_ps", "yyyy-MM-dd"), F.date_format(last_day, "yyyy-MM-dd")).alias("range"),
        F.col("_ps").alias("range_start"), last_day.alias("range_end"),
        F.col("_e").cast("string").alias(entity), body.alias("body"))
