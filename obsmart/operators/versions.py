"""Versioned rows: latest version per key, and casts to the serving types."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmart.functions.temporal import year_month
from obsmart.operators.normalize import keep_last


def latest(df: DataFrame, keys, version) -> DataFrame:
    """Of rows with equal ``keys`` keep the one with the greatest ``version`` columns
    (compared left to right; add a unique column last to break ties).

    An aggregate (``max_by``) rather than a ranking window: versions are combined map-side,
    and a key with many versions is never sorted whole in one task.
    """
    return keep_last(df, keys, version)


def conform(df: DataFrame, *, day: str = "dt", count_col: str = "hours_count",
            stamp_cols=("processed_at",), load_ts: datetime | None = None,
            loaded_at: str = "loaded_at", month: str = "month") -> DataFrame:
    """Casts of a mart frame to the serving types.

    ``day`` -> DATE; ``count_col`` -> INT (the number of rows of an entity-day grows with the
    data, so no narrower type; a value beyond INT fails the job); time stamps -> millisecond precision;
    ``loaded_at`` = ``load_ts`` (given, so that runs are reproducible); ``month`` = YYYYMM.
    """
    out = {day: F.col(day).cast("date")}
    if count_col in df.columns:
        c = F.col(count_col)
        out[count_col] = F.when(c > F.lit(2**31 - 1), F.raise_error(F.lit(f"{count_col} is beyond INT"))
                                ).otherwise(c).cast("int")
    for s in stamp_cols:
        if s in df.columns:
            out[s] = F.date_trunc("millisecond", F.col(s))
    df = df.withColumns(out)
    if load_ts is not None:
        df = df.withColumn(loaded_at, F.date_trunc("millisecond", F.lit(load_ts).cast("timestamp")))
    return df.withColumn(month, year_month(day))
