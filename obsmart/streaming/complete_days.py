"""Entity-days released by a stream once all their hours are there.

Hourly rows arrive in any order, over any number of batches, some of them twice. For every entity and
day the state holds which hours have come (one bit each) and whether the day has been released. A day
is released in the batch that completes it, once; a day that the watermark passes without being
complete is released then, with the hours it has, and its state is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from obsmart.schemas import HOURS_PER_DAY

STATE = "hours bigint, released boolean"


def complete_days(hourly: DataFrame, *, entity: str = "city", ts: str = "ts", delay: str = "3 days",
                  hours: int = HOURS_PER_DAY) -> DataFrame:
    """Streaming ``hourly`` rows (<entity> text, <ts> instant, UTC) -> (<entity>, dt, hours, complete),
    one row per entity and day. ``delay``: how long after its end a day is waited for (the watermark;
    rows later than that are left out by Spark). Rows without an entity or a time are left out.
    """
    rows = (hourly.withColumn("_at", F.col(ts).cast("timestamp")).where(F.col("_at").isNotNull() & F.col(entity).isNotNull())
            .withWatermark("_at", delay)
            .select("_at", F.col(entity).cast("string").alias("_who"), F.unix_seconds("_at").alias("_s"))
            .withColumn("_day", F.floor(F.col("_s") / 86400)).withColumn("_hour", F.floor(F.col("_s") / 3600) % 24))

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        who, day = key
        seen, released = state.get if state.exists else (0, False)
        late = state.hasTimedOut
        if not late:
            for batch in batches:
                for hour in set(batch["_hour"].tolist()):
                    seen |= 1 << int(hour)
        n = int(seen).bit_count()
        if not released and (late or n >= hours):
            yield pd.DataFrame({"_who": [who], "_day": [int(day)], "hours": [n], "complete": [n >= hours]})
            released = True
        if late:
            state.remove()
        else:
            state.update((int(seen), released))
            end = int((pd.Timestamp(0) + timedelta(days=int(day) + 1)).value // 1_000_000)
            state.setTimeoutTimestamp(max(end, state.getCurrentWatermarkMs() + 1))

    out = rows.groupBy("_who", "_day").applyInPandasWithState(
        follow, "_who string, _day bigint, hours int, complete boolean", STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("_who").alias(entity), F.date_from_unix_date(F.col("_day").cast("int")).alias("dt"), "hours", "complete")
