"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_open: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder of the session's ``spark.checkpoint.dir``; where that is unset (as in tests), a
    folder beside the warehouse tables."""
    sc = spark.sparkContext
    found = (spark.conf.get("spark.checkpoint.dir", None)
             or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir())
    return found or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm_checkpoints"


def _remove(path: str, spark: SparkSession) -> None:
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    except Exception:  # noqa: BLE001 -- the session has ended: nothing to clean with
        pass


@atexit.register
def clear() -> None:
    """Delete the tables that this process has stored (at the end of the process)."""
    while _open:
        _remove(*_open.popitem())


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: lineage ends here, and the
    table outlives any executor. The files go with the process (:func:`clear`)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    _open[path] = spark
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def alone(make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, stored; the tables that were stored on the way are deleted at once."""
    before = set(_open)
    out = stored(make())
    last = next(reversed(_open))
    for path in [p for p in _open if p not in before and p != last]:
        _remove(path, _open.pop(path))
    return out
