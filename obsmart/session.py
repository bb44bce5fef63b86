"""Session helpers: the settings the library relies on, applied only where unset."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

# Settings the library expects. They are applied only when the session has no value of its
# own, so a cluster's configuration always wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession, overrides: dict | None = None) -> SparkSession:
    """Apply DEFAULTS where unset (plus explicit ``overrides``) and return the session."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    for key, value in (overrides or {}).items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    The library never invents a folder of its own: on a cluster a machine-local path would
    be lost with the executor. Tests set the value before calling library code.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect: the server applies the setting itself
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


_warned_no_checkpoint = False


def cut_lineage(df, *, required: bool = False):
    """Reliable checkpoint of ``df`` into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint). Without a configured folder the frame
    is returned unchanged (Spark recomputes from lineage; a warning is logged once), unless
    ``required``.
    """
    global _warned_no_checkpoint
    if checkpoint_dir(df.sparkSession) is None:
        if required:
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required")
        if not _warned_no_checkpoint:
            logging.getLogger("obsmart").warning(
                "spark.checkpoint.dir is not set: intermediate results are recomputed instead "
                "of being read back from a checkpoint")
            _warned_no_checkpoint = True
        return df
    return df.checkpoint(eager=True)


def local_session(app: str = "obsmart", cores: int | str = "*", shuffle_partitions: int = 8,
                  checkpoint: str | None = None, extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
