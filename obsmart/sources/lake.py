"""Day- and month-partitioned Parquet layers, and their partition inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.functions.text import readable_size
from obsmart.operators.calendar import check_period, lookback_start


def read_days(spark: SparkSession, path: str, start=None, end=None, *, lookback: int = 0,
              day: str = "dt") -> DataFrame:
    """A ``day=``-partitioned layer for ``[start - lookback, end]``.

    The filter is on the partition column, so only those folders are listed and read
    (``PartitionFilters`` in the plan). ``lookback`` widens the read for trailing windows;
    Catalyst cannot derive that bound itself because the period filter sits above the window.
    """
    df = spark.read.option("basePath", path).parquet(path)
    if start is None and end is None:
        return df
    start, end = check_period(start, end)
    return df.where(F.col(day).between(F.lit(lookback_start(start, lookback)), F.lit(end)))


def read_months(spark: SparkSession, path: str, start=None, end=None, *, day: str = "dt",
                month: str = "month") -> DataFrame:
    """A ``month=``-partitioned layer (YYYYMM) for ``[start, end]``: the day filter plus the
    derived month filter, so whole month folders are pruned."""
    df = spark.read.option("basePath", path).parquet(path)
    if start is None and end is None:
        return df
    start, end = check_period(start, end)
    lo, hi = start.year * 100 + start.month, end.year * 100 + end.month
    return df.where(F.col(month).between(lo, hi) & F.col(day).between(F.lit(start), F.lit(end)))


def _per_file(df: DataFrame, partition) -> DataFrame:
    """(partition, file, compressed, rows): counted by Spark, one group a file; no column is read."""
    return (df.select(partition.cast("string").alias("partition"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_size").alias("compressed"))
            .groupBy("partition", "file", "compressed").agg(F.count(F.lit(1)).alias("rows")))


def partition_inventory(spark: SparkSession, path: str, *, partition: str = "month",
                        newest: int = 12, uncompressed: bool = False) -> DataFrame:
    """Per partition: rows, parts (files), compressed bytes and their readable size; the newest
    ``newest`` partitions first.

    Files and their sizes are the scan's hidden metadata columns, rows are counted by Spark from a
    scan without columns, so any store that Spark reads will do. ``uncompressed``: also the bytes
    before compression, which only the Parquet footers tell; they are read on the executors (local
    paths and the stores that pyarrow knows). Files without rows are not counted.
    """
    return _inventory(_per_file(spark.read.option("basePath", path).parquet(path), F.col(partition)), newest, uncompressed)


def partition_inventory_of(spark: SparkSession, paths, *, newest: int = 12, uncompressed: bool = False) -> DataFrame:
    """Inventory of several tables; each table (its last path element) is one partition."""
    files = None
    for path in paths:
        f = _per_file(spark.read.parquet(path), F.lit(path.rstrip("/").rsplit("/", 1)[-1]))
        files = f if files is None else files.unionByName(f)
    return _inventory(files, newest, uncompressed)


def _inventory(files: DataFrame, newest: int, uncompressed: bool) -> DataFrame:
    kinds = {"rows": F.sum("rows"), "parts": F.count("file"), "compressed_bytes": F.sum("compressed")}
    if uncompressed:
        files = files.mapInArrow(_footer_sizes, "partition string, file string, compressed long, rows long, uncompressed long")
        kinds["uncompressed_bytes"] = F.sum("uncompressed")
    out = (files.groupBy("partition").agg(*[v.alias(k) for k, v in kinds.items()])
           .orderBy(F.col("partition").desc()).limit(newest))
    return out.withColumns({k[:-len("_bytes")]: readable_size(k) for k in kinds if k.endswith("_bytes")})


def _footer_sizes(batches):
    """The files with the uncompressed bytes of their row groups (Parquet footers, no data read)."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs
    from urllib.parse import unquote, urlsplit

    for batch in batches:
        sizes = []
        for uri in batch.column("file").to_pylist():
            if urlsplit(uri).scheme in ("", "file"):
                meta = pq.ParquetFile(unquote(urlsplit(uri).path)).metadata
            else:       # pyarrow knows s3a:// as s3://; credentials come from the executor's environment
                store, name = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
                meta = pq.ParquetFile(store.open_input_file(name)).metadata
            sizes.append(sum(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=[*batch.schema.names, "uncompressed"])
