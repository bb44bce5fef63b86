"""The place (entity) dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsmart.schemas import DIMENSION_SCHEMA


def read_dimension(spark: SparkSession, path: str, fmt: str | None = None,
                   schema=DIMENSION_SCHEMA, key: str | None = None) -> DataFrame:
    """Read the dimension with an explicit schema.

    ``json`` / ``csv`` / ``parquet`` are read by Spark. ``yaml`` (a short configuration list,
    as the pipeline keeps its places) is parsed on the driver -- it is a configuration file of
    a few rows -- and becomes a DataFrame. The list is taken from ``key``, else from
    ``cities`` or ``places``, else from the only list in the file.
    """
    fmt = fmt or path.rsplit(".", 1)[-1].lower()
    if fmt in ("yaml", "yml"):
        import yaml  # optional dependency, only for this format

        with open(path, encoding="utf-8") as f:
            doc = yaml.safe_load(f) or {}
        items = _yaml_list(doc, key)
        names = schema.fieldNames()
        rows = [tuple(_coerce(item.get(n), schema[n].dataType) for n in names) for item in items]
        return spark.createDataFrame(rows, schema)
    if fmt == "csv":
        return spark.read.schema(schema).option("header", True).csv(path)
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    if fmt == "parquet":
        return spark.read.parquet(path).select(*schema.fieldNames())
    raise ValueError(f"unknown dimension format {fmt!r}")


def _yaml_list(doc, key):
    if isinstance(doc, list):
        return doc
    if key is not None:
        return doc.get(key) or []
    for name in ("cities", "places"):
        if name in doc:
            return doc[name] or []
    lists = [v for v in doc.values() if isinstance(v, list)]
    return lists[0] if len(lists) == 1 else []


def _coerce(value, dtype):
    if value is None:
        return None
    name = dtype.typeName()
    if name == "double":
        return float(value)
    if name in ("integer", "long"):
        return int(value)
    return str(value)
