"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Binary size units of a human-readable size, in increasing order.
SIZE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")


def readable_size(c) -> Column:
    """Bytes -> '12.34 MiB' (powers of 1024, two decimals)."""
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    expr = None
    for i in range(len(SIZE_UNITS) - 1, -1, -1):
        text = F.format_string(f"%.2f {SIZE_UNITS[i]}", c / F.lit(float(1024 ** i)))
        cond = c >= F.lit(float(1024 ** i)) if i else F.lit(True)
        expr = F.when(cond, text) if expr is None else expr.when(cond, text)
    return F.when(c.isNotNull(), expr.otherwise(F.format_string("%.2f B", c)))


def join_values(values, sep: str = ",") -> Column:
    """Join literal values (e.g. requested variables) into one text column."""
    return F.concat_ws(sep, *[F.lit(v) for v in values])
