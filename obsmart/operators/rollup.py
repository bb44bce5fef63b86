"""Hourly -> daily rollup and metric rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.functions.numeric import exact_avg, exact_sum, round_to, rounded_ratio, scaled_long

_PLAIN = {"min": F.min, "max": F.max, "avg": F.avg, "sum": F.sum, "count": F.count}
# Hidden per-row state of exact averages (integer sum and count), used for exact rounding.
_SUM, _CNT = "_exact_sum__", "_exact_cnt__"
_UNITS = "_units__"


def aggregate(fn: str, column, exact_scale: int | None = None) -> Column:
    """One named aggregate. With ``exact_scale``, ``sum``/``avg`` accumulate exact integers of
    that many decimals (order-independent results); otherwise plain double arithmetic."""
    c = F.col(column) if isinstance(column, str) else column
    if exact_scale is not None and fn == "sum":
        return exact_sum(c, exact_scale)
    if exact_scale is not None and fn == "avg":
        return exact_avg(c, exact_scale)
    try:
        return _PLAIN[fn](c)
    except KeyError:
        raise ValueError(f"unknown aggregate {fn!r}") from None


def daily(df: DataFrame, *, entity: str, day: str = "dt", attrs=(), aggs,
          count_col: str = "hours_count", exact_scale: int | None = None,
          keep_state: bool = False) -> DataFrame:
    """One row per (day, entity[, attributes]): row count plus the ``aggs`` triples
    ``(output, aggregate, input)``. Aggregates skip NULLs; a metric NULL all day gives NULL.

    All aggregates are algebraic, so Spark combines them map-side before the shuffle on the
    group key; a very large entity-day is reduced per partition before it is exchanged.
    With ``exact_scale`` and ``keep_state``, exact averages also keep their integer sum and
    count (hidden columns) so that ``round_metrics`` rounds them exactly.
    """
    exprs = [F.count(F.lit(1)).alias(count_col)]
    state = []
    present = set(df.columns)
    if exact_scale is not None:      # every value is turned into units, and checked, once
        df = df.withColumns({_UNITS + c: scaled_long(c, exact_scale) for c in dict.fromkeys(
            c for _, fn, c in aggs if fn in ("sum", "avg") and c in present)})
    for out, fn, column in aggs:
        if column in present:
            if exact_scale is not None and fn in ("sum", "avg"):
                total, n = F.sum(_UNITS + column), F.count(column)
                value = total.cast("double") / F.lit(float(10 ** exact_scale))
                exprs.append((value if fn == "sum" else F.try_divide(value, n.cast("double"))).alias(out))
                if keep_state and fn == "avg":
                    state += [total.alias(_SUM + out), n.alias(_CNT + out)]
            else:
                exprs.append(aggregate(fn, column).alias(out))
        else:  # a metric missing from the input gives a NULL aggregate (the gate reports it)
            exprs.append(F.lit(None).cast("double").alias(out))
    return df.groupBy(day, entity, *attrs).agg(*exprs, *state)


def round_metrics(df: DataFrame, columns, scale: int = 2, mode: str = "half_up",
                  exact_scale: int | None = None) -> DataFrame:
    """Round ``columns`` in one projection. Exact averages with kept state are rounded from
    their integer sum and count (the true average, half up or half to even); the state is dropped."""
    out = {}
    for c in columns:
        if c not in df.columns:
            continue
        if exact_scale is not None and _SUM + c in df.columns:
            out[c] = rounded_ratio(F.col(_SUM + c), F.col(_CNT + c), exact_scale, scale, mode)
        else:
            out[c] = round_to(c, scale, mode)
    df = df.withColumns(out)
    return df.drop(*[c for c in df.columns if c.startswith((_SUM, _CNT))])
