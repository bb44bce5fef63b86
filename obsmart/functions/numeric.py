"""Numeric column functions with the missing-value rules of the pipeline.

NaN is treated as missing everywhere: it becomes NULL at ingest (in Spark ``NaN > 60`` is true
and ``max`` would return NaN), and clipping keeps a missing value missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number with optional sign and exponent; other text is not a number.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL; NULL stays NULL."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def to_number(c) -> Column:
    """Text or number -> DOUBLE; NULL, junk and NaN -> NULL (never raises)."""
    s = _col(c).cast("string")
    return F.when(s.rlike(NUMBER_PATTERN), nan_to_null(s.try_cast("double")))


def clip(c, low: float, high: float) -> Column:
    """Clip to [low, high]; a missing value (NULL or NaN) stays as it is."""
    c = _col(c)
    return (
        F.when(c.isNull() | F.isnan(c), c)
        .when(c < F.lit(low), F.lit(float(low)))
        .when(c > F.lit(high), F.lit(float(high)))
        .otherwise(c)
    )


def round_to(c, scale: int = 2, mode: str = "half_up") -> Column:
    """Round to ``scale`` decimals; ``half_up`` (default) or ``half_even``."""
    c = _col(c)
    if mode == "half_up":
        return F.round(c, scale)
    if mode == "half_even":
        return F.bround(c, scale)
    raise ValueError(f"unknown rounding mode {mode!r}")


def scaled_long(c, scale: int) -> Column:
    """Integer units of 10^-scale; a value with more decimals fails the job (it would lose them)."""
    x = _col(c) * F.lit(float(10 ** scale))
    units = F.rint(x)
    finer = F.abs(x - units) > F.greatest(F.lit(1e-6), F.abs(x) * 1e-12)
    return F.when(finer, F.raise_error(F.lit(f"a value has more than {scale} decimals"))).otherwise(units).cast("long")


def exact_sum(c, scale: int) -> Column:
    """Sum of values with at most ``scale`` decimals, accumulated as exact integers.

    The result does not depend on the order in which partitions are combined, so it is the
    same on every run and every cluster size (a double sum is not). Long accumulation keeps
    the aggregate in the fast fixed-width hash-aggregate path.
    """
    return F.sum(scaled_long(c, scale)).cast("double") / F.lit(float(10 ** scale))


def exact_avg(c, scale: int) -> Column:
    """Average of values with at most ``scale`` decimals: exact sum / count, then one division."""
    c = _col(c)
    return F.try_divide(exact_sum(c, scale), F.count(c).cast("double"))


def div_half_up(num, den) -> Column:
    """HALF_UP(num / den) for integral ``num`` and ``den`` > 0, exact, as LONG (NULL when
    ``den`` <= 0). DECIMAL(38,0) operands keep large sums from overflowing."""
    n = _col(num).cast("decimal(38,0)")
    d = _col(den).cast("decimal(38,0)")
    q = F.call_function("div", F.abs(n) * 2 + d, d * 2)
    return F.when(d > 0, F.when(n < 0, -q).otherwise(q))


def div_half_even(num, den) -> Column:
    """Half-to-even(num / den) for integral ``num`` and ``den`` > 0, exact, as LONG (NULL when ``den``
    <= 0): the quotient, and one more if the rest is over half, or half and the quotient odd."""
    n = _col(num).cast("decimal(38,0)")
    d = _col(den).cast("decimal(38,0)")
    q = F.call_function("div", F.abs(n), d)
    twice = (F.abs(n) - q.cast("decimal(38,0)") * d) * 2
    up = (twice > d) | ((twice == d) & (q % 2 == 1))
    q = q + F.when(up, F.lit(1)).otherwise(F.lit(0))
    return F.when(d > 0, F.when(n < 0, -q).otherwise(q))


DIVISIONS = {"half_up": div_half_up, "half_even": div_half_even}


def exact_stddev(c, scale: int) -> Column:
    """Population standard deviation of values with at most ``scale`` decimals: integer sums of values
    and squares (DECIMAL(38,0)), n * squares - sum^2 exact, one root and one division at the end. The
    result does not depend on partitioning, and nothing cancels. Sums up to 10^38 units squared."""
    u = scaled_long(c, scale).cast("decimal(38,0)")
    n = F.count(_col(c))
    total, squares = F.sum(u), F.sum((u * u).cast("decimal(38,0)"))
    spread = n.cast("decimal(38,0)") * squares.cast("decimal(38,0)") - total.cast("decimal(38,0)") * total.cast("decimal(38,0)")
    return F.try_divide(F.sqrt(spread.cast("double")), n.cast("double")) / F.lit(float(10 ** scale))


def scaled_sum(c, scale: int) -> Column:
    """Sum in integer units of 10^-scale (LONG)."""
    return F.sum(scaled_long(c, scale))


def rounded_units(units, count, scale: int, digits: int, mode: str = "half_up") -> Column:
    """(units / 10^scale) / count rounded to integer units of 10^-digits (LONG), exact; ``mode``:
    ``half_up`` or ``half_even``."""
    units, count = _col(units), _col(count)
    if digits >= scale:
        num, den = units.cast("decimal(38,0)") * F.lit(10 ** (digits - scale)), count
    else:
        num, den = units, count.cast("decimal(38,0)") * F.lit(10 ** (scale - digits))
    return DIVISIONS[mode](num, den)


def rounded_ratio(units, count, scale: int, digits: int, mode: str = "half_up") -> Column:
    """(units / 10^scale) / count rounded to ``digits`` as DOUBLE, computed exactly.

    Rounding the double quotient instead can differ at exact ties (an average of values with
    ``scale`` decimals often is one), and the result would depend on float formatting.
    """
    return rounded_units(units, count, scale, digits, mode).cast("double") / F.lit(float(10 ** digits))


def exact_avg_rounded(c, scale: int, digits: int, mode: str = "half_up") -> Column:
    """Average of values with at most ``scale`` decimals, rounded to ``digits`` exactly (sum of
    integers, one integer division)."""
    c = _col(c)
    return rounded_ratio(scaled_sum(c, scale), F.count(c), scale, digits, mode)
