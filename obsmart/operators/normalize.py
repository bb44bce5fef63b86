"""Raw payloads -> clean hourly rows.

Column-oriented payloads (parallel arrays under ``hourly``) become one row per entity and
time; values are coerced to numbers, times to UTC instants, attributes come from the
dimension, duplicates keep the last value, percentage artefacts are clipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsmart.functions.numeric import clip, to_number  # noqa: F401  (P3, re-exported)
from obsmart.functions.temporal import to_utc, utc_day  # noqa: F401  (P4, re-exported)
from obsmart.operators.calendar import check_period
from obsmart.schemas import payload_schema


def unpivot_arrays(payloads: DataFrame, variables: dict[str, str], *, body: str = "body",
                   keep: tuple[str, ...] = (), ts: str = "ts", ordinal: str | None = "_pos",
                   strict: bool = False) -> DataFrame:
    """Payload rows -> one row per array position of ``hourly.time``.

    ``variables`` maps payload variable -> output column. A variable that is absent or null
    gives NULL in every row; a shorter array is padded with NULL, a longer one is cut to the
    length of ``time``; an empty or missing ``hourly`` gives no rows. Numbers are read from
    text (junk -> NULL, NaN -> NULL). Times are UTC; junk -> NULL unless ``strict``.

    The arrays are zipped by position in one code-generated expression per payload
    (``arrays_zip`` with an explicit position array), so each output row carries only its
    own values.
    """
    parsed = payloads.select(*keep, F.from_json(F.col(body), payload_schema(variables)).alias("_p"))
    hourly = F.col("_p.hourly")
    time = hourly.getField("time")
    empty = F.array().cast("array<string>")
    # Positions 0..len(time)-1 bound the zip: longer arrays are cut, shorter ones padded with
    # NULL, an absent variable is an empty array (all NULL); no time -> no rows.
    positions = F.when(F.size(time) > 0, F.sequence(F.lit(0), F.size(time) - 1))
    zipped = F.arrays_zip(
        time.alias("_time"), positions.alias("_i"),
        *[F.coalesce(hourly.getField(api), empty).alias(f"_v{n}") for n, api in enumerate(variables)])
    rows = parsed.select(*keep, F.inline(zipped)).where(F.col("_i").isNotNull())
    ts_expr = to_utc("_time", strict=strict)
    out = [F.col(k) for k in keep] + [ts_expr.alias(ts)]
    out += [to_number(f"_v{n}").alias(column) for n, column in enumerate(variables.values())]
    if ordinal:
        out.append(F.col("_i").alias(ordinal))
    return rows.select(*out)


def enrich(facts: DataFrame, dim: DataFrame, *, fact_key: str, dim_key: str,
           attrs: dict[str, str], how: str = "inner",
           observation: Observation | None = None) -> DataFrame:
    """Attach entity attributes from the dimension (N:1 equi join).

    Attributes always come from the dimension, never from the payload. The dimension key
    must be unique (checked at any size, by a distributed count per key; NULL keys match
    nothing). The join strategy is Spark's: it broadcasts the dimension if its bytes are few. Facts without
    a dimension row are counted in ``observation`` as ``unmatched``; ``how='inner'`` drops
    them, ``how='left'`` keeps them with NULL attributes.
    """
    side = dim.select(F.col(dim_key).alias("_dim_key"),
                      *[F.col(src).alias(dst) for src, dst in attrs.items()],
                      F.lit(True).alias("_dim_hit"))
    twice = side.where(F.col("_dim_key").isNotNull()).groupBy("_dim_key").count().where("count > 1")
    if not twice.isEmpty():
        raise ValueError(f"dimension key {dim_key!r} is not unique")
    facts = facts.drop(*[a for a in attrs.values() if a in facts.columns])
    joined = facts.join(side, facts[fact_key] == side["_dim_key"], "left")
    if observation is not None:
        joined = joined.observe(observation, F.count_if(F.col("_dim_hit").isNull()).alias("unmatched"))
    if how == "inner":
        joined = joined.where(F.col("_dim_hit").isNotNull())
    elif how != "left":
        raise ValueError("how must be 'inner' or 'left'")
    return joined.drop("_dim_key", "_dim_hit")


def drop_null_keys(df: DataFrame, keys) -> DataFrame:
    """Rows without a key cannot be aggregated or joined."""
    return df.dropna(subset=list(keys))


_FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
# Order columns as non-negative integers below a fixed width, NULL as 0 (lowest): what a value is
# added to, and how many values there are. Days and instants span the years 1 to 9999.
_DAYS = (719162, 3652059)
_MICROS = (719162 * 86_400_000_000, 3652059 * 86_400_000_000)
_WIDTHS = {T.BooleanType: (0, 2), T.ByteType: (1 << 7, 1 << 8), T.ShortType: (1 << 15, 1 << 16), T.IntegerType: (1 << 31, 1 << 32),
           T.LongType: (1 << 63, 1 << 64), T.DateType: _DAYS, T.TimestampType: _MICROS, T.TimestampNTZType: _MICROS}
_LONG, _DECIMAL = 1 << 63, 10 ** 38


def _as_integer(c: Column, dtype) -> Column:
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):       # a wall clock: its parts, without any time zone
        clock = (F.extract(F.lit("HOUR"), c) * 3600 + F.extract(F.lit("MINUTE"), c) * 60) * F.lit(1_000_000).cast("long")
        return F.unix_date(c.cast("date")) * F.lit(86_400_000_000) + clock + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return c.cast("long")


def packed_order(columns, dtypes) -> Column | None:
    """Several fixed-width order columns as one value with the same ordering (left to right, NULL
    lowest): a LONG if they fit into one, else a DECIMAL(38,0), else None. Nothing is lost: every
    column has its own digits. Days and instants outside the years 1 to 9999 fail the job.

    A single value lets ``max_by`` keep its state in fixed-width buffers (hash aggregate); a struct
    of columns does not.
    """
    widths = [next((w for t, w in _WIDTHS.items() if type(d) is t), None) for d in dtypes]
    if not columns or any(w is None for w in widths):
        return None
    if len(columns) == 1 and isinstance(dtypes[0], T.LongType):     # NULL as the least LONG
        return F.coalesce(columns[0], F.lit(-_LONG))
    total = 1
    for _, n in widths:
        total *= n + 1
    if total >= _DECIMAL:
        return None

    def digits(c, dtype, low, n) -> Column:
        v = _as_integer(c, dtype)
        if n > _LONG:        # of a LONG, whose offset does not fit into one
            return F.coalesce(v.cast("decimal(38,0)") + F.lit(str(low + 1)).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
        v = v + F.lit(low + 1)
        if type(dtype) in (T.DateType, T.TimestampType, T.TimestampNTZType):
            v = F.when((v < 1) | (v > n), F.raise_error(F.lit("an order column is outside the years 1 to 9999")).cast("long")).otherwise(v)
        return F.coalesce(v, F.lit(0).cast("long"))

    limbs: list[tuple[Column, int]] = []          # neighbours that fit into a LONG are put together there
    for c, dtype, (low, n) in zip(columns, dtypes, widths, strict=True):
        d = digits(c, dtype, low, n)
        if limbs and n < _LONG and limbs[-1][1] * (n + 1) <= _LONG:
            limbs[-1] = limbs[-1][0] * F.lit(n + 1) + d, limbs[-1][1] * (n + 1)
        else:
            limbs.append((d, n + 1))
    if len(limbs) == 1:
        return limbs[0][0]
    out = limbs[0][0].cast("decimal(38,0)")
    for limb, n in limbs[1:]:
        out = (out * F.lit(str(n)).cast(f"decimal({len(str(n))},0)") + limb.cast("decimal(38,0)")).cast("decimal(38,0)")
    return out


def fixed_width(df: DataFrame, columns) -> bool:
    """Whether all ``columns`` are of types that an aggregate buffer holds in place."""
    return all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in columns)


def keep_last(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (a list of columns, compared left
    to right; NULL lowest). Expressed as an aggregate, so rows are combined map-side before
    the shuffle and a key with very many duplicates never lands whole in one task.

    Order columns of fixed width are packed into one value (``packed_order``). If the other columns
    have a fixed width as well, every one is its own ``max_by`` over it: all columns take their value
    from the same row (the decisions are the same comparisons, ties included), and Spark uses the
    code-generated hash aggregate. Otherwise the row is one struct (sort-based aggregate; Spark keeps
    text in no hash buffer), and where the order holds the whole row, the greatest order is the row.
    """
    keys = list(keys)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    others = [c for c in df.columns if c not in keys]
    if not others:                      # nothing but keys: one row per key
        return df.select(*keys).distinct()
    probe = df.select(*[c.alias(f"_o{i}") for i, c in enumerate(order_cols)])
    packed = packed_order(order_cols, [f.dataType for f in probe.schema.fields])
    if packed is not None and fixed_width(df, others):
        o = F.col("_keep_order")
        picked = (df.select("*", packed.alias("_keep_order")).groupBy(*keys)
                  .agg(*[F.max_by(F.col(c), o).alias(c) for c in others]))
        return picked.select(*df.columns)
    if all(isinstance(o, str) for o in order) and set(order) == set(others):
        best = F.max(F.struct(*order))
    else:
        best = F.max_by(F.struct(*others), packed if packed is not None else F.struct(*order_cols))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def payload_order(columns) -> list[str]:
    """Keep-last order of unpacked rows, of the columns that are there: the payload that landed
    last wins, then the newer range, then the later array position."""
    return [c for c in ("landing", "landed_at", "range_end", "_pos") if c in columns]


def clip_columns(df: DataFrame, columns, low: float = 0.0, high: float = 100.0,
                 observation: Observation | None = None) -> DataFrame:
    """Clip ``columns`` to [low, high]; other columns untouched. The number of repaired
    values per column is recorded in ``observation`` (read it after the next action)."""
    columns = [c for c in columns if c in df.columns]
    if observation is not None and columns:
        df = df.observe(observation, *[
            F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(c) for c in columns])
    return df.withColumns({c: clip(c, low, high) for c in columns})


def repair_counts(df: DataFrame, columns, low: float = 0.0, high: float = 100.0) -> DataFrame:
    """One row: per column, how many values clipping to [low, high] would repair."""
    return df.agg(*[F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(c)
                    for c in columns if c in df.columns])


def assign_day(df: DataFrame, ts: str = "ts", day: str = "dt", start=None, end=None) -> DataFrame:
    """UTC day of ``ts`` as ``day``; with a period, rows outside ``[start, end]`` are dropped."""
    df = df.withColumn(day, utc_day(ts, df.schema[ts].dataType))
    if start is not None or end is not None:
        start, end = check_period(start, end)
        df = df.where(F.col(day).between(F.lit(start), F.lit(end)))
    return df


def clean(df: DataFrame, *, keys=("city", "ts"), order=None, percent_columns=(),
          observation: Observation | None = None) -> DataFrame:
    """Drop rows with a NULL key, keep the last row per key, clip percentages. The default
    order is ``payload_order``."""
    if order is None:
        order = payload_order(df.columns)
    df = drop_null_keys(df, keys)
    df = keep_last(df, keys, order)
    return clip_columns(df, percent_columns, 0.0, 100.0, observation)


def to_ntz(c) -> Column:
    """UTC instant -> zone-less UTC wall clock (for exchange with zone-less systems)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_utc_timestamp(c, F.current_timezone()).cast(T.TimestampNTZType())
