"""Schemas and column roles.

A ``Roles`` object names the columns an operator works on, so that every operator is generic
over entity / time / metric columns. The weather layout of the original pipeline is one
instance of it (``WEATHER``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    """Column roles of an observation table."""

    entity: str = "city"                   # key of the observed thing
    ts: str = "ts"                         # observation time (hourly)
    day: str = "dt"                        # calendar day (UTC)
    metrics: tuple[str, ...] = ()          # numeric observation columns
    attrs: tuple[str, ...] = ()            # entity attributes carried along (from the dimension)


# ---------------------------------------------------------------------------------------------
# Fixed values of the weather pipeline (they must equal the original's for equal results).
# API variable -> staging column, in the original order.
WEATHER_VARIABLES: dict[str, str] = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "humidity_pct",
    "precipitation": "precipitation_mm",
    "wind_speed_10m": "wind_speed_kmh",
    "pressure_msl": "pressure_hpa",
    "cloud_cover": "cloud_cover_pct",
}
# Inclusive physical ranges used by the staging quality checks.
WEATHER_RANGES: dict[str, tuple[float, float]] = {
    "temperature_c": (-90.0, 60.0),
    "humidity_pct": (0.0, 100.0),
    "precipitation_mm": (0.0, 500.0),
    "wind_speed_kmh": (0.0, 500.0),
    "pressure_hpa": (850.0, 1100.0),
    "cloud_cover_pct": (0.0, 100.0),
}
# Percentage columns clipped to [0, 100] while cleaning (a known artefact of the source).
WEATHER_PERCENT_COLUMNS: tuple[str, ...] = ("humidity_pct", "cloud_cover_pct")
MAX_NULL_SHARE = 0.05          # strict: a share above this is a violation
HOURS_PER_DAY = 24
REQUEST_ATTEMPTS = 5           # tries of one request before it is given up
NORM_WINDOW_DAYS = 30          # trailing calendar days of the norm, today excluded
NORM_MIN_DAYS = 25             # fewer filled days in the window -> no norm
# Labels of the anomaly kind in the top-anomalies report (warm, cold).
ANOMALY_LABELS: tuple[str, str] = ("тепло", "холод")
# Daily aggregates of the weather mart: (output column, aggregate, input column).
WEATHER_DAILY_AGGS: tuple[tuple[str, str, str], ...] = (
    ("temp_min", "min", "temperature_c"),
    ("temp_max", "max", "temperature_c"),
    ("temp_avg", "avg", "temperature_c"),
    ("precip_sum", "sum", "precipitation_mm"),
    ("wind_max", "max", "wind_speed_kmh"),
    ("humidity_avg", "avg", "humidity_pct"),
    ("pressure_avg", "avg", "pressure_hpa"),
    ("cloud_cover_avg", "avg", "cloud_cover_pct"),
)
# ---------------------------------------------------------------------------------------------

WEATHER_METRICS: tuple[str, ...] = tuple(WEATHER_VARIABLES.values())
WEATHER_ATTRS: tuple[str, ...] = ("city_name", "country", "latitude", "longitude")
WEATHER = Roles(entity="city", ts="ts", day="dt", metrics=WEATHER_METRICS, attrs=WEATHER_ATTRS)

STAGING_COLUMNS = ["city", "ts", *WEATHER_ATTRS, *WEATHER_METRICS]

DIMENSION_SCHEMA = T.StructType([
    T.StructField("slug", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("lat", T.DoubleType(), True),
    T.StructField("lon", T.DoubleType(), True),
])

STAGING_SCHEMA = T.StructType(
    [T.StructField("city", T.StringType(), False), T.StructField("ts", T.TimestampType(), False)]
    + [T.StructField("city_name", T.StringType()), T.StructField("country", T.StringType()),
       T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())]
    + [T.StructField(m, T.DoubleType()) for m in WEATHER_METRICS]
)

VIOLATION_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType(), False),
    T.StructField("dt", T.DateType(), True),
    T.StructField("rule", T.StringType(), False),
    T.StructField("field", T.StringType(), True),
    T.StructField("entity", T.StringType(), True),
    T.StructField("observed", T.DoubleType(), True),
    T.StructField("limit_low", T.DoubleType(), True),
    T.StructField("limit_high", T.DoubleType(), True),
])


def payload_schema(variables) -> T.StructType:
    """Schema of a column-oriented payload. Values are read as text so that one bad element
    does not null the whole array; they are coerced afterwards."""
    hourly = T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(v, T.ArrayType(T.StringType())) for v in variables]
    )
    return T.StructType([
        T.StructField("hourly", hourly),
        T.StructField("error", T.BooleanType()),
        T.StructField("reason", T.StringType()),
    ])


@dataclass(frozen=True)
class DailySpec:
    """What the daily rollup computes: count column plus (output, aggregate, input) triples."""

    aggs: tuple[tuple[str, str, str], ...] = WEATHER_DAILY_AGGS
    count_col: str = "hours_count"
    value: str = "temp_avg"                 # column the trailing norm is computed on
    norm: str = "temp_norm_30d"
    anomaly: str = "temp_anomaly"

    @property
    def outputs(self) -> list[str]:
        return [a[0] for a in self.aggs]


WEATHER_DAILY = DailySpec()
