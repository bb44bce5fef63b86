"""Shared fixtures: one local session, the sample payload, two places."""

from __future__ import annotations

import json
import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from obsmart.session import local_session  # noqa: E402



@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="obsmart-tests-")
    os.environ.setdefault("OBSMART_TEST_SCRATCH", scratch)
    s = local_session(app="obsmart-tests", cores=4, shuffle_partitions=4,
                      checkpoint=os.path.join(scratch, "checkpoints"))
    yield s


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


# ---------------------------------------------------------------------------------------------
# The sample payload of one place for one day (2026-10-07), 24 hours, as the
# source API returns it. The expected golden day in the tests is computed from these values.
SAMPLE_HOURLY = {
    "temperature_2m": [11.0, 10.4, 10.2, 10.0, 9.7, 9.8, 10.4, 11.2, 12.5, 13.8, 14.9, 15.3,
                       15.5, 15.1, 14.3, 12.9, 11.5, 10.5, 9.6, 9.0, 8.4, 7.6, 7.2, 6.8],
    "relative_humidity_2m": [90, 90, 91, 91, 89, 86, 81, 75, 70, 63, 55, 49,
                             44, 46, 49, 56, 64, 67, 70, 74, 78, 84, 86, 88],
    "precipitation": [0.0] * 24,
    "wind_speed_10m": [8.8, 8.3, 9.4, 9.0, 8.7, 9.0, 10.5, 11.2, 10.5, 10.5, 12.0, 12.2,
                       11.8, 10.5, 9.0, 6.9, 6.3, 6.3, 6.6, 6.6, 6.5, 5.8, 5.4, 5.2],
    "pressure_msl": [1008.0, 1008.0, 1008.7, 1009.3, 1009.8, 1010.5, 1010.9, 1011.8, 1012.1,
                     1012.6, 1013.1, 1013.2, 1013.2, 1013.4, 1013.7, 1014.9, 1015.6, 1016.2,
                     1017.1, 1017.4, 1018.0, 1018.3, 1018.7, 1018.8],
    "cloud_cover": [45, 60, 73, 56, 68, 64, 60, 43, 30, 26, 46, 66,
                    13, 8, 9, 28, 0, 0, 0, 0, 0, 0, 0, 0],
}
SAMPLE_GRID_POINT = (55.7817, 37.570797)     # the payload's own coordinates (not the place's)
SAMPLE_PLACES = [("moscow", "Москва", "RU", 55.7558, 37.6173), ("london", "Лондон", "GB", 51.5074, -0.1278)]
# ---------------------------------------------------------------------------------------------


@pytest.fixture
def sample_payload() -> dict:
    """One place, one day (2026-10-07), 24 hours (a fresh copy per test)."""
    hourly = {"time": [f"2026-10-07T{h:02d}:00" for h in range(24)]}
    hourly.update({k: list(v) for k, v in SAMPLE_HOURLY.items()})
    lat, lon = SAMPLE_GRID_POINT
    return {"latitude": lat, "longitude": lon, "utc_offset_seconds": 0, "timezone": "GMT",
            "hourly": hourly}


@pytest.fixture
def places(spark):
    from obsmart.schemas import DIMENSION_SCHEMA

    return spark.createDataFrame(SAMPLE_PLACES, DIMENSION_SCHEMA)


def payload_frame(spark, items, start="2026-10-07", end="2026-10-07"):
    """[(city, payload dict)] -> payload rows as ``read_raw`` gives them."""
    from datetime import date

    rows = [(f"{start}_{end}", date.fromisoformat(start), date.fromisoformat(end), city, json.dumps(p))
            for city, p in items]
    return spark.createDataFrame(rows, "range string, range_start date, range_end date, city string, body string")
