"""obsmart: daily observation marts on Spark DataFrames.

Time-stamped observations of many entities go through three layers (raw column-oriented
JSON payloads, hourly staging, daily mart) into a versioned serving table and a set of
reports.  Every operator takes and returns DataFrames; entity, time and metric columns are
parameters.
"""

from obsmart.schemas import Roles

__all__ = ["Roles"]
__version__ = "0.1.0"
