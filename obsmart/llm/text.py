"""Column expressions on words and lines that several operators share (JVM side only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that parts words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def held(value: Column) -> Column:
    """``value``, made once per row in its own projection. Arrays that lambdas look into need this:
    a filter above would otherwise be moved below the projection and bring the array's whole
    expression into the lambda, to be evaluated again for every element."""
    return F.when(F.spark_partition_id() >= 0, value)


def whole(text: Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """All words of the text, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def stripped(text: Column) -> Column:
    """The text without white space at either end."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def hash128(value: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a column (the seed comes first, so that neither follows
    from the other)."""
    return F.xxhash64(F.lit(1), value), F.xxhash64(F.lit(2), value)


def chars_of(text: Column, allowed: str) -> Column:
    """Number of characters of a regex character class (given without brackets)."""
    return F.regexp_count(text, F.lit(f"[{allowed}]")).cast("long")
