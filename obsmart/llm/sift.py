"""Sifting rows by a bitmap of wanted keys, before they are shuffled for a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIFT_BITS = 26


def sifted(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """``rows`` without most of those whose ``keys`` are not in ``wanted``: a bitmap of 2 ** SIFT_BITS
    bits (8 MB at most, in pieces of 4 KB) over the hashes of the wanted keys is broadcast. With very
    many wanted keys it fills up and lets all rows pass; the join after it decides."""
    spot = F.pmod(F.xxhash64(*keys), F.lit(1 << SIFT_BITS))
    piece, bit = F.floor(spot / 32768), F.pmod(spot, F.lit(32768))
    pieces = (wanted.select(piece.alias("__piece"), bit.alias("__bit")).groupBy("__piece")
              .agg(F.bitmap_construct_agg("__bit").alias("__map")))
    rows = rows.withColumns({"__piece": piece, "__bit": bit}).join(F.broadcast(pieces), "__piece")
    byte = F.conv(F.hex(F.substring("__map", (F.floor(F.col("__bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return rows.where(F.getbit(byte.cast("long"), (F.col("__bit") % 8).cast("int")) == 1).drop("__piece", "__bit", "__map")
