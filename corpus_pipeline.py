"""The corpus pipeline: quality rules, line de-duplication, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a
DataFrame; every stage but the last returns the columns of ``documents``. :func:`run` writes each
stage's rows as Parquet to the shared folder and reads them again as the next stage's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.llm.curriculum import mix
from obsmart.llm.dartminhash import keep_first
from obsmart.llm.linededup import dedup_lines
from obsmart.llm.packing import pack
from obsmart.llm.quality import judge
from obsmart.llm.storage import stored


DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(docs: DataFrame) -> DataFrame:
    """Further columns under names that no operator gives to its own."""
    return docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c not in DOCUMENTS})


def _as_before(done: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, under their names."""
    return done.select(*[c if c in DOCUMENTS else F.col(f"__own_{c}").alias(c) for c in docs.columns])


def _recounted(docs: DataFrame, like: DataFrame) -> DataFrame:
    """``docs`` with n_chars as the text now has it."""
    if "n_chars" in like.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the divergence rule."""
    return _as_before(judge(_apart(docs)).where("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that a document of larger doc_id keeps."""
    return _as_before(_recounted(dedup_lines(_apart(docs)), docs), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return _as_before(keep_first(_apart(docs)), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes, in training order; every copy is whole."""
    return _as_before(_recounted(mix(_apart(docs)), docs), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows, with their places in the packed sequences."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# No SQL: near-duplicates and packing are not expressible; tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
