"""The queries of the numbered operators, over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.llm.chat import END, START, format_chats, read_back
from obsmart.llm.curriculum import plan_mix
from obsmart.llm.dartminhash import near_duplicates
from obsmart.llm.linededup import dedup_lines
from obsmart.llm.mixing_lm import score_documents
from obsmart.llm.packing import pack
from obsmart.llm.periodic import best_run, periodic_runs, with_planted_runs
from obsmart.llm.quality import judge
from obsmart.llm.redirects import judge_urls, page_links
from obsmart.llm.spelling import MIN_CHARS, group_variants, letter_runs, with_slips, word_counts
from obsmart.llm.syncmers import edited_fingerprints
from obsmart.llm.toxicity import toxicity
from obsmart.llm.vectorjoin import link_vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its place in a packed sequence."""
    return pack(_table(spark, sf_dir, "documents"))


def op2_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one with control strings in its texts, as read back from the tree."""
    said = END + START + "assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return read_back(*format_chats(turns))


def op3_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and Jensen-Shannon verdict of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs).drop("text", "lang")


def op4_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return edited_fingerprints(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and when it is first trained."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return plan_mix(docs).select("doc_id", "size", "source_size", "target", "taken", "position")


def op6_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learnt from labels outside the held-out fold."""
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines, as digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, by unigram counts and by the mixed model."""
    return score_documents(_table(spark, sf_dir, "documents"))


def op9_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    pages = _table(spark, sf_dir, "pages")
    return judge_urls(pages.select("page_id", "url"), links=page_links(pages)).drop("url")


def op10_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text class and near-duplicate class of every document."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op11_sync_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document (every tenth made to repeat itself), as digests."""
    docs = periodic_runs(with_planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = docs.withColumn("best", best_run(F.col("runs")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


def op12_chunk_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of the documents (some runs with a letter lost) with its form and root."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return group_variants(word_counts(with_slips(letter_runs(docs, MIN_CHARS))))


def op13_pivot_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its number of near vectors and the least vector of its component."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return link_vectors(vectors).drop("embedding")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit": op1_best_fit,
        "op2_prefix_tree": op2_prefix_tree,
        "op3_divergence": op3_divergence,
        "op4_syncmers": op4_syncmers,
        "op5_curriculum": op5_curriculum,
        "op6_lexicon": op6_lexicon,
        "op7_line_runs": op7_line_runs,
        "op8_context_mixing": op8_context_mixing,
        "op9_redirects": op9_redirects,
        "op10_dart_minhash": op10_dart_minhash,
        "op11_sync_runs": op11_sync_runs,
        "op12_chunk_variants": op12_chunk_variants,
        "op13_pivot_join": op13_pivot_join,
    }


_LINES = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, u.pos AS pos, lines[u.pos] AS line,
         translate(regexp_replace(lines[u.pos], '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split, unnest(range(1, len(lines) + 1)) AS u(pos)),
hot AS (
  SELECT key, max(doc_id) AS holder FROM line WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT doc_id, pos, line, hot.key IS NOT NULL AND doc_id <> holder AS dropped FROM line LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def oracle_sql() -> dict[str, str]:
    """The other queries have no SQL form (iteration, models, Spark's hashes): tests/llm holds them
    against brute force."""
    return {"op7_line_runs": _LINES}
