"""Line de-duplication over levelled sorted runs of line hashes.

Each batch of documents is reduced to its distinct line hashes, with the number of documents that
hold the line and the greatest doc_id among them, and merge-anti-joined with the runs
(:meth:`LineRuns.fresh`). The hashes that no run holds become a *run* of their own, sorted; so every
hash lies in one run. Of the others, counts and doc_ids are kept as updates to the runs. Runs lie on
levels; when a level has ``fanout`` runs they are compacted into one run of the next level, so a hash
is rewritten only log(batches) times. Runs and updates store hashes and two numbers, never text.

Defined results
    null or empty text: one empty line, never dropped. Lines whose key is shorter than
    ``min_chars`` are never dropped. Rows with the same doc_id count as one document; a null
    doc_id ranks below every other and counts as one document. Repeated rows are all returned,
    with equal results. An empty table gives an empty result. Further columns are passed through;
    an input column named like an output column is replaced. Lines of any length are hashed whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.llm.storage import stored
from obsmart.llm.text import ascii_lower, hash128, held, stripped, whole

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2
KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(stripped(line))


class LineRuns:
    """The levelled runs. ``levels[i]`` holds fewer than ``fanout`` runs after each ``add``;
    ``updates`` what later batches brought of hashes that a run already holds."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout, self.levels, self.updates = fanout, [], []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def fresh(self, lines: DataFrame) -> DataFrame:
        """The lines (rows with h1, h2) whose hash no earlier batch has brought."""
        for run in self.runs():
            lines = lines.join(run.select(*KEY).hint("merge"), KEY, "left_anti")
        return lines

    def known(self, lines: DataFrame) -> DataFrame:
        """The other lines. No hash lies in two runs, so each line is found once."""
        found = [lines.join(run.select(*KEY).hint("merge"), KEY, "left_semi") for run in self.runs()]
        return reduce(DataFrame.unionByName, found) if found else lines.limit(0)

    def add(self, lines: DataFrame) -> None:
        """Add a batch (rows with h1, h2, doc_id; no document in two batches): its fresh hashes as a
        sorted run, the known ones as updates; both are written at once."""
        batch = (lines.select(*KEY, "doc_id").distinct().groupBy(*KEY)
                 .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("max_doc")))
        parted = self.fresh(batch).withColumn("fresh", F.lit(True)).unionByName(self.known(batch).withColumn("fresh", F.lit(False)))
        parted = stored(parted.sortWithinPartitions(*KEY))
        self.updates.append(parted.where(~F.col("fresh")).drop("fresh"))
        self._place(parted.where("fresh").drop("fresh"), 0)

    def _place(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = reduce(DataFrame.unionByName, self.levels[level]), []
            self._place(stored(runs.repartition(*KEY).sortWithinPartitions(*KEY)), level + 1)

    def settled(self) -> DataFrame:
        """All runs with their updates as one: h1, h2, n_docs, max_doc."""
        rows = reduce(DataFrame.unionByName, self.runs() + self.updates)
        return rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash, pos, h1, h2: one row per line that is long enough to be dropped."""
    line = F.explode(F.filter(
        F.transform(lines_of(F.col("text")), lambda x, i: F.struct(i.alias("pos"), line_key(x).alias("key"))),
        lambda x: F.length(x["key"]) >= min_chars))
    h1, h2 = hash128(F.col("line.key"))
    return (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), line.alias("line"))
            .select("doc_id", "text_hash", F.col("line.pos").alias("pos"), h1.alias("h1"), h2.alias("h2")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with ``text`` reduced to its kept lines, plus n_lines and n_dropped.

    A line found in ``min_docs`` documents or more stays only in the largest doc_id that holds it.
    Lines are hashed once; every batch is anti-joined with the runs and adds its own; the settled
    runs give the repeated lines;
    only positions of dropped lines travel back to the documents.
    """
    lines = stored(hashed_lines(docs, min_chars)
                   .withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches))))
    runs = LineRuns(fanout)
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b))
    hot = stored(runs.settled().where(F.col("n_docs") >= min_docs).select(*KEY, "max_doc"))
    drops = (lines.join(hot, KEY).where(~F.col("doc_id").eqNullSafe(F.col("max_doc")))
             .groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"))
             .agg(F.collect_set("pos").alias("__pos")))
    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    kept = docs.select(*own, "text", F.xxhash64("text").alias("__text"))
    kept = kept.join(drops, kept["doc_id"].eqNullSafe(drops["__doc"])
                     & (kept["__text"] == drops["__hash"]), "left")
    cut = kept.select(*own, held(lines_of(F.col("text"))).alias("__lines"), "__pos")
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__pos"))
    cut = cut.withColumn("__kept", held(F.when(F.col("__pos").isNull(), F.col("__lines")).otherwise(
        F.transform(left, lambda i: F.get(F.col("__lines"), i)))))
    return cut.select(*own, F.array_join("__kept", "\n").alias("text"),
                      F.size("__lines").cast("long").alias("n_lines"),
                      (F.size("__lines") - F.size("__kept")).cast("long").alias("n_dropped"))
