"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

Folding lower-cases, turns look-alike letters and digits into the letters they stand for, drops
zero-width characters and makes every run of other characters one space. The lexicon holds whole
words and word beginnings with a weight each: the log-odds of their documents being labelled toxic.
It is learnt from the labelled rows that are not held out; beginnings let it know inflected or
compound forms that were never seen. Exception phrases (a neighbour word with which a term is
harmless) are learnt from the same rows, or given; a match inside one does not count.

One pass of the automaton finds all matches of a text; of matches that begin at the same word the
heaviest counts. The sum of weights, and the sum per square root of the number of words, go into a
logistic score that is fitted on at most ``FIT_ROWS`` training rows (the ones with the least hash
of doc_id); everything else is counted over all training rows.

Only labelled texts are moved: a bitmap of the labelled ids sifts the others out before the join,
which is the same shuffle at every size (labels grow with the documents and are not broadcast).
The lexicon and its exceptions travel with the tasks. Every term over the evidence thresholds is in
them, so they grow with the words that at least ``MIN_DOCS`` toxic training documents share and
others hardly hold, not with the documents. Word counts are combined per task before the shuffle,
in tables of at most ``FLUSH`` words.

Defined results
    null or empty text: the score of no match. Without positive labels in the training rows no
    term is learnt and every score is 0. A null doc_id counts as held out. Several labels of one
    doc_id: toxic if one says so. Repeated rows get equal scores. An empty table gives an empty
    result. Further columns are not carried. Texts are matched whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.llm.sift import sifted
from obsmart.llm.storage import stored
from obsmart.llm.text import whole

FOLDS = 5
MIN_DOCS = 8               # toxic training documents that hold a term
MIN_LOG_ODDS = 2.5
BEGINNINGS = (4, 7)        # lengths of word beginnings that may become terms
FIT_ROWS = 20_000
FLUSH = 200_000

# ---- fixed values: look-alikes of Latin letters, and digits or signs used for letters ----------
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ǀ": "l", "ℓ": "l",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
# ------------------------------------------------------------------------------------------------
_OTHER = re.compile(r"[\W_]+")


def fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(a): b for a, b in (LOOKALIKES | SUBSTITUTES).items()}
    table |= {0xFF41 + i: chr(97 + i) for i in range(26)}           # full-width letters
    table |= {0x1D400 + 52 * style + 26 + i: chr(97 + i) for style in range(13) for i in range(26)}   # mathematical small letters
    table |= {0x1D400 + 52 * style + i: chr(97 + i) for style in range(13) for i in range(26)}        # mathematical capitals
    return table | dict.fromkeys([0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])


_FOLD = fold_table()


def folded(text: str) -> str:
    """Folded words between single spaces, with one at either end."""
    text = text.lower()
    return f" {_OTHER.sub(' ', text.translate(_FOLD)).strip(' ')} "


class Lexicon:
    """The automaton of a lexicon: terms (" word " or " beginning") with weights, and exception
    phrases (" two words ")."""

    def __init__(self, terms: dict[str, float], exceptions: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for phrase in exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        for term, weight in terms.items():
            self.automaton.add_word(term, (len(term), weight))
        self.empty = not terms
        if not self.empty:
            self.automaton.make_automaton()

    def matches(self, text: str) -> dict[int, float]:
        """Start of each matched word in the folded text -> weight of the heaviest term there."""
        found: dict[int, float] = {}
        harmless: list[tuple[int, int]] = []
        if self.empty:
            return found
        for end, (length, weight) in self.automaton.iter(text):
            start = end - length + 1
            if weight is None:
                harmless.append((start, end))
            elif weight > found.get(start, 0.0):
                found[start] = weight
        for a, b in harmless:
            for start in [s for s in found if a <= s < b]:
                del found[start]
        return found


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.coalesce(F.crc32(doc_id.cast("string")), F.lit(0)), F.lit(FOLDS)) == 0


def _word_counts(train: DataFrame) -> DataFrame:
    """word, pos, neg: toxic and other training documents that hold it."""
    def count(batches: Iterator) -> Iterator:
        seen: dict[str, list[int]] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), *(pa.array([v[i] for v in seen.values()], pa.int64()) for i in (0, 1))],
                                              ["word", "pos", "neg"])

        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                for word in set(folded(text).split()):
                    if (c := seen.get(word)) is None:
                        c = seen[word] = [0, 0]
                    c[0 if toxic else 1] += 1
                if len(seen) >= FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    return (train.select("text", "toxic").mapInArrow(count, "word string, pos bigint, neg bigint")
            .groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def learn_terms(train: DataFrame, n_toxic: int, n_other: int) -> dict[str, float]:
    """The lexicon of the training rows: term -> weight."""
    words = stored(_word_counts(train))
    lo, hi = BEGINNINGS
    n = F.length("word")
    beginnings = (words.where(n > lo).select(F.explode(F.sequence(F.lit(lo), F.least(F.lit(hi), n - 1))).alias("n"), "word", "pos", "neg")
                  .select(F.expr("concat(' ', substring(word, 1, n))").alias("term"), "pos", "neg")
                  .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    terms = words.select(F.concat(F.lit(" "), "word", F.lit(" ")).alias("term"), "pos", "neg").unionByName(beginnings)
    odds = F.log((F.col("pos") + 0.5) / (n_toxic + 1)) - F.log((F.col("neg") + 0.5) / (n_other + 1))
    terms = terms.where(F.col("pos") >= MIN_DOCS).withColumn("weight", odds).where(F.col("weight") >= MIN_LOG_ODDS)
    return {r["term"]: r["weight"] for r in terms.select("term", "weight").collect()}


def learn_exceptions(train: DataFrame, terms: dict[str, float]) -> list[str]:
    """Two-word phrases around a term that training documents hold almost only when not toxic."""
    def around(batches: Iterator) -> Iterator:
        lexicon = Lexicon(terms, [])
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                text, phrases = folded(text), set()
                for start in lexicon.matches(text):
                    end = text.index(" ", start + 1)
                    after, before = text.find(" ", end + 1), text.rfind(" ", 0, start)
                    if after > 0:
                        phrases.add(text[start:after + 1])
                    if before >= 0:
                        phrases.add(text[before:end + 1])
                rows += [(p, int(bool(toxic)), int(not toxic)) for p in phrases]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                             ["phrase", "pos", "neg"])

    found = (train.select("text", "toxic").mapInArrow(around, "phrase string, pos bigint, neg bigint").groupBy("phrase")
             .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where((F.col("neg") >= MIN_DOCS) & (F.col("neg") >= 19 * F.col("pos"))))
    return sorted(r["phrase"] for r in found.select("phrase").collect())


def _features(total: float, n_words: int) -> tuple[float, float, float]:
    return 1.0, math.log1p(total), math.log1p(total / math.sqrt(max(1, n_words)))


def _matched(df: DataFrame, terms: dict[str, float], exceptions: list[str], keep: str) -> DataFrame:
    """Column ``keep`` (any name and one type) with hits, weight and n_words of each text."""
    kind = df.schema[keep].dataType.simpleString()

    def match(batches: Iterator) -> Iterator:
        lexicon = Lexicon(terms, exceptions)
        for batch in batches:
            hits, weight, n = [], [], []
            for text in batch["text"]:
                text = folded(text.as_py())
                found = lexicon.matches(text)
                hits.append(len(found))
                weight.append(math.fsum(found.values()))
                n.append(text.count(" ") - 1)
            yield pa.RecordBatch.from_arrays([batch[keep], pa.array(hits, pa.int64()), pa.array(weight, pa.float64()), pa.array(n, pa.int64())],
                                             [keep, "hits", "weight", "n_words"])

    return df.select(keep, "text").mapInArrow(match, f"{keep} {kind}, hits bigint, weight double, n_words bigint")


def fit_sample(train: DataFrame, n: int, rows: int) -> DataFrame:
    """About ``rows`` of the ``n`` training rows, chosen by the hash of doc_id: a filter, so no task
    gathers them."""
    if n <= rows:
        return train
    return train.where(F.xxhash64("doc_id") < F.lit(int(-2 ** 63 + 2 ** 64 * (rows / n))))


def fit(train: DataFrame, n: int, terms: dict[str, float], exceptions: list[str]) -> tuple[float, float, float]:
    """Logistic coefficients on at most FIT_ROWS of the ``n`` rows, by Newton steps with a small ridge."""
    import numpy as np

    sample = fit_sample(train, n, FIT_ROWS).withColumn("at", F.struct(F.xxhash64("doc_id").alias("h"), "doc_id", "toxic"))
    rows = sorted(_matched(sample, terms, exceptions, "at").collect(), key=lambda r: (r["at"][:2], r["at"][2], r["weight"], r["n_words"]))[:FIT_ROWS]
    x = np.array([_features(r["weight"], r["n_words"]) for r in rows])
    y = np.array([1.0 if r["at"]["toxic"] else 0.0 for r in rows])
    b = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        ridge = 1e-2 * np.eye(3)
        b = b + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ b)
    return tuple(float(v) for v in b)


def toxicity(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, hits.

    labels: doc_id, toxic. ``exceptions``: further harmless phrases (plain text, any length).
    """
    text = whole(F.col("text"))
    docs = docs.select("doc_id", text.alias("text"))
    said = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    said = stored(said)
    labelled = sifted(docs.where(~held_out(F.col("doc_id"))), said, "doc_id")
    train = stored(labelled.join(said.hint("merge"), "doc_id").select("doc_id", "toxic", "text"))
    sizes = {bool(r["toxic"]): r["n"] for r in train.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_other = sizes.get(True, 0), sizes.get(False, 0)
    terms, harmless, b = {}, [], None
    if n_toxic:
        terms = learn_terms(train, n_toxic, n_other)
        harmless = learn_exceptions(train, terms) + [folded(p) for p in exceptions]
        b = fit(train, n_toxic + n_other, terms, harmless)
    out = _matched(docs, terms, harmless, "doc_id")
    total, n = F.col("weight"), F.greatest(F.lit(1), F.col("n_words"))
    score = F.lit(0.0) if b is None else 1 / (1 + F.exp(-(b[0] + b[1] * F.log1p(total) + b[2] * F.log1p(total / F.sqrt(n)))))
    out = out.withColumn("score", score)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "hits")
