"""Grouping of spelling variants by asymmetric q-chunks.

Two words are *near* if they differ by exactly one inserted, deleted or replaced code point. Of two
near words the shorter (of equal lengths: both in turn) contributes two disjoint chunks, its first
and its second half; the other contributes its positional grams of these lengths. One edit leaves a
chunk whole: the first half, unmoved, if the edit stands behind it, else the second half, moved by
the difference in length, which is 0 or 1. (A first half that has moved leaves the second half whole
as well, so other shifts within one need not be looked up.) Chunks and grams are joined on their
hash, length and place, and every pair that meets is verified by its edit distance.

Common chunks (an ending that a third of all words share) would pair all their words. Keys with more
than ``HOT_PAIRS`` pairs are therefore not joined but go a level deeper: with the chunk whole, the
edit lies in the rest of the word, which contributes two disjoint chunks in turn, so a key of the
next level holds three quarters of the word, then seven eighths. At the last level all but one code
point is fixed, and a key holds no more words than the alphabet allows. Nothing is dropped on the
way: a near pair that leaves a level with a common key is found on a deeper one. Each level
aggregates, joins and stores; keys that are joined are small, so no task gets a large group.

A word's *form* is its near word of the largest count, if that is at least twice its own; its *root*
is where the forms lead, found by pointer jumping (a count at least doubles with every form, so a
few rounds do).

Defined results
    null texts have no words; a null doc_id counts as an empty id in the hash of :func:`with_slips`.
    Words that repeat in the count table are added up, null or empty words are left out. Ties between forms
    go to the smallest word in code-point order. An empty table gives an empty result. Words of any
    length are taken whole. Other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmart.llm.storage import stored
from obsmart.llm.text import ascii_lower

LETTERS = r"A-Za-zÀ-ÿ"
MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2                # a form is at least so many times as frequent
SLIP = 97
HOT_PAIRS = 4096         # pairs of one key that are still compared one by one
BROADCAST_KEYS = 1 << 20  # common keys (8 bytes each) up to which their list goes to every task


def letter_runs(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """doc_id, run: one row for every maximal run of at least ``min_chars`` letters, A-Z lower-cased."""
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("run")).withColumn("run", ascii_lower(F.col("run")))


def with_slips(runs: DataFrame, every: int = SLIP) -> DataFrame:
    """The runs, of which those whose h = crc32 of ``<doc_id>:<run>`` is divisible by ``every`` have
    lost their code point number h % length (from 0)."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    cut = (F.col("__h") % F.length("run")).cast("int")
    lost = F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run")))
    return (runs.withColumn("__h", h)
            .withColumn("run", F.when(F.col("__h") % every == 0, lost).otherwise(F.col("run"))).drop("__h"))


def word_counts(runs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the runs that are long and frequent enough."""
    return (runs.where(F.length("run") >= min_chars).groupBy(F.col("run").alias("word"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _sides(words: DataFrame) -> DataFrame:
    """x, word, n, l, a, b: every word once as the one that is cut into chunks (x), and once for each
    length l of such a word that it may be near to. a and b: code points at the front and at the back
    that are taken as whole."""
    size = F.length("word")
    sides = F.array(F.struct(F.lit(True).alias("x"), size.alias("l")), F.struct(F.lit(False).alias("x"), size.alias("l")),
                    F.struct(F.lit(False).alias("x"), (size - 1).alias("l")))
    return (words.select("word", "n", F.inline(sides)).where("l > 0")
            .withColumns({"a": F.lit(0), "b": F.lit(0)}))


def _keyed(sides: DataFrame) -> DataFrame:
    """Every side once with the first half of its rest taken as whole and once with the second half:
    that is the chunk of an x, and the gram at its place of any other word. ``key`` is its hash."""
    rest = F.col("l") - F.col("a") - F.col("b")
    half = F.floor((rest + 1) / 2).cast("int")
    chunks = F.array(F.struct((F.col("a") + half).alias("a2"), F.col("b").alias("b2")),
                     F.struct(F.col("a").alias("a2"), (F.col("b") + rest - half).alias("b2")))
    cut = (sides.select("x", "word", "n", "l", F.inline(chunks))
           .select("x", "word", "n", "l", F.col("a2").alias("a"), F.col("b2").alias("b")))
    front = F.substring("word", F.lit(1), F.col("a"))
    back = F.substring("word", F.length("word") - F.col("b") + 1, F.col("b"))
    return cut.withColumn("key", F.xxhash64("l", front, F.lit(0), back))


def near_words(words: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """word, n, other, other_n: both directions of every near pair of ``words`` (word, n), once."""
    sides, found = _sides(words), None
    while True:
        keyed = _keyed(sides)
        pairs = F.count_if("x") * F.count_if(~F.col("x"))
        common = stored(keyed.where("l - a - b > 1").groupBy("key").agg(pairs.cast("double").alias("pairs"))
                        .where(F.col("pairs") > hot_pairs).select("key"))
        n_common = common.count()
        mark = F.broadcast(common) if n_common <= BROADCAST_KEYS else common
        rare = keyed.join(mark, "key", "left_anti") if n_common else keyed
        left = rare.where("x").select("key", "word", "n")
        right = rare.where("not x").select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
        met = left.join(right.hint("merge"), "key").where(
            ((F.length("word") < F.length("other")) | (F.col("word") < F.col("other")))
            & (F.levenshtein("word", "other", 1) == 1))
        met = stored(met.select("word", "n", "other", "other_n"))
        found = met if found is None else found.unionAll(met)
        if not n_common:
            break
        sides = stored(keyed.join(mark, "key", "left_semi").drop("key"))
    both = found.unionAll(found.select(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                       F.col("word").alias("other"), F.col("n").alias("other_n")))
    return both.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root for every row (word, form): the end of the chain of forms."""
    at = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("on"))
        moved = stored(at.join(on, "root", "left").select("word", F.coalesce("on", "root").alias("root"),
                                                          F.col("on").isNotNull().alias("moved")))
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def group_variants(words: DataFrame, ratio: int = RATIO, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``words`` (word, n)."""
    words = stored(words.where(F.length("word") > 0).groupBy("word").agg(F.sum("n").alias("n")))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = (near_words(words, hot_pairs).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    more = (-F.col("best.less") >= ratio * F.col("n"))
    judged = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(more, F.col("best.other")).alias("form"),
        F.when(more, -F.col("best.less")).alias("form_n")))
    roots = _roots(judged.where("form is not null"))
    return (judged.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
