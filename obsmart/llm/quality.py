"""Quality rules: basic counts, and the distance of a document from its language.

The reference of a language is gathered from all of its documents: the share of each character
class, and the shares of its common words (words that make up at least ``common_share`` of the
language, at most ``top_words`` of them). A document is compared by the Jensen-Shannon distance
(base 2, 0 to 1) of its own two histograms to those of its language. A minimum length guards each
comparison, because the distance of a short text is mostly noise.

DataFrame functions only. Texts are never shuffled: all counts of a document are made in its row,
and only (language, word) counts move, combined before the shuffle. There is one reference a
language, of ``top_words`` words at most; they are broadcast if the languages number at most
``BROADCAST_LANGUAGES`` (about 1 KB each), else joined by a shuffle.

Defined results
    null or empty text: no words, base_failed. A language that is null, or has less than
    ``least_bytes`` of text, has no reference: its documents are judged by the base rules alone. What
    other languages hold makes no difference. A word-less text has no repeated words. Rows are judged one by one, so repeated
    rows and ties get equal verdicts; an empty table gives an empty result. Further columns are
    passed through, except those named like an output column, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.llm.storage import stored
from obsmart.llm.text import SPACE, WORD, chars_of, held, whole, words

MIN_WORDS = 50                 # base rule
MAX_REPEAT_PERCENT = 50        # base rule: share of words inside repeated 3-word windows
SYMBOLS = r"#*$%&|<>"
WINDOW = 3

TOP_WORDS = 32
COMMON_SHARE = 0.002
LEAST_BYTES = 10_000          # of text in a language: less is no reference
BROADCAST_LANGUAGES = 10_000
MIN_CHARS_JUDGED = 400         # guard of the character histogram (bytes)
MIN_WORDS_JUDGED = 150         # guard of the word histogram
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.35

OUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
       "char_distance", "word_distance", "kept"]
# Character classes: capitals, digits, symbols, further bytes of non-ASCII characters, white space;
# the rest of a text's bytes is one more class.
N_CLASSES = 5


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.regexp_replace(x, f"{SPACE}+", "") != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows (structs of hash and position, sorted) found twice or more."""
    again = F.filter(windows, lambda x, i: (F.coalesce(F.get(windows, i - 1)["h"] == x["h"], F.lit(False))
                                            | F.coalesce(F.get(windows, i + 1)["h"] == x["h"], F.lit(False))))
    return F.sort_array(F.transform(again, lambda x: x["p"]))


def _covered(at: Column) -> Column:
    """Words under windows that begin at the (sorted) positions: each adds what it does not share
    with the next."""
    return F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def _classes(text: Column, n_symbols: Column, n_spaces: Column) -> Column:
    wide = F.octet_length(text) - F.length(text)
    return F.array(chars_of(text, "A-Z"), chars_of(text, "0-9"), n_symbols, wide.cast("long"), n_spaces.cast("long"))


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts, the words (``__words``) and character classes (``__chars``)."""
    own = [c for c in docs.columns if c not in OUT]
    text = whole(F.col("text"))
    d = docs.select(*own, held(words(text)).alias("__words"))
    w = F.col("__words")
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                         lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    d = d.withColumn("__hashes", held(F.when(F.size(w) >= WINDOW, hashes)))
    h = F.col("__hashes")
    d = d.withColumn("__windows", held(F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))))))
    d = d.withColumn("__at", held(_repeat_words(F.col("__windows"))))
    d = d.withColumns({"n_symbols": chars_of(text, SYMBOLS),
                       "word_chars": F.length(F.array_join("__words", "")).cast("long")})
    return d.select(
        *own, "__words",
        F.size(w).cast("long").alias("n_words"),
        "word_chars", "n_symbols",
        duplicate_lines(text).alias("n_dup_lines"),
        F.coalesce(_covered(F.col("__at")), F.lit(0)).cast("long").alias("n_repeat_words"),
        _classes(text, F.col("n_symbols"), F.length(text) - F.col("word_chars")).alias("__classes"),
        F.octet_length(text).cast("long").alias("__n"))


def base_failed(min_words: int = MIN_WORDS) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _histogram(parts: Column, n: Column) -> Column:
    """Counts of the parts and of the rest, as shares."""
    counts = F.concat(parts, F.array(n - F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x)))
    return F.transform(counts, lambda x: x / n)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares: 0 equal, 1 disjoint."""
    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.when(total.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), total)))


def references(docs: DataFrame, top_words: int = TOP_WORDS, common_share: float = COMMON_SHARE,
               least_bytes: int = LEAST_BYTES) -> DataFrame:
    """lang, common (words), common_p (their shares, then the rest's), char_p: one row per
    language with at least ``least_bytes`` of text."""
    text = whole(F.col("text"))
    spaces = F.length(F.regexp_replace(text, WORD, ""))
    chars = (docs.where("lang IS NOT NULL")
             .select("lang", F.octet_length(text).cast("long").alias("n"), _classes(text, chars_of(text, SYMBOLS), spaces).alias("c"))
             .groupBy("lang").agg(F.sum("n").alias("n"),
                                  *[F.sum(F.get("c", F.lit(i))).alias(f"c{i}") for i in range(N_CLASSES)]))
    chars = stored(chars)
    parts = F.array(*[F.col(f"c{i}") for i in range(N_CLASSES)])
    chars = (chars.where((F.col("n") >= least_bytes) & (F.col("n") > 0))
             .select("lang", _histogram(parts, F.col("n")).alias("char_p")))
    counts = (docs.where("lang IS NOT NULL").select("lang", F.explode(words(text)).alias("w"))
              .groupBy("lang", "w").agg(F.count(F.lit(1)).alias("c")))
    # a capital at the start of a sentence is no other word; merged here, over distinct words
    counts = stored(counts.groupBy("lang", F.lower("w").alias("w")).agg(F.sum("c").alias("c")))
    chars = stored(chars)
    sizes = _small(counts.groupBy("lang").agg(F.sum("c").alias("n")).join(_small(chars, chars), "lang", "left_semi"), chars)
    common = (counts.join(sizes, "lang").where(F.col("c") >= F.col("n") * common_share)
              .groupBy("lang", "n")
              .agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("c", "w")))), 1, top_words).alias("top")))
    common = common.select("lang", F.transform("top", lambda x: x["w"]).alias("common"),
                           _histogram(F.transform("top", lambda x: x["c"]), F.col("n")).alias("common_p"))
    return chars.join(common, "lang", "left")


def _small(df: DataFrame, languages: DataFrame) -> DataFrame:
    """``df`` (a row a language) marked for broadcast if there are few ``languages``."""
    return F.broadcast(df) if languages.count() <= BROADCAST_LANGUAGES else df


def judge(docs: DataFrame, refs: DataFrame | None = None, max_char: float = MAX_CHAR_DISTANCE,
          max_word: float = MAX_WORD_DISTANCE, min_chars_judged: int = MIN_CHARS_JUDGED,
          min_words_judged: int = MIN_WORDS_JUDGED) -> DataFrame:
    """``docs`` with the columns of ``OUT``. ``refs``: as from :func:`references` (or kept from an
    earlier corpus); by default gathered from ``docs``."""
    refs = stored(references(docs) if refs is None else refs)
    own = [c for c in docs.columns if c not in OUT]
    r = refs.select(F.col("lang").alias("__lang"), "common", "common_p", "char_p")
    r = r.select("__lang", *[F.col(c).alias(f"__{c}") for c in ("common", "common_p", "char_p")])
    d = counted(docs)
    d = d.join(_small(r, refs), d["lang"] == r["__lang"], "left")
    common = F.col("__common")
    # only words that are short enough to be common ones are lower-cased and compared; a null common
    # (no reference) leaves __short null
    longest = F.array_max(F.transform(common, lambda w: F.length(w)))
    d = d.withColumn("__longest", held(longest))
    short = F.transform(F.filter("__words", lambda w: F.length(w) <= F.col("__longest")), lambda w: F.lower(w))
    d = d.withColumn("__short", held(F.when((F.col("n_words") >= min_words_judged) & F.col("__longest").isNotNull(), short)))
    h = F.col("__short")
    per_word = F.transform(common, lambda w: (F.size(h) - F.size(F.array_remove(h, w))).cast("long"))
    d = d.withColumn("__hits", held(F.when(h.isNotNull(), per_word)))
    # every histogram and distance is pinned: each is used more than once below
    d = d.withColumns({"__word_p": held(_histogram(F.col("__hits"), F.col("n_words"))),
                       "__own_p": held(F.when(F.col("__n") >= min_chars_judged, _histogram(F.col("__classes"), F.col("__n"))))})
    d = d.withColumns({"char_distance": held(js_distance(F.col("__own_p"), F.col("__char_p"))),
                       "word_distance": held(js_distance(F.col("__word_p"), F.col("__common_p"))),
                       "base_failed": base_failed()})
    far = (F.coalesce(F.col("char_distance") > max_char, F.lit(False))
           | F.coalesce(F.col("word_distance") > max_word, F.lit(False)))
    d = d.withColumn("kept", ~F.col("base_failed") & ~far)
    return d.select(*own, *OUT)
