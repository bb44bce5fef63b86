"""Document fingerprints of closed syncmers.

A text is a sequence of words. Of all windows of ``K`` words those are chosen whose least inner
piece of ``S`` words (by hash) is the first or the last piece: whether a window is chosen depends
on the window alone, so equal passages give equal anchors wherever they stand. A fingerprint is the
chosen windows' hashes in text order, eight hex digits each; on average 2 of K - S + 1 windows are
chosen. Likeness is the share of anchors in common (Dice: twice the common ones by all).

DataFrame functions only. The documents' order (descending doc_id) is made over ids alone, by range
partitions whose heads are linked; then texts are shuffled once, and again only the half of each
next text that an edited text takes, with the next document's anchors.

Defined results
    null text counts as empty and has an empty fingerprint, as a text without words. A text with
    words of which no window is chosen (also one of fewer than K words) has one anchor, its whole
    word sequence. Two empty fingerprints are alike (1),
    an empty one is unlike any other (0). Ties in doc_id go by a hash of the text, null ids last;
    fully equal rows are one place in the order and get equal results. A single document is its own
    next. An empty table gives an empty result. Further columns are passed through, except those
    named like an output column, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsmart.llm.storage import stored
from obsmart.llm.text import held, whole, words

K, S = 8, 2
EDIT = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "next_doc_id"]


def _short_hash(values: list[Column]) -> Column:
    return F.xxhash64(*values).bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int")


def with_anchors(df: DataFrame, text: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """``df`` with the anchors of column ``text`` as an array of hashes, in text order."""
    w, pieces = f"__w_{out}", f"__s_{out}"
    df = df.withColumn(w, held(F.transform(words(whole(F.col(text))), lambda x: F.xxhash64(x))))
    n = F.size(w)
    df = df.withColumn(pieces, held(F.when(n >= k, F.transform(
        F.sequence(F.lit(0), n - s), lambda i: F.xxhash64(*[F.get(F.col(w), i + j) for j in range(s)])))))
    first, last = 0, k - s

    def chosen(i: Column) -> Column:
        inner = [F.get(F.col(pieces), i + j) for j in range(first, last + 1)]
        return F.least(*inner).isin(inner[first], inner[last])

    anchors = F.transform(F.filter(F.sequence(F.lit(0), n - k), chosen),
                          lambda i: _short_hash([F.get(F.col(w), i + j) for j in range(k)]))
    short = F.array(F.aggregate(w, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x))
                    .bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int"))
    none = F.array().cast("array<int>")
    df = df.withColumn(out, held(F.when(n >= k, anchors)))
    chosen_none = F.coalesce(F.size(out), F.lit(0)) <= 0
    return df.withColumn(out, held(F.when(n == 0, none).when(chosen_none, short).otherwise(F.col(out)))).drop(w, pieces)


def fingerprint(anchors: Column) -> Column:
    return F.array_join(F.transform(anchors, lambda a: F.lpad(F.hex(a), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two anchor sets."""
    da, db = F.array_distinct(a), F.array_distinct(b)
    total = F.size(da) + F.size(db)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(da, db)) / total)


def following(docs: DataFrame) -> DataFrame:
    """doc_id, h, next_doc, next_h, n: for each distinct (doc_id, text) its successor by descending
    doc_id (the last one's is the first), and the length of its text."""
    ids = docs.select("doc_id", F.xxhash64(whole(F.col("text"))).alias("h"), F.length(whole(F.col("text"))).alias("n")).distinct()
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").asc()]
    rows = stored(ids.repartitionByRange(*order).withColumn("block", F.spark_partition_id()))
    inside = Window.partitionBy("block").orderBy(*order)
    rows = stored(rows.select("*", F.row_number().over(inside).alias("at"),
                              F.lead(F.struct("doc_id", "h")).over(inside).alias("next")))
    # one row per range partition
    heads = rows.where("at = 1").select("block", F.struct("doc_id", "h").alias("head"))
    by_block = Window.orderBy("block")
    after = heads.select("block", F.coalesce(F.lead("head").over(by_block), F.first("head").over(by_block)).alias("after"))
    rows = rows.join(after, "block").withColumn("next", F.coalesce("next", "after"))
    return rows.select("doc_id", "h", "n", F.col("next.doc_id").alias("next_doc"), F.col("next.h").alias("next_h"))


def _key(doc_id: str, h: str) -> Column:
    """A document's place as one column that is never null."""
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("~")), F.col(h).cast("string"))


def fingerprints(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """``docs`` with its fingerprint (all columns kept): the operator by itself."""
    d = with_anchors(docs.drop("fingerprint"), "text", "__anchors", k, s)
    return d.withColumn("fingerprint", fingerprint(F.col("__anchors"))).drop("__anchors")


def edited_fingerprints(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """``docs`` without text, with the columns of ``EDIT``: every text against its edited text (its
    second half replaced by the beginning of the next document's) and against the next document."""
    order = stored(following(docs).select(_key("next_doc", "next_h").alias("__k"), _key("doc_id", "h").alias("__for"),
                                          F.floor(F.col("n") / 2).cast("int").alias("__half")))
    own = [c for c in docs.columns if c not in ("text", *EDIT)]
    text = whole(F.col("text"))
    d = docs.select(*own, text.alias("__text"), F.xxhash64(text).alias("__h"))
    # both uses of the texts come from this one join and read the same columns, so that their
    # shuffle is made once
    d = d.withColumn("__k", _key("doc_id", "__h")).drop("__h").join(order, "__k")
    given = with_anchors(d.select("__for", "__half", "__text", "doc_id"), "__text", "__next_anchors", k, s)
    given = given.select(F.col("__for").alias("__k"), F.substring("__text", F.lit(1), F.col("__half")).alias("__given"), "__next_anchors", F.col("doc_id").alias("next_doc_id"))
    # a repeated row gives once
    given = given.groupBy("__k").agg(F.first("__given").alias("__given"), F.first("__next_anchors").alias("__next_anchors"),
                                     F.first("next_doc_id").alias("next_doc_id"))
    d = d.select(*own, "__k", "__text").join(given, "__k")
    d = with_anchors(d, "__text", "__anchors", k, s)
    n = F.length("__text")
    d = d.withColumn("__edited", F.concat(F.substring("__text", F.lit(1), (n - F.floor(n / 2)).cast("int")), F.col("__given")))
    d = with_anchors(d, "__edited", "__edited_anchors", k, s)
    return d.select(*own, n.cast("long").alias("n_chars"), F.sha2("__edited", 256).alias("edited_sha256"),
                    fingerprint(F.col("__anchors")).alias("fingerprint"),
                    fingerprint(F.col("__edited_anchors")).alias("edited_fingerprint"),
                    likeness(F.col("__anchors"), F.col("__edited_anchors")).alias("near_edited"),
                    likeness(F.col("__anchors"), F.col("__next_anchors")).alias("near_next"), "next_doc_id")
