"""Periodic runs of words, found through string synchronising sets.

A *run* is a stretch of words with smallest period q (words q apart are equal), at least four
periods and ``MIN_WORDS`` words long, that no neighbouring word extends. Every text is searched
whole, in three steps:

1. Highly periodic regions with a period of at most ``SMALL`` words are read off directly, by
   comparing the text with itself moved by q words.
2. For every scale t = SMALL, 2 SMALL, 4 SMALL, ... the positions of a synchronising set are chosen:
   i belongs to it if the least hash of the stretches of t words that start in [i, i + t] stands at
   i or at i + t. That depends on the 2 t words from i on alone, so equal contexts are chosen alike.
   Stretches inside runs already found, with periods of at most t / 4, are left out of the choice:
   there the hashes repeat and every position would be chosen.
3. Two neighbouring chosen positions with the same context propose their distance d as a period if
   t < d <= 2 t. The proposal is extended in both directions by comparing words, so what is
   returned is exact.

Why nothing is missed: take a run of period q and the scale with t < q <= 2 t. Its first q
stretches of t words are not all left out (else a shorter period would cover more than a period of
the run), so one of them has the least hash of the whole run and stands in the set; with four
periods, its copy one period on has its whole context inside the run as well. The context is at
least as long as the period, so the copy is the next position with the same context, and the
distance is the smallest period. Contexts are compared as 64-bit hashes; a collision could only
hide a proposal, never make a wrong run.

Texts are searched many at a time in numpy arrays, with a separator of its own after each. Spark
deals the texts; nothing is shuffled or gathered.

Defined results
    null or empty text, or white space alone: no words, no runs, collapsed text is empty. Rows are
    independent: repeated rows and null ids are returned as they are, ties between runs are
    ordered by start, then period. A text of any length is searched whole by one task, in memory
    proportional to its words. An empty table gives an empty result. Further columns are passed
    through; columns named n_words, runs or collapsed are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsmart.llm.text import held, whole, words

MIN_PERIODS = 4
MIN_WORDS = 6
SMALL = 4                # a power of two: periods up to here are read off directly
GROUP_WORDS = 250_000    # words searched at a time (a longer text alone)
OUT = ["n_words", "runs", "collapsed"]
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shifts and odd multipliers), in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _doubled(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of stretches of 2 ``step`` words from those of ``step`` words."""
    out = h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    if step < len(h):
        out[:-step] += h[step:]
    return _mixed(out)


def _window_min(h: np.ndarray, t: int) -> np.ndarray:
    """The least of h[i .. i + t] (t a power of two), for every i that has all of them."""
    m, w = h, 1
    while w < t:
        m, w = np.minimum(m[:-w], m[w:]), 2 * w
    return np.minimum(m[:-1], m[1:])


def _small_runs(ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of all stretches with a period of at most SMALL, four periods long."""
    for q in range(1, min(SMALL, len(ids) // MIN_PERIODS) + 1):
        same = np.zeros(len(ids) - q + 2, dtype=np.int8)
        same[1:-1] = ids[q:] == ids[:-q]
        edge = np.diff(same)
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = stop - start >= (MIN_PERIODS - 1) * q
        for s, e in zip(start[long].tolist(), stop[long].tolist(), strict=True):
            if not any(q % r == 0 and np.array_equal(ids[s:s + q], np.roll(ids[s:s + q], r)) for r in range(1, q)):
                yield s, e + q, q


def _extended(ids: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The longest stretch around i in which words d apart are equal (separators end it)."""
    last, x, step = len(ids) - d, i, 64
    while x < last:
        differ = ids[x:min(x + step, last)] != ids[x + d:min(x + step, last) + d]
        if differ.any():
            x += int(differ.argmax())
            break
        x, step = min(x + step, last), 2 * step
    end, x, step = x + d, i, 64
    while x > 0:
        low = max(x - step, 0)
        differ = (ids[low:x] != ids[low + d:x + d])[::-1]
        if differ.any():
            x -= int(differ.argmax())
            break
        x, step = low, 2 * step
    return x, end


def _proposals(h: np.ndarray, context: np.ndarray, t: int, left_out: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Chosen positions and distances to the next chosen position with the same context."""
    if left_out is not None:
        h = np.where(left_out, _NONE, h)
    least = _window_min(h, t)
    n = len(least)
    chosen = np.flatnonzero(((least == h[:n]) | (least == h[t:t + n])) & (least != _NONE))
    order = np.argsort(context[chosen], kind="stable")
    at = chosen[order]
    c = context[at]
    d = at[1:] - at[:-1]
    good = (c[1:] == c[:-1]) & (d > t) & (d <= 2 * t)
    i, d = at[:-1][good], d[good]
    by = np.argsort(i)
    return i[by], d[by]


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """For each text, an array of word numbers: its runs (start, length, period), sorted."""
    sizes = np.array([len(x) for x in texts], dtype=np.int64)
    first = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(sizes + 1, out=first[1:])
    ids = np.empty(int(first[-1]), dtype=np.int64)
    for k, x in enumerate(texts):
        ids[first[k]:first[k + 1] - 1] = x
        ids[first[k + 1] - 1] = -1 - k
    found = list(_small_runs(ids))
    held_texts, t = np.arange(len(texts)), 1
    at, h = np.arange(len(ids)), _mixed(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7))
    while True:
        keep = sizes[held_texts] >= MIN_PERIODS * (max(t, SMALL) + 1)
        if not keep.any():
            break
        if not keep.all():     # only texts that are long enough for a period of this scale go on
            held_of = np.repeat(keep, sizes[held_texts] + 1)
            at, h, held_texts = at[held_of], h[held_of], held_texts[keep]
        context = _doubled(h, t)
        if t >= SMALL:
            moved = np.zeros(len(texts), dtype=np.int64)     # from places in all texts to places in those held
            moved[held_texts] = np.concatenate(([0], np.cumsum(sizes[held_texts] + 1)[:-1])) - first[held_texts]
            left_out = None
            old = np.array([r for r in found if MIN_PERIODS * r[2] <= t and r[1] - r[0] >= t], dtype=np.int64).reshape(-1, 3)
            text_of = np.searchsorted(first, old[:, 0], side="right") - 1
            old, text_of = old[np.isin(text_of, held_texts)], text_of[np.isin(text_of, held_texts)]
            if len(old):
                edge = np.zeros(len(h) + 1, dtype=np.int32)
                np.add.at(edge, old[:, 0] + moved[text_of], 1)
                np.add.at(edge, old[:, 1] - t + 1 + moved[text_of], -1)
                left_out = np.cumsum(edge[:-1]) > 0
            ends: dict[int, int] = {}     # by period: end of the last stretch looked at
            i, d = _proposals(h, context, t, left_out)
            for p, q in zip(at[i].tolist(), d.tolist(), strict=True):
                if p + q + t > ends.get(q, -1):
                    s, e = _extended(ids, p, q)
                    ends[q] = e
                    if e - s >= MIN_PERIODS * q:
                        found.append((s, e, q))
        h, t = context, 2 * t
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for s, e, q in sorted(set(found)):
        if e - s >= MIN_WORDS:
            k = int(np.searchsorted(first, s, side="right")) - 1
            out[k].append((s - int(first[k]), e - s, q))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def _collapsed(tokens: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without what any run holds after its first period, joined by spaces."""
    if not runs:
        return b" ".join(tokens)
    keep = np.ones(len(tokens), dtype=bool)
    for s, length, q in runs:
        keep[s + q:s + length] = False
    return b" ".join(compress(tokens, keep.tolist()))


def _searched(texts: list[bytes | None]) -> Iterator[tuple[int, list, bytes]]:
    """(number of words, runs, collapsed text) of every text; about GROUP_WORDS words at a time."""
    def done(group):
        number = defaultdict(count().__next__)
        ids = [np.fromiter(map(number.__getitem__, x), dtype=np.int64, count=len(x)) for x in group]
        for x, runs in zip(group, find_runs(ids), strict=True):
            yield len(x), runs, _collapsed(x, runs)

    group, size = [], 0
    for text in texts:
        tokens = (text or b"").split()      # bytes split at exactly \x20 and \x09-\x0D
        if group and size + len(tokens) > GROUP_WORDS:
            yield from done(group)
            group, size = [], 0
        group.append(tokens)
        size += len(tokens)
    if group:
        yield from done(group)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, runs (array of start, length, period; by start, then period) and
    collapsed: the text's words without what any run holds after its first period."""
    passed = [c for c in docs.columns if c not in OUT]
    fields = [docs.schema[c] for c in passed]
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)),
                           T.StructField("collapsed", T.StringType())])
    text_at = passed.index("text")
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_searched(batch.column(text_at).cast(pa.binary()).to_pylist()))
            sizes = pa.array([r[0] for r in rows], pa.int64())
            runs = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r[1]] for r in rows], run_type)
            left = pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes, runs, left], names=[*passed, *OUT])

    return docs.select(*passed).mapInArrow(search, schema)


def best_run(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties go to the first in order."""
    none = F.lit(None).cast(RUN.simpleString())
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) where every tenth text by the crc32 of its id repeats itself from
    some word on: h = crc32(doc_id), g = h div 10, word i >= a = g % n becomes word a + (i - a) % p
    with p = 1 + (n - a) div (3 + g % 8). Texts without words and rows without an id stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.expr("__h div 10")
    own = docs.columns
    df = docs.withColumn("__h", h)
    df = df.withColumn("__w", held(F.when(F.col("__h") % 10 == 0, words(whole(F.col("text"))))))
    df = df.withColumn("__n", F.size("__w")).withColumn("__a", F.when(F.col("__n") > 0, (g % F.col("__n")).cast("int")))
    df = df.withColumn("__p", (1 + F.floor((F.col("__n") - F.col("__a")) / (3 + g % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("__w", F.col("__a") + 1, F.col("__p")),
                                    F.ceil((F.col("__n") - F.col("__a")) / F.col("__p")).cast("int")))
    edited = F.array_join(F.concat(F.slice("__w", F.lit(1), F.col("__a")), F.slice(tail, F.lit(1), F.col("__n") - F.col("__a"))), " ")
    return df.withColumn("text", F.when(F.col("__a").isNotNull(), edited).otherwise(F.col("text"))).select(*own)
