"""Spelling variants against comparison of all pairs, with common chunks and odd rows."""

import random
import re
import zlib
from collections import Counter

from llm_cases import awkward

from obsmart.llm.queries import op12_chunk_variants
from obsmart.llm.spelling import group_variants, letter_runs, near_words, with_slips, word_counts

WORDS = "word string, n bigint"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    forms, out = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * n else None
        out[w] = (n, len(others))
    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w
    return sorted((w, forms[w], root(w), *out[w], counts[forms[w]] if forms[w] else None) for w in counts)


def got(spark, counts, **kw):
    rows = group_variants(spark.createDataFrame(list(counts.items()), WORDS), **kw).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[0])


def made_words(rng, n, letters):
    out = set()
    while len(out) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
        out.add(w)
        if rng.random() < 0.5:      # an edit of it
            i = rng.randrange(len(w) + 1)
            out.add(rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:], w[:i] + w[i + 1:]]) or "z")
    return {w: rng.randint(1, 40) for w in out}


def test_against_all_pairs(spark):
    rng = random.Random(8)
    for letters, hot in (("ab", 4096), ("ab", 3), ("abcéßÀ", 8), ("abcdefgh", 1)):
        counts = made_words(rng, 300, letters)
        assert got(spark, counts, hot_pairs=hot) == brute(counts)


def test_common_chunks_go_deeper(spark):
    rng = random.Random(2)
    counts = {("start" if i % 2 else "") + "".join(rng.choice("abcde") for _ in range(4)) + "ending": 3 + i % 50 for i in range(500)}
    assert got(spark, counts, hot_pairs=16) == brute(counts)
    frame = spark.createDataFrame(list(counts.items()), WORDS)
    pairs = {(r.word, r.other) for r in near_words(frame, hot_pairs=16).collect()}
    assert pairs == {(a, b) for a in counts for b in counts if near(a, b)}
    assert near_words(frame, hot_pairs=16).count() == len(pairs)


def test_chain_of_forms(spark):
    counts = {"a" * 5 + "b" * i: 3 * 2 ** i for i in range(20)}
    rows = got(spark, counts)
    assert {r[2] for r in rows} == {"a" * 5 + "b" * 19} and rows == brute(counts)


def plain_words(rows, every=97):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def test_query_against_the_definition(spark, tmp_path):
    rng = random.Random(4)
    pool = ["".join(rng.choice("aeiouéÉBTR") for _ in range(rng.randint(3, 8))) for _ in range(150)]
    rows = [(i, rng.choice([" ", "-", "7"]).join(rng.choice(pool) for _ in range(rng.randint(0, 80)))) for i in range(300)]
    rows += [(None, "Sieben sieben SIEBEN siebem"), (5, None), (6, ""), (5, "naïve naïve naïve naive"), (5, "naïve 中文 x×y")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = op12_chunk_variants(spark, str(tmp_path)).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = plain_words(rows)
    assert len(want) >= 100 and any(w for w in want if "É" in w)
    assert sorted((tuple(r) for r in out), key=lambda r: r[0]) == brute(want)


def test_slips(spark):
    runs = spark.createDataFrame([(i, "étéword") for i in range(400)], "doc_id bigint, run string")
    for r in with_slips(runs, every=3).collect():
        h = zlib.crc32(f"{r.doc_id}:étéword".encode())
        assert r.run == ("étéword" if h % 3 else "étéword"[:h % 7] + "étéword"[h % 7 + 1:])


def test_awkward_rows(spark):
    counts = word_counts(letter_runs(awkward(spark)), 1, 1)
    assert {r.word: r.n for r in counts.collect()}["word"] == 20_000
    assert group_variants(counts).count() == counts.count()
    assert group_variants(word_counts(letter_runs(awkward(spark, [])))).count() == 0
    odd = spark.createDataFrame([("twice", 2), ("twice", 3), (None, 4), ("", 9), ("x" * 30_000, 1), ("x" * 30_001, 5)], WORDS)
    rows = {r.word: r for r in group_variants(odd).collect()}
    assert len(rows) == 3 and rows["twice"].n == 5 and rows["x" * 30_000].form == "x" * 30_001
