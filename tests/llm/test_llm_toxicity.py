"""Folding, the automaton against plain search, and held-out accuracy."""

import random
import zlib

from llm_cases import awkward
from pyspark.sql import functions as F

import math
from collections import Counter

import numpy as np

from obsmart.llm.toxicity import BEGINNINGS, MIN_DOCS, MIN_LOG_ODDS, Lexicon, fit_sample, folded, toxicity

BAD = ["blorgen", "snagfit", "wrunkle"]


def test_folding():
    assert folded("  Тhe 1D10T,\u200b saуs: ＨＩ!") == " the idiot says hi "
    assert folded("") == "  " and folded("ü-é") == " ü é "


def test_matches_against_plain_search():
    rng = random.Random(1)
    terms = {" ab ": 3.0, " abc": 4.0, " b": 1.0, " cc ": 2.0}
    lex = Lexicon(terms, [" ab cc "])
    for _ in range(300):
        words = ["".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(rng.randint(0, 12))]
        text = " " + " ".join(words) + " "
        want, at = {}, 0
        for w in words:
            fits = [v for t, v in terms.items() if (f" {w} " == t if t.endswith(" ") else f" {w}".startswith(t))]
            if fits:
                want[at] = max(fits)
            at += len(w) + 1
        for i in range(len(text)):
            if text.startswith(" ab cc ", i):
                want = {s: v for s, v in want.items() if not i <= s < i + 6}
        assert lex.matches(text) == want, text


def test_held_out_accuracy_with_disguises_and_exceptions(spark):
    rng = random.Random(7)
    docs, labels = [], []
    for i in range(1200):
        words = ["".join(rng.choices("aeioumnrst", k=rng.randint(2, 6))) for _ in range(rng.randint(20, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(6):
                w = rng.choice(BAD)
                w = rng.choice([w, w.upper(), w.replace("o", "0").replace("i", "1"), w + rng.choice("xyz") * 2])
                words.insert(rng.randrange(len(words)), w)
        elif i % 7 == 0:
            words.insert(rng.randrange(len(words)), "snagfit pliers")         # harmless use
        docs.append((i, " ".join(words) if i != 3 else None))
        labels.append((i, int(toxic)))
    out = toxicity(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    assert len(out) == 1200
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 0.98 * len(held)


def plain_scores(docs, labels):
    """The whole method in plain Python: terms, weights, exceptions, logistic fit, scores."""
    toxic = {d: t for d, t in labels if zlib.crc32(str(d).encode()) % 5}
    train = [(folded(t or ""), toxic[d]) for d, t in docs if d in toxic]
    n = Counter(t for _, t in train)
    pos, neg = Counter(), Counter()
    word_pos, word_neg = Counter(), Counter()
    for text, t in train:
        (word_pos if t else word_neg).update(set(text.split()))
    for counts, into in ((word_pos, pos), (word_neg, neg)):
        for w, c in counts.items():
            into[f" {w} "] += c
            for k in range(BEGINNINGS[0], min(BEGINNINGS[1], len(w) - 1) + 1):
                into[" " + w[:k]] += c
    weight = {t: math.log((p + 0.5) / (n[1] + 1)) - math.log((neg[t] + 0.5) / (n[0] + 1)) for t, p in pos.items() if p >= MIN_DOCS}
    terms = {t: w for t, w in weight.items() if w >= MIN_LOG_ODDS}

    def hits(text, phrases):
        words, found, at = text.split(), {}, 0
        for w in words:
            fits = [v for t, v in terms.items() if (t == f" {w} " if t.endswith(" ") else f" {w} ".startswith(t))]
            if fits:
                found[at] = max(fits)
            at += len(w) + 1
        for i in range(len(words) - 1):
            start = sum(len(x) + 1 for x in words[:i])
            if f" {words[i]} {words[i + 1]} " in phrases:
                found.pop(start, None)
                found.pop(start + len(words[i]) + 1, None)
        return found, len(words)

    yes, no = Counter(), Counter()
    for text, t in train:
        words, starts = text.split(), hits(text, ())[0]
        at, phrases = 0, set()
        for i, w in enumerate(words):
            if at in starts:
                phrases |= {f" {w} {x} " for x in words[i + 1:i + 2]} | {f" {x} {w} " for x in words[max(0, i - 1):i]}
            at += len(w) + 1
        (yes if t else no).update(phrases)
    phrases = {p for p, c in no.items() if c >= MIN_DOCS and c >= 19 * yes[p]}

    def features(text):
        found, size = hits(text, phrases)
        total = math.fsum(found.values())
        return [1.0, math.log1p(total), math.log1p(total / math.sqrt(max(1, size)))]

    x, y, b = np.array([features(t) for t, _ in train]), np.array([t for _, t in train]), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b = b + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3), x.T @ (y - p) - 1e-2 * b)
    return {d: 1 / (1 + math.exp(-float(np.dot(b, features(folded(t or "")))))) for d, t in docs}


def test_scores_against_plain_code(spark):
    rng = random.Random(12)
    docs, labels = [], []
    for i in range(400):
        words = ["".join(rng.choices("aeiou", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 60))]
        toxic = i % 4 == 0
        if toxic:
            words += [rng.choice(BAD) + rng.choice(["", "ed", "er"]) for _ in range(rng.randint(1, 4))]
        elif i % 3 == 0:
            words += ["snagfit", "pliers"]
        rng.shuffle(words) if toxic else None
        docs.append((i, " ".join(words)))
        if i % 10 < 8:
            labels.append((i, int(toxic)))
    got = {r.doc_id: r.score for r in toxicity(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    want = plain_scores(docs, labels)
    assert got.keys() == want.keys() and max(abs(got[d] - want[d]) for d in want) < 1e-6
    assert len(set(want.values())) > 10


def test_the_fitted_sample_is_bounded(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"))
    assert 800 < fit_sample(df, 20_000, 1000).count() < 1200 and fit_sample(df, 20_000, 30_000).count() == 20_000


def test_awkward_rows_and_no_labels(spark):
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id bigint, toxic int, text int")
    out = toxicity(awkward(spark), none).collect()
    assert len(out) == 13 and all(r.score == 0 and r.predicted == 0 for r in out)
    some = spark.createDataFrame([(i, i % 2, 0) for i in range(10)], "doc_id bigint, toxic int, text int")
    assert toxicity(awkward(spark), some).count() == 13
    assert toxicity(awkward(spark, []), some).count() == 0
