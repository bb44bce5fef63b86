"""Counts against plain Python, the distance against numpy, verdicts on made-up languages."""

import random
import re
from collections import Counter

import numpy as np
from llm_cases import awkward
from pyspark.sql import functions as F

from obsmart.llm.quality import js_distance, judge

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit)


def test_counts(spark):
    rng = random.Random(3)
    texts = [None, "", " \t", "a", "a a a a", "a b c a b c x a b c", "x\nx\n \n \nx y", "#a *$ %&|<>", "é ü \U0001F600"]
    texts += [" ".join(rng.choices("abc", k=rng.randint(1, 60))) + rng.choice(["", "\nq\nq"]) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "en", "z") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, n_words string")
    got = {r.doc_id: r for r in judge(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t), t
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_distance(spark):
    p, q = [0.5, 0.25, 0.25, 0.0], [0.1, 0.2, 0.0, 0.7]
    m = (np.array(p) + q) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x)
    row = spark.createDataFrame([(p, q)], "p array<double>, q array<double>").select(js_distance(F.col("p"), F.col("q")), js_distance(F.col("p"), F.col("p"))).first()
    assert abs(row[0] - np.sqrt((kl(p) + kl(q)) / 2)) < 1e-12 and row[1] == 0


def test_verdict_finds_what_is_unlike_its_language(spark):
    rng = random.Random(5)
    common = ["the", "of", "and", "to", "in", "is", "that"]

    def prose(n):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else "w" + "".join(rng.choices("abcdefgh", k=6)) for _ in range(n))

    rows = [(i, prose(300), "en") for i in range(200)]
    rows += [(1000, " ".join("w" + "".join(rng.choices("abcdefgh", k=6)) for _ in range(300)), "en")]       # no common words
    rows += [(1001, " ".join(x + "%%%" for x in prose(300).split()), "en"), (1002, prose(60), "en"), (1003, "few words", "en"), (1004, prose(300), None)]
    got = {r.doc_id: r for r in judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(200)) and got[1002].kept and got[1004].kept
    assert not got[1000].kept and not got[1001].kept and got[1003].base_failed and not got[1003].kept
    assert got[1004].char_distance is None


def test_verdict_does_not_depend_on_other_languages(spark):
    rng = random.Random(6)
    common = ["el", "de", "que", "la", "los"]
    prose = lambda n, c: " ".join(rng.choice(c) if rng.random() < 0.5 else "w" + "".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    rare = [(i, prose(300, common), "es") for i in range(20)] + [(99, "%$ " * 300, "es")]
    verdicts = []
    for others in (0, 3000):
        rows = rare + [(1000 + i, "the of and to in is that it on as " * 3, "en") for i in range(others)]
        got = {r.doc_id: (r.kept, r.char_distance, r.word_distance) for r in judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).where("doc_id < 1000").collect()}
        verdicts.append(got)
    assert verdicts[0] == verdicts[1] and not verdicts[0][99][0] and all(verdicts[0][i][0] for i in range(20))
    few = spark.createDataFrame([(1, "short " * 100, "xx")], "doc_id bigint, text string, lang string")
    assert judge(few).first().char_distance is None                               # under the least amount of text


def test_filter_above_does_not_change_rows_and_awkward_rows_pass(spark):
    out = judge(awkward(spark))
    assert out.count() == 13 and out.where("n_repeat_words >= 0 AND kept IS NOT NULL").count() == 13
    assert judge(awkward(spark, [])).count() == 0
