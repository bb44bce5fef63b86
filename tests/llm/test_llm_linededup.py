"""Line de-duplication against plain dictionaries; levels and fresh lines of the runs."""

import hashlib
import random
import string
from collections import defaultdict

from llm_cases import LINE, awkward

from obsmart.llm.linededup import LineRuns, dedup_lines, hashed_lines

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    key = lambda x: x.strip(SPACE).translate(LOWER)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == doc]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_against_brute_force(spark):
    rng = random.Random(6)
    pool = [f"shared line number {i} with some words" for i in range(12)] + ["short", "", "É" * 20, "é" * 20, "x" * 20, "y" * 19]
    rows = []
    for d in range(120):
        lines = [rng.choice([str.upper, str, lambda x: f" \t{x}\r"])(rng.choice(pool)) if rng.random() < 0.5 else f"own line {rng.random()}"
                 for _ in range(rng.randint(0, 8))]
        rows.append((d * 7 % 120, "\n".join(lines) if lines else rng.choice([None, ""])))
    got = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = brute(rows)
    for r in got.collect():
        assert (r.n_lines, r.n_dropped, r.text) == want[r.doc_id]
    one = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), batches=1).collect()}
    assert one == {d: x[2] for d, x in want.items()}


def test_levels_and_fresh_lines(spark):
    runs = LineRuns(fanout=2)
    for b in range(5):
        df = spark.createDataFrame([(b * 10 + i, f"{'common' if i else b} line that is long enough") for i in range(3)], "doc_id bigint, text string")
        lines = hashed_lines(df)
        assert runs.fresh(lines).count() == (3 if b == 0 else 1)
        runs.add(lines)
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    # every hash lies in one run, and the batches' known lines are the updates
    held = [(r.h1, r.h2) for run in runs.runs() for r in run.collect()]
    assert len(held) == len(set(held)) == 6
    assert [u.count() for u in runs.updates] == [0, 1, 1, 1, 1] and runs.known(lines).count() == 3
    settled = sorted((r.n_docs, r.max_doc) for r in runs.settled().collect())
    assert settled == [(1, 0), (1, 10), (1, 20), (1, 30), (1, 40), (10, 42)]


def test_awkward_rows(spark):
    df = awkward(spark)
    out = dedup_lines(df).collect()
    assert len(out) == 13
    holders = [r for r in out if LINE in r.text]
    assert [r.doc_id for r in holders] == [8]
    assert {hashlib.md5(r.text.encode()).hexdigest() for r in out if r.doc_id == 9} == {hashlib.md5(b"repeated row of words").hexdigest()}
    assert dedup_lines(awkward(spark, [])).count() == 0
