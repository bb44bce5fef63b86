"""Periodic runs against the definition (every period of every text), planted edits, odd rows."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import LONG, awkward

from obsmart.llm import periodic
from obsmart.llm.periodic import find_runs, periodic_runs
from obsmart.llm.queries import op11_sync_runs


def brute(w, min_words=6):
    """All (start, length, period): stretches where words q apart are equal, of smallest period q."""
    n, out, seen = len(w), [], set()
    for q in range(1, n // 4 + 1):
        s = None
        for i in range(n - q + 1):
            same = i < n - q and w[i] == w[i + q]
            if same and s is None:
                s = i
            if not same and s is not None:
                e = i + q
                if e - s >= max(min_words, 4 * q) and not any((a, b) == (s, e) for a, b in seen):
                    if not any(all(w[x] == w[x + r] for x in range(s, e - r)) for r in range(1, q)):
                        out.append((s, e - s, q))
                        seen.add((s, e))
                s = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_word(rng, letters):
    out = []
    while len(out) < rng.randint(5, 90):
        root = [rng.randrange(letters) for _ in range(rng.randint(1, 14))]
        out += (root * rng.randint(1, 9))[:rng.randint(1, 80)]
        if rng.random() < 0.3:
            out = out * rng.randint(1, 4)
    return out


def check(texts):
    got = find_runs([np.array(x, dtype=np.int64) for x in texts])
    for x, runs in zip(texts, got, strict=True):
        assert runs == brute(x), x


def test_against_the_definition():
    rng = random.Random(5)
    for letters in (1, 2, 3, 9):
        check([periodic_word(rng, letters)[:260] for _ in range(150)])
        check([[rng.randrange(letters) for _ in range(rng.randint(0, 120))] for _ in range(60)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 70)), max_size=5))
def test_made_of_repetitions(parts):
    check([[x for root, n in parts for x in (root * (n // len(root) + 1))[:n]]])


def test_long_periods():
    rng = random.Random(9)
    for q in (5, 8, 9, 16, 17, 100, 127, 128, 129, 1000):
        root = [rng.randrange(50) for _ in range(q)]
        head, tail = [-5, -6, -7], [-8] * 5
        for n in (4 * q - 1, 4 * q, 4 * q + 3, 7 * q + 1):
            body = (root * 9)[:n]
            got = find_runs([np.array(head + body + tail, dtype=np.int64)])[0]
            assert [r for r in got if r[2] == q] == ([(3, n, q)] if n >= 4 * q else [])


def test_columns(spark):
    docs = [(1, "a b a b a b a b c c c c c c"), (2, "x x x x x"), (3, None), (4, "one\ttwo\nthree\x0bfour five")]
    rows = {r.doc_id: r for r in periodic_runs(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert [tuple(r) for r in rows[1].runs] == [(0, 8, 2), (8, 6, 1)] and rows[1].collapsed == "a b c"
    assert rows[2].runs == [] and rows[2].collapsed == "x x x x x"        # five words are too few
    assert (rows[3].n_words, rows[3].runs, rows[3].collapsed) == (0, [], "")
    assert rows[4].collapsed == "one two three four five"


def plain(doc_id, text):
    """The contract's row from its definition."""
    w = (text or "").encode().split()
    n, h = len(w), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    drop = {i for s, k, q in runs for i in range(s + q, s + k)}
    left = b" ".join(x for i, x in enumerate(w) if i not in drop)
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed).hexdigest(), hashlib.sha256(left).hexdigest())


def test_query_against_the_definition(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{x}" for x in periodic_word(rng, 4))) for i in range(160)] + [(i, " ".join(f"v{rng.randrange(400)}" for _ in range(rng.randint(0, 150)))) for i in range(160, 400)]
    rows += [(400, None), (401, ""), (None, "z z z z z z z"), (7, "again"), (7, "again")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op11_sync_runs(spark, str(tmp_path)).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((plain(*r) for r in rows), key=repr)


def test_awkward_rows(spark, monkeypatch):
    out = periodic_runs(awkward(spark)).collect()
    assert len(out) == 13 and [r.runs for r in out if r.text is None] == [[], []]
    long = next(r for r in out if r.doc_id == 7)
    assert [tuple(x) for x in long.runs] == [(0, 20_000, 977)] and long.collapsed == " ".join(LONG.split()[:977])
    assert [r.kept for r in out] == ["k"] * 13 and len({r.collapsed for r in out if r.doc_id == 9}) == 1
    assert periodic_runs(awkward(spark, [])).count() == 0
    monkeypatch.setattr(periodic, "GROUP_WORDS", 3)      # groups of one text give the same
    assert list(periodic._searched([b"a a a a a a", None, b"b c b c b c b c"])) == [
        (6, [(0, 6, 1)], b"a"), (0, [], b""), (8, [(0, 8, 2)], b"b c")]
