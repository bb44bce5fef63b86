"""Agreement of signatures with weighted similarity; groups against all pairs."""

import random

import numpy as np
from llm_cases import awkward

from obsmart.llm.dartminhash import Darts, Shingles, _by_rare_elements, keep_first, near_duplicates


def test_agreement_is_weighted_similarity():
    rng = np.random.default_rng(1)
    darts = Darts(512)
    for scale in (1.0, 0.3):
        x = rng.integers(1, 2**63, 60, dtype=np.uint64)
        w1 = rng.integers(0, 5, 60) * scale
        w2 = np.where(rng.random(60) < 0.6, w1, rng.integers(0, 5, 60) * scale)
        want = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
        a, b = (darts.signature(x[w > 0], w[w > 0]) for w in (w1, w2))
        assert abs((a == b).mean() - want) < 4 * np.sqrt(want * (1 - want) / 512)
    assert (darts.signature(x[:1], np.array([0.001])) == darts.signature(x[:1], np.array([0.001]))).all()


def corpus():
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 3000)}"
    texts = []
    for _ in range(12):                                           # groups of edited copies
        base = [word() for _ in range(rng.randint(40, 200))]
        texts += [" ".join(base)] * rng.randint(1, 3)
        for _ in range(rng.randint(0, 12)):
            edit = list(base)
            for _ in range(rng.randint(1, 6)):
                edit[rng.randrange(len(edit))] = word()
            texts.append(" ".join(edit))
    passage = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(100)] + passage) for _ in range(30)]
    texts += ["", None, "one two", "ONE two", "a b c d e", "a a a a a a a a", "a a a a a a a"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def brute(rows, threshold=0.8):
    sets = {i: dict(zip(*(x.tolist() for x in Shingles().of(t or "")))) for i, t in rows}
    group = {i: i for i in sets}
    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for i, a in rows:
        for j, b in rows[:i]:
            A, B = sets[i], sets[j]
            same = sum(min(A[g], B[g]) for g in A.keys() & B.keys())
            total = sum(A.values()) + sum(B.values()) - same
            if (a or "") == (b or "") or (total and same >= threshold * total):
                x, y = root(i), root(j)
                group[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}


def test_groups_against_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    assert {r.doc_id: r.class_id for r in near_duplicates(df).collect()} == want
    assert sorted(r.doc_id for r in keep_first(df).collect()) == sorted(set(want.values()))


def test_awkward_rows(spark):
    df = awkward(spark)
    out = near_duplicates(df).collect()
    assert len(out) == 13 and sum(r.doc_id is None for r in out) == 2
    by = {r.doc_id: r.class_id for r in out if r.doc_id is not None}
    assert by[1] == by[8] == 1 and by[9] == 9 and by[7] == 7
    kept = keep_first(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()].count(9) == 1
    assert near_duplicates(awkward(spark, [])).count() == 0 and keep_first(awkward(spark, [])).count() == 0


def test_ids_do_not_matter(spark):
    """Any doc_id comes back, and unlike texts under one id stay apart: none is lost."""
    rng = random.Random(21)
    a, b = (" ".join(f"{x}{rng.randint(0, 10**6)}" for _ in range(60)) for x in "ab")
    rows = [(1, a), (1, b), (2, a), (3, b + " more"), (-5, "five words are in here"), (-7, "seven"), (None, "no id"), (-2**63, "least"), (2**63 - 1, "most"), (None, a)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = near_duplicates(df)
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == sorted(str(r[0]) for r in rows)
    named = out.groupBy("class_node").agg({"doc_id": "count", "class_id": "min"}).collect()
    assert len(named) == 7 and {r["min(class_id)"] for r in named} == {1, -5, -7, None, -2**63, 2**63 - 1}
    kept = sorted((str(r.doc_id), r.text) for r in keep_first(df).collect())
    assert kept == sorted((str(i), t) for i, t in [rows[0], rows[1], *rows[4:9]])


def test_templates_do_not_meet(spark):
    """Texts that share a long template but are not alike: no pair is joined, whatever their number."""
    rng = random.Random(9)
    word = lambda: rng.randint(-2**62, 2**62)
    template = [word() for _ in range(196)]
    joined = []
    for n in (50, 100, 200):
        sets = [(i, i, template + [word() for _ in range(34)]) for i in range(n)]
        df = spark.createDataFrame(sets, "node bigint, comp bigint, elements array<bigint>")
        pairs = _by_rare_elements(df, 0.8)
        assert pairs.count() == 0
        plan = pairs._jdf.queryExecution().executedPlan()
        joined.append(rows_joined(plan))
    assert max(joined) == 0


def rows_joined(plan):
    """Output rows of the joins in an executed plan."""
    while plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    total, todo = 0, [plan]
    while todo:
        p = todo.pop()
        if "QueryStage" in p.nodeName():
            p = p.plan()
        if "Join" in p.nodeName():
            total += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return total


def template_pairs():
    """Variants of one template, all just under the threshold to each other, each with one partner
    over it that stands far off in doc_id: every bucket is large and mixed."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    template = [word() for _ in range(200)]
    first, second = [], []
    for _ in range(250):
        own = [word() for _ in range(26)]
        first.append(" ".join(template + own))
        second.append(" ".join(template + own[:5] + [word() for _ in own[5:]]))
    return list(enumerate(first + second))


def test_pairs_in_large_mixed_buckets(spark):
    df = spark.createDataFrame(template_pairs(), "doc_id bigint, text string")
    for rounds in (1, 0):                                         # merging rounds do not matter
        assert {r.doc_id: r.class_id for r in near_duplicates(df, rounds=rounds).collect()} == {i: i % 250 for i in range(500)}


def test_rare_elements_have_every_pair(spark):
    """The prefix join against all pairs, on sets with many common elements."""
    rng = random.Random(6)
    sets = [rng.sample(range(60), rng.randint(1, 50)) for _ in range(60)]
    for i in range(0, 60, 2):                                     # a near copy of each second one
        sets[i + 1] = sorted({*sets[i][1:], rng.randint(0, 59)}) or [0]
    spread = [[(e * 0x9E3779B97F4A7C15) % 2**64 - 2**63 for e in x] for x in sets]
    df = spark.createDataFrame([(i, i, x) for i, x in enumerate(spread)], "node bigint, comp bigint, elements array<bigint>")
    got = {(r.u, r.v) for r in _by_rare_elements(df, 0.8).collect()}
    want = {(i, j) for i, a in enumerate(map(set, sets)) for j, b in enumerate(map(set, sets[:i])) if len(a & b) >= 0.8 * len(a | b)}
    assert len(want) > 10 and want <= got
