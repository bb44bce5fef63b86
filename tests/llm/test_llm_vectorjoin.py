"""Vector links against comparison of all pairs: clusters, copies, hot groups, odd vectors."""

import numpy as np
import pytest

from obsmart.llm import vectorjoin
from obsmart.llm.queries import op13_pivot_join
from obsmart.llm.vectorjoin import Cells, _spanning, choose_pivots, link_vectors

KIND = "vec_id bigint, embedding array<{}>, label int"


def brute(rows, least=0.95):
    """(vec_id, n_links, component_id, kept) of every row."""
    def fine(v):
        return bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(c != 0 for c in v)

    n = len(rows)
    unit = [np.array(v, dtype=float) / np.abs(v).max() if fine(v) else None for _, v in rows]
    unit = [u if u is None else u / np.sqrt(u @ u) for u in unit]
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j])
             and unit[i] @ unit[j] >= least] for i in range(n)]
    group = list(range(n))
    for _ in range(n):
        lower = [min([group[i], *(group[j] for j in near[i])]) for i in range(n)]
        if lower == group:
            break
        group = lower
    least_id = {g: min((rows[i][0] for i in range(n) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    return sorted(((rows[i][0], len(near[i]), least_id[group[i]], rows[i][0] == least_id[group[i]]) for i in range(n)), key=repr)


def got(spark, rows, kind="double", **kw):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], KIND.format(kind))
    return sorted((tuple(r) for r in link_vectors(df, **kw).select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def clustered(rng, n, dim, centres, spread):
    c = rng.normal(size=(centres, dim))
    c /= np.linalg.norm(c, axis=1)[:, None]
    x = c[rng.integers(centres, size=n)] + spread * rng.normal(size=(n, dim))
    return x * rng.uniform(0.1, 50, size=(n, 1))


@pytest.mark.parametrize("dim,centres,spread", [(8, 12, 0.05), (8, 12, 0.09), (3, 40, 0.05), (2, 5, 0.3), (32, 400, 0.02)])
def test_against_all_pairs(spark, dim, centres, spread):
    rng = np.random.default_rng(dim * 31 + centres)
    x = clustered(rng, 500, dim, centres, spread)
    rows = [(int(i) * 3 % 1000 + 7, x[i].tolist()) for i in range(500)]
    assert got(spark, rows) == brute(rows)


def test_hot_group_in_many_units(spark, monkeypatch):
    monkeypatch.setattr(vectorjoin, "_block_rows", lambda n, k, dim: 20)
    rng = np.random.default_rng(4)
    x = np.concatenate([clustered(rng, 250, 16, 1, 0.04), clustered(rng, 150, 16, 60, 0.02)])
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).astype(float).tolist())]
    rows += [(400 + i, rows[i % 3][1]) for i in range(60)]       # exact copies
    assert got(spark, rows, kind="float", part_rows=90) == brute(rows)


def test_chain_of_links(spark):
    rows = [(100 - i, [float(np.cos(i / 4)), float(np.sin(i / 4))]) for i in range(12)]
    assert got(spark, rows) == brute(rows)
    assert {r[2] for r in got(spark, rows)} == {89}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]),
            (9, [5e-324, 0.0]), (10, [1e300, 1e295]), (11, [-1.0, 0.0]), (11, [-1.0, -0.0]), (None, [0.0, 1.0]), (None, [0.0, 2.0]), (None, [1.0, 1e-3]), (12, [2.0])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    again = [(1, [1.0, 2.0])] * 3
    assert got(spark, again) == [(1, 2, 1, True)] * 3


def test_further_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "a", 9), (2, [1.0, 0.1], "b", 9)], "vec_id bigint, embedding array<double>, kept string, node bigint")
    rows = link_vectors(df).orderBy("vec_id").collect()
    assert [(r.vec_id, r.node, r.n_links, r.component_id, r.kept) for r in rows] == [(1, 9, 1, 1, True), (2, 9, 1, 1, False)]


def test_every_link_reaches_the_home_cell():
    rng = np.random.default_rng(1)
    x = clustered(rng, 1500, 6, 30, 0.08)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    cells = Cells(choose_pivots(u, 10 ** 6, 0.95), 0.95)
    assert len(cells.pivots) >= 16
    d, home = cells.homes(u)
    at = d[np.arange(len(u)), home]
    np.minimum.at(cells.near, home, at)
    np.maximum.at(cells.far, home, at)
    reached = cells.reached(d, home)
    a, b = np.nonzero(u @ u.T >= 0.95)
    assert reached[b, home[a]].all() and reached.mean() < 0.5     # whole, and far from copying all to all


def test_spanning_edges():
    linked = np.array([[1, 0, 1, 0], [0, 0, 1, 0], [0, 0, 0, 1]], dtype=bool)
    edges = _spanning(linked, np.array([5, 9, 7]), np.array([6, 11, 8, 10]))
    assert sorted(map(tuple, edges.tolist())) == [(6, 5), (8, 5), (9, 5), (10, 7)]


def test_query_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    out = op13_pivot_join(spark, sf)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows)
