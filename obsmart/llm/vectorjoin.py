"""Exact near-duplicate vectors by a metric range join over pivots.

Vectors are linked if their cosine is at least ``least``. For vectors of length one that is a
Euclidean distance of at most e = sqrt(2 - 2 least), so a range join in a metric space does it:

1. Equal vectors become one node with a count. Pivots are taken from a sample of about ``SAMPLE``
   nodes. Every node's *home* is the cell of its nearest pivot.
2. A node is copied into every other cell that may hold a home node within e of it. By the triangle
   inequality its distance to the cell's pivot is then at most the cell's radius plus e, at least
   the cell's least distance minus e, and at most its distance to its own pivot plus 2 e; the last
   bound is used in its sharper Euclidean form (the distance to the plane between two pivots).
3. Cells are joined independently: home nodes against all nodes in the cell. All links of a node are
   therefore counted in its own cell, once. Candidates are found by single-precision products with a
   margin and decided in double precision.

Work is dealt in *units*: a large cell (a hot group of near copies) is divided by hash into blocks of
its home nodes and parts of its nodes, every block meeting every part in one unit, so a task holds a
block of bounded size and streams a part past it. Links never become rows: a unit returns its home
nodes' numbers of links, and edges that span what it has linked (at most one for each node). The
components come from distributed star rounds over these edges.

How many pivots are used is decided on the sample: more pivots mean fewer comparisons and more
copies, and the cheapest number is taken. In data without clusters, where every vector is about as
far from every pivot, no metric partition can avoid comparing most pairs; clusters are what makes it
cheaper. The result is exact for any choice.

Defined results
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; so
    do vectors of different lengths with each other. Repeated rows are rows of their own: each counts
    the others as links. A null vec_id is no component_id unless its whole component has no id. ``kept``
    is true where vec_id equals component_id (both null included). An empty table gives an empty
    result. Further columns are passed through; columns named n_links, component_id or kept are
    replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.llm.components import components
from obsmart.llm.storage import stored

LEAST = 0.95
SAMPLE = 4096             # nodes (about) from which pivots are taken and their number is decided,
SAMPLE_VALUES = 1 << 21   # and components in them
MIN_PIVOTS, MAX_PIVOTS = 16, 1024
BLOCK_BYTES = 32 << 20    # home nodes that a task holds
PART_ROWS = 1 << 16       # nodes that are streamed past them
COPY_COST = 5000          # comparisons that take as long as one copy of a vector
MARGIN = 1e-6             # on distances, above rounding errors
TILE = (512, 2048)        # home nodes and candidates that are multiplied at a time
OUT = ["n_links", "component_id", "kept"]


def _scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows times a power of two (exact), so that squares neither overflow nor vanish; their lengths."""
    x = np.asarray(x, dtype=np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x, np.sqrt(np.einsum("ij,ij->i", x, x))


def _units(x: np.ndarray) -> np.ndarray:
    x, size = _scaled(x)
    return x / size[:, None]


def _distances(u: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (u @ pivots.T), 0))


class Cells:
    """The cells of vectors of one length: pivots, the nearest and farthest home node of each, and
    into how many blocks and parts each is divided."""

    def __init__(self, pivots: np.ndarray, least: float):
        self.pivots, self.reach = pivots, math.sqrt(max(2 - 2 * least, 0)) + MARGIN
        self.apart = np.maximum(_distances(pivots, pivots), 1e-9)
        k = len(pivots)
        self.near, self.far = np.full(k, np.inf), np.full(k, -np.inf)
        self.blocks = self.parts = np.ones(k, dtype=np.int64)
        self.first = np.zeros(k, dtype=np.int64)

    def homes(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances to all pivots; the nearest."""
        d = _distances(u, self.pivots)
        return d, d.argmin(axis=1)

    def reached(self, d: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Which cells may hold a home node within reach (the node's own always may)."""
        own = d[np.arange(len(d)), home][:, None]
        beyond = (d * d - own * own) / (2 * self.apart[home])
        return (d <= self.far + self.reach) & (d >= self.near - self.reach) & (beyond <= self.reach)

    def divide(self, homes: np.ndarray, reached: np.ndarray, block_rows: int, part_rows: int) -> None:
        self.blocks = np.maximum(-(-homes // block_rows), 1)
        self.parts = np.maximum(-(-reached // part_rows), 1)


def _block_rows(n: int, k: int, dim: int) -> int:
    """Home nodes of a unit: what a task may hold, and about twice an even share."""
    return int(max(1, min(BLOCK_BYTES // (12 * dim), max(1024, 2 * n // k))))


def choose_pivots(sample: np.ndarray, n: int, least: float) -> np.ndarray:
    """The pivots for ``n`` vectors like those of ``sample`` (unit rows in random order)."""
    m, dim = sample.shape
    start = max(MIN_PIVOTS, -(-n * 12 * dim // BLOCK_BYTES))
    best = None
    for k in sorted({max(1, min(int(start * f), MAX_PIVOTS, m // 2)) for f in (0.25, 1, 4, 16, 64)}):
        cells = Cells(sample[:k], least)
        d, home = cells.homes(sample[k:] if k < m else sample)
        at = d[np.arange(len(d)), home]
        np.minimum.at(cells.near, home, at)
        np.maximum.at(cells.far, home, at)
        reached = cells.reached(d, home).sum(axis=0) * (n / len(d))
        homes = np.bincount(home, minlength=k) * (n / len(d))
        cells.divide(homes, reached, _block_rows(n, k, dim), PART_ROWS)
        cost = float((homes * reached).sum() + COPY_COST * (reached * cells.blocks + homes * cells.parts).sum())
        if best is None or cost < best[0]:
            best = cost, k
    return sample[:best[1]]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for every vector length in column ``v``; at most 1024 rows at a time."""
    v = batch.column(batch.schema.get_field_index("v"))
    size = np.asarray(v.value_lengths())
    start = np.asarray(v.offsets)[:-1]
    values = np.asarray(v.values)
    for dim in np.unique(size).tolist():
        rows = np.flatnonzero(size == dim)
        for i in range(0, len(rows), 1024):
            some = rows[i:i + 1024]
            yield some, values[start[some][:, None] + np.arange(dim)]


def _plan_of(plan: dict[int, Cells], dim: int, least: float) -> Cells:
    """The cells for a length; one cell (any pivot will do) where the sample had no such vector."""
    if dim not in plan:
        plan[dim] = Cells(np.eye(1, dim), least)
    return plan[dim]


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return (x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(33)


def _home_stats(nodes: DataFrame, plan: dict[int, Cells], least: float) -> DataFrame:
    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _by_length(batch):
                cells = _plan_of(plan, x.shape[1], least)
                d, home = cells.homes(_units(x))
                at, k = d[np.arange(len(d)), home], len(cells.pivots)
                near, far = np.full(k, np.inf), np.full(k, -np.inf)
                np.minimum.at(near, home, at)
                np.maximum.at(far, home, at)
                n = np.bincount(home, minlength=k)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), x.shape[1])), pa.array(some), pa.array(n[some]), pa.array(near[some]), pa.array(far[some])],
                    names=["dim", "cell", "n", "near", "far"])

    return (nodes.select("v").mapInArrow(stats, "dim bigint, cell bigint, n bigint, near double, far double")
            .groupBy("dim", "cell").agg(F.sum("n").alias("n"), F.min("near").alias("near"), F.max("far").alias("far")))


def _reach_stats(nodes: DataFrame, plan: dict[int, Cells]) -> DataFrame:
    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _by_length(batch):
                n = plan[x.shape[1]].reached(*plan[x.shape[1]].homes(_units(x))).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), x.shape[1])), pa.array(np.arange(len(n))), pa.array(n.astype(np.int64))],
                                                 names=["dim", "cell", "n"])

    return (nodes.select("v").mapInArrow(stats, "dim bigint, cell bigint, n bigint")
            .groupBy("dim", "cell").agg(F.sum("n").alias("n")))


def _planned(nodes: DataFrame, least: float, part_rows: int) -> tuple[dict[int, Cells], int]:
    """The cells by vector length, with their bounds and divisions, and the number of units."""
    sizes = {r.dim: r.n for r in nodes.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = min(SAMPLE / max(sum(sizes.values()), 1), SAMPLE_VALUES / max(sum(d * n for d, n in sizes.items()), 1))
    low = int(-2 ** 63 + 2 ** 64 * share) if share < 1 else 2 ** 63 - 1
    drawn = sorted((r.h1, r.v) for r in nodes.where(F.col("h1") <= F.lit(low)).select("h1", "v").collect())
    plan: dict[int, Cells] = {}
    for dim in sorted({len(v) for _, v in drawn}):
        sample = _units(np.array([v for _, v in drawn if len(v) == dim]))
        plan[dim] = Cells(choose_pivots(sample, sizes[dim], least), least)
    homes: dict[tuple[int, int], int] = {}
    for r in _home_stats(nodes, plan, least).collect():
        cells = _plan_of(plan, r.dim, least)
        cells.near[r.cell], cells.far[r.cell], homes[r.dim, r.cell] = r.near, r.far, r.n
    reached = {(r.dim, r.cell): r.n for r in _reach_stats(nodes, plan).collect()}
    units = 0
    for dim, cells in plan.items():
        k = len(cells.pivots)
        cells.divide(np.array([homes.get((dim, i), 0) for i in range(k)]), np.array([reached.get((dim, i), 0) for i in range(k)]),
                     _block_rows(sizes[dim], k, dim), part_rows)
        each = cells.blocks * cells.parts
        cells.first = units + np.concatenate(([0], np.cumsum(each)[:-1]))
        units += int(each.sum())
    return plan, units


def _dealt(nodes: DataFrame, plan: dict[int, Cells]) -> DataFrame:
    """unit, candidate, node, n, v: a home node once for every part of its cell, and every node once
    for every block of every cell that it reaches."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = np.asarray(batch.column(batch.schema.get_field_index("node")))
            for rows, x in _by_length(batch):
                cells = plan[x.shape[1]]
                d, home = cells.homes(_units(x))
                block, part = _mixed(node[rows], 1), _mixed(node[rows], 2)
                at, unit, role = [], [], []
                for i in np.unique(home).tolist():
                    own = np.flatnonzero(home == i)
                    for p in range(cells.parts[i]):
                        at.append(own)
                        unit.append(cells.first[i] + (block[own] % np.uint64(cells.blocks[i])).astype(np.int64) * cells.parts[i] + p)
                        role.append(np.zeros(len(own), dtype=bool))
                who, cell = np.nonzero(cells.reached(d, home))
                for b in range(int(cells.blocks.max())):
                    some = b < cells.blocks[cell]
                    w, c = who[some], cell[some]
                    at.append(w)
                    unit.append(cells.first[c] + b * cells.parts[c] + (part[w] % cells.parts[c].astype(np.uint64)).astype(np.int64))
                    role.append(np.ones(len(w), dtype=bool))
                at, unit, role = np.concatenate(at), np.concatenate(unit), np.concatenate(role)
                for i in range(0, len(at), 8192):
                    cut = slice(i, i + 8192)
                    some = batch.take(pa.array(rows[at[cut]]))
                    yield pa.RecordBatch.from_arrays([pa.array(unit[cut]), pa.array(role[cut]), *some.columns], names=["unit", "candidate", *some.schema.names])

    kind = nodes.schema["v"].dataType.simpleString()
    return nodes.select("node", "n", "v").mapInArrow(deal, f"unit bigint, candidate boolean, node bigint, n bigint, v {kind}")


def _spanning(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Edges (node, least node) that connect what the matrix ``linked`` connects."""
    none = np.iinfo(np.int64).max
    a, b = left, right
    while True:
        a2 = np.minimum(a, np.where(linked, b[None, :], none).min(axis=1))
        b2 = np.minimum(b, np.where(linked, a2[:, None], none).min(axis=0))
        if np.array_equal(a, a2) and np.array_equal(b, b2):
            break
        a, b = a2, b2
    edges = np.stack([np.concatenate((left, right)), np.concatenate((a, b))], axis=1)
    return edges[edges[:, 0] != edges[:, 1]]


class _Unit:
    """The home nodes of a unit, and what the nodes streamed past them have linked."""

    def __init__(self, least: float):
        self.least, self.parts, self.edges, self.node = least, [], [], None

    def hold(self, node: np.ndarray, x: np.ndarray) -> None:
        self.parts.append((node, x))

    def settle(self) -> None:
        self.node = np.concatenate([p[0] for p in self.parts])
        self.x, self.size = _scaled(np.concatenate([p[1] for p in self.parts]))
        self.parts, self.links = [], np.zeros(len(self.node), dtype=np.int64)
        self.quick = (self.x / self.size[:, None]).astype(np.float32)

    def meet(self, node: np.ndarray, n: np.ndarray, x: np.ndarray) -> None:
        if self.parts:
            self.settle()
        if self.node is None:     # a block without home nodes
            return
        x, size = _scaled(x)
        quick = (x / size[:, None]).astype(np.float32)
        about = np.float32(self.least - 1e-4)     # far above single-precision errors
        for i in range(0, len(self.node), TILE[0]):
            for j in range(0, len(node), TILE[1]):
                near = self.quick[i:i + TILE[0]] @ quick[j:j + TILE[1]].T >= about
                if not near.any():
                    continue
                a, b = i + np.flatnonzero(near.any(axis=1)), j + np.flatnonzero(near.any(axis=0))
                linked = (self.x[a] @ x[b].T) / (self.size[a][:, None] * size[b]) >= self.least
                linked &= self.node[a][:, None] != node[b]
                if linked.any():
                    self.links[a] += linked @ n[b]
                    self.edges.append(_spanning(linked, self.node[a], node[b]))

    def result(self) -> pa.RecordBatch:
        own, n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        edges = np.unique(np.concatenate(self.edges), axis=0) if self.edges else np.zeros((0, 2), dtype=np.int64)
        if self.edges:
            own, n = self.node[self.links > 0], self.links[self.links > 0]
        no_end = np.arange(len(own) + len(edges)) < len(own)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((own, edges[:, 0]))), pa.array(np.concatenate((own, edges[:, 1])), mask=no_end),
             pa.array(np.concatenate((n, np.zeros(len(edges), dtype=np.int64))))], names=["u", "v", "n"])


def _joined(dealt: DataFrame, least: float) -> DataFrame:
    """u, v, n: numbers of links (v null) and spanning edges, of all units of a sorted stream."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, at = None, None
        for batch in batches:
            units, role = np.asarray(batch.column(0)), np.asarray(batch.column(1).cast(pa.int8()))
            node, n, v = np.asarray(batch.column(2)), np.asarray(batch.column(3)), batch.column(4)
            cut = np.flatnonzero((np.diff(units) != 0) | (np.diff(role) != 0)) + 1
            for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(units)], strict=True):
                if i == j:
                    continue
                if units[i] != at:
                    if unit is not None:
                        yield unit.result()
                    unit, at = _Unit(least), units[i]
                x = np.asarray(v.slice(i, j - i).flatten()).reshape(j - i, -1)
                if role[i]:
                    unit.meet(node[i:j], n[i:j], x)
                else:
                    unit.hold(node[i:j], x)
        if unit is not None:
            yield unit.result()

    return dealt.mapInArrow(join, "u bigint, v bigint, n bigint")


def usable(v: Column) -> Column:
    """Whether a vector can link: not null, some component, all finite, not all zero."""
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda c: c != 0), F.lit(False))


def link_vectors(vectors: DataFrame, vector: str = "embedding", least: float = LEAST, part_rows: int = PART_ROWS) -> DataFrame:
    """``vectors`` (vec_id, a vector, ...) with n_links (other rows of cosine >= ``least``),
    component_id (the smallest vec_id that links lead to, its own included) and kept."""
    passed = [c for c in vectors.columns if c not in OUT]
    v = F.col(vector)
    hashes = {f"__h{i}": F.when(usable(v), F.xxhash64(F.lit(i), v)) for i in (1, 2)}
    nodes = (vectors.withColumns(hashes).where("__h1 is not null").groupBy(F.col("__h1").alias("h1"), F.col("__h2").alias("h2"))
             .agg(F.first(vector).alias("v"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least_id")))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()))
    plan, units = _planned(nodes, least, part_rows)
    dealt = _dealt(nodes, plan).repartitionById(max(units, 1), F.col("unit").cast("int")).sortWithinPartitions("unit", "candidate")
    found = stored(_joined(dealt, least))
    links = found.where("v is null").groupBy("u").agg(F.sum("n").alias("links"))
    hangs = components(found.where("v is not null").select("u", "v"))
    ids = nodes.select("node", "least_id")
    least_of = hangs.join(ids, "node").groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = hangs.join(least_of, "component").select("node", "component_id")
    judged = (nodes.select("node", "h1", "h2", "n", "least_id").join(links, nodes["node"] == links["u"], "left").join(named, "node", "left")
              .select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                      F.coalesce("component_id", "least_id").alias("__component")))
    rows = vectors.select(*passed).withColumns(hashes)
    out = rows.join(judged, (rows["__h1"] == judged["h1"]) & (rows["__h2"] == judged["h2"]), "left")
    component = F.when(F.col("__h1").isNull(), F.col("vec_id")).otherwise(F.col("__component"))
    return out.select(*passed, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
