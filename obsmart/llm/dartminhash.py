"""Near-duplicate documents by DartMinHash signatures and a banded join.

A document is a weighted set: its five-word shingles, weighted by how often they occur. The plane
of weight and rank above every shingle is filled with hashed darts, at one dart per unit area and
alike for every document. A document owns the darts under its weight; each dart also has one of
``COORDS`` coordinates, and the dart of least rank is the document's value there. Two documents
agree in a coordinate with probability sum(min weight) / sum(max weight). Only about
k ln k + 2 k darts are thrown for a document of any length, because the ranks looked at shrink as
its total weight grows; while a coordinate is still empty, further ranks are looked at.

Coordinates are joined in bands of ``ROWS``. Every member of a bucket is first paired with the
bucket's least member; in buckets of more than ``SMALL`` members, those that still lie in different
groups are paired with their neighbours in the order of the next bands (range-sorted over the
cluster) and with a pivot that differs by band. These steps only merge what is easily merged. An
exact step then settles every bucket that still holds several groups: up to ``SMALL`` members all
pairs of different groups are looked at, and the members of larger buckets are joined by the rarest
shingles of their sets (prefix filter: two sets of the wanted similarity share one of their first
n - ceil(threshold n) + 1 elements in any common order, and the smaller set one of its first
n - ceil(2 threshold / (1 + threshold) n) + 1, so a shingle that a large template shares is looked up
by sets but posted by few). So each pair that shares a band is checked
on whole shingle sets, lies in one group already, or cannot reach the threshold; the result does not
depend on the number of merging rounds. The links' connected components are the groups.

Equal texts form one class first, a node with a number of its own; one row of its least doc_id
brings its text where it is needed. With 24 bands of 4, a pair of
similarity 0.8 misses all bands with probability 3e-6.

Defined results
    null text counts as empty. Texts without a word are alike only if equal; texts of one to four
    words are one shingle. A doc_id may be any number or null, and several texts may have the same
    one: classes are made of texts, not of ids. A class is named by its least doc_id (null only if all
    of its rows have none); unlike classes whose least doc_id is the same one have equal names and
    different ``class_node``. Repeated rows are each returned, in the same class. Long texts count
    whole. An empty table gives an empty result. Further columns are not carried by
    :func:`near_duplicates`; :func:`keep_first` returns all columns of its input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.llm.components import components
from obsmart.llm.sift import sifted
from obsmart.llm.storage import alone, stored
from obsmart.llm.text import hash128, whole

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
COORDS = BANDS * ROWS
LOWEST = 12                # ranks below 2 ** -LOWEST are one cell
ROUNDS = 1                 # merging rounds of neighbours and pivots; the exact step follows
SMALL = 16                 # members of a bucket up to which all pairs of different groups are made
ORDER_BITS = (14, 20)      # counters by which shingles are put in order: 2 ** of these, by their number
_WORDS_KEPT = 300_000      # word hashes kept per Python worker


class Darts:
    """Signatures of weighted sets (vectorised; one instance per task)."""

    def __init__(self, k: int = COORDS):
        import numpy as np

        self.np, self.k = np, k
        self.theta = k * math.log(k) + 2 * k
        self._cells: list[tuple[float, float]] = [(0.0, 2.0 ** -LOWEST)]
        self._cells += [(2.0 ** -i, 2.0 ** -i) for i in range(LOWEST, 0, -1)]   # (low, length)

    def mixed(self, x):
        """A 64-bit finalizer; wraps around."""
        np = self.np
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def _cell(self, c: int) -> tuple[float, float]:
        return self._cells[c] if c < len(self._cells) else (float(c - len(self._cells) + 1), 1.0)

    def _throw(self, layers, width, first: int, last: int):
        """(rank, id) of the darts in cells first..last-1 over unit weight layers. ``width``: how
        much of each layer the document's weight covers (1, less for the last of a fraction)."""
        np = self.np
        low, length = np.array([self._cell(c) for c in range(first, last)]).T
        seed = self.mixed(np.arange(first, last, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        u = self.mixed(layers[:, None] ^ seed[None, :])
        unit = (u >> np.uint64(11)) * 2.0 ** -53
        at_most = np.exp(-length)                      # chance of no dart in the cell
        row, cell = np.nonzero(unit > at_most)
        if not len(row):
            return np.empty(0), np.empty(0, np.uint64)
        u, unit, cell_length = u[row, cell], unit[row, cell], length[cell]
        n = np.ones(len(row), np.int64)
        term = total = at_most[cell]
        for more in range(1, 40):                      # invert the Poisson distribution
            term = term * cell_length / more
            total = total + term
            beyond = unit > total
            if not beyond.any():
                break
            n += beyond
        which = np.repeat(np.arange(len(row)), n)
        serial = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        dart = self.mixed(u[which] + serial.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        other = self.mixed(dart ^ np.uint64(0x8EBC6AF09C88C6E3))
        height = (self.mixed(other) >> np.uint64(11)) * 2.0 ** -53
        under = height <= width[row[which]]
        rank = low[cell[which]] + cell_length[which] * ((other >> np.uint64(11)) * 2.0 ** -53)
        return rank[under], dart[under]

    def signature(self, elements, weights):
        """k values (uint64) of a set of distinct uint64 elements with positive weights."""
        np = self.np
        whole_layers = np.maximum(1, np.ceil(weights)).astype(np.int64)
        which = np.repeat(np.arange(len(elements)), whole_layers)
        layer = np.arange(len(which)) - np.repeat(np.cumsum(whole_layers) - whole_layers, whole_layers)
        layers = self.mixed(elements[which] + layer.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
        width = np.minimum(1.0, weights[which] - layer)
        top = self.theta / float(weights.sum())
        best, out = np.full(self.k, np.inf), np.zeros(self.k, np.uint64)
        done = 0
        while True:
            last = self._until(top)
            for at in range(done, last, 64):           # bounded blocks for sets of little weight
                for rows in range(0, len(layers), 1 << 16):
                    rank, dart = self._throw(layers[rows:rows + (1 << 16)], width[rows:rows + (1 << 16)], at, min(last, at + 64))
                    self._keep(best, out, rank, dart)
            done = last
            if np.isfinite(best).all():
                return out
            top *= 2

    def _until(self, top: float) -> int:
        c = 0
        while self._cell(c)[0] < top:
            c += 1
        return c

    def _keep(self, best, out, rank, dart) -> None:
        np = self.np
        if not len(rank):
            return
        at = (dart % np.uint64(self.k)).astype(np.int64)
        least = best.copy()
        np.minimum.at(least, at, rank)
        new = (rank == least[at]) & (rank < best[at])
        out[at[new]] = dart[new]
        best[:] = least

    def bands(self, signature, rows: int = ROWS):
        """One hash per band of ``rows`` coordinates; differs between bands."""
        np = self.np
        parts = signature.reshape(-1, rows)
        h = np.arange(len(parts), dtype=np.uint64)
        for i in range(rows):
            h = self.mixed(h * np.uint64(0x2545F4914F6CDD1D) + parts[:, i])
        return h


class Shingles:
    """Hashes of the word shingles of texts, with their numbers."""

    def __init__(self, size: int = SHINGLE):
        import numpy as np
        import xxhash

        self.np, self.size, self._hash, self._known = np, size, xxhash.xxh3_64_intdigest, {}
        self._mixed = Darts.mixed

    def mixed(self, x):
        return self._mixed(self, x)

    def of(self, text: str):
        """(distinct shingle hashes, how often each occurs), sorted; empty without a word. Words
        are parted by white space, A-Z lower-cased."""
        np = self.np
        words = text.encode("utf-8", "surrogatepass").lower().split()
        known = self._known
        if len(known) > _WORDS_KEPT:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self._hash(w)
        h = np.array([known[w] for w in words], dtype=np.uint64)
        if not len(h):
            return h, np.empty(0)
        n = max(1, len(h) - self.size + 1)
        g = np.full(n, np.uint64(min(len(h), self.size)))
        for i in range(min(self.size, len(h))):
            g = self.mixed(g * np.uint64(0x2545F4914F6CDD1D) + h[i:i + n])
        distinct, counts = np.unique(g, return_counts=True)
        return distinct, counts.astype(np.float64)


def _hashed(docs: DataFrame) -> DataFrame:
    """doc_id, h1, h2 (hash of the text), text; null as empty."""
    text = whole(F.col("text"))
    h1, h2 = hash128(text)
    return docs.select("doc_id", h1.alias("h1"), h2.alias("h2"), text.alias("text"))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, h1, h2, bands, size (number of shingles): one row per document; no band without a
    word."""
    rows = _hashed(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator) -> Iterator:
        import numpy as np

        shingles, darts = Shingles(), Darts()
        for batch in batches:
            out, sizes = [], []
            for text in batch["text"]:
                elements, weights = shingles.of(text.as_py())
                sizes.append(int(weights.sum()))
                out.append(darts.bands(darts.signature(elements, weights)).view(np.int64) if len(elements) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["h1"], batch["h2"], pa.array(out, pa.list_(pa.int64())), pa.array(sizes, pa.int64())],
                                             ["doc_id", "h1", "h2", "bands", "size"])

    return rows.mapInArrow(sign, f"doc_id {kind}, h1 bigint, h2 bigint, bands array<bigint>, size bigint")


def _elements(docs: DataFrame) -> DataFrame:
    """node, elements: a number for the j-th occurrence of each shingle, so that common elements
    of two documents count the sum of the lesser weights."""
    def spread(batches: Iterator) -> Iterator:
        import numpy as np

        shingles = Shingles()
        for batch in batches:
            out = []
            for text in batch["text"]:
                g, counts = shingles.of(text.as_py())
                n = counts.astype(np.int64)
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                out.append(shingles.mixed(np.repeat(g, n) + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(out, pa.list_(pa.int64()))], ["node", "elements"])

    return docs.select("node", "text").mapInArrow(spread, "node bigint, elements array<bigint>")


def _sets(wanted: DataFrame, docs: DataFrame, heads: DataFrame) -> DataFrame:
    """node, elements of the wanted nodes (distinct). A text is taken from rows of its least doc_id,
    so copies of it do not move; the rows that are not wanted are sifted out before the shuffle."""
    who = stored(heads.join(wanted.hint("merge"), "node", "left_semi").select("node", "h1", "h2", F.col("least_doc").alias("doc_id")))
    own = sifted(_hashed(docs), who, "h1", "doc_id")
    own = own.join(who.withColumnRenamed("doc_id", "least"), ["h1", "h2"])
    # not as a join key: one shuffle by the text's hash then serves the next line as well
    own = own.where(F.when(F.col("doc_id").isNull(), F.col("least").isNull()).otherwise(F.col("doc_id") == F.col("least")))
    return _elements(own.dropDuplicates(["h1", "h2"]))


def _agree(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u > v, distinct) whose weighted Jaccard similarity reaches the threshold."""
    both = (pairs.join(sets.select(F.col("node").alias("u"), F.col("elements").alias("a")), "u")
            .join(sets.select(F.col("node").alias("v"), F.col("elements").alias("b")), "v")
            .select("u", "v", F.size("a").alias("na"), F.size("b").alias("nb"), F.size(F.array_intersect("a", "b")).alias("same")))
    return both.where(F.col("same") >= threshold * (F.col("na") + F.col("nb") - F.col("same"))).select("u", "v")


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()


def _checked(pairs: DataFrame, docs: DataFrame, heads: DataFrame, threshold: float) -> DataFrame:
    return _agree(pairs, stored(_sets(stored(_nodes(pairs)), docs, heads)), threshold)


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def _fits(a: Column, b: Column, threshold: float) -> Column:
    """Whether sets of these sizes can reach the threshold at all."""
    return F.least(a, b) >= threshold * F.greatest(a, b)


def _neighbours(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs of members of a bucket that follow each other when sorted by the next bands, and lie in
    different groups. Range partitions: a bucket may go over several (the exact step has the pair
    that meets at their border)."""
    def follow(batches: Iterator) -> Iterator:
        key = node = comp = size = None
        for batch in batches:
            u, v = [], []
            for k, n, c, z in zip(*(batch[x].to_pylist() for x in ("key", "node", "comp", "size"))):
                if k == key and c != comp and min(z, size) >= threshold * max(z, size):
                    u.append(max(n, node))
                    v.append(min(n, node))
                key, node, comp, size = k, n, c, z
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    order = ["key", "next1", "next2", "node"]
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "node", "comp", "size")
            .mapInArrow(follow, "u bigint, v bigint"))


def _slot(np, elements, bits: int):
    return (elements.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _prefix(n: int, threshold: float) -> tuple[int, int]:
    """Of a set of n elements in order: how many are looked up, and how many are posted. The first
    common element of two sets of the wanted similarity is within the former of both, and within the
    latter of the smaller one."""
    return n - math.ceil(threshold * n - 1e-9) + 1, n - math.ceil(2 * threshold / (1 + threshold) * n - 1e-9) + 1


def _by_rare_elements(sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs of nodes of different groups that can reach the threshold: of all pairs of ``sets``
    (node, comp, elements), those that share one of their rarest elements and whose sizes and places
    of that element allow it. Rare is what hashed counters say; the order alone does not lose pairs."""
    n_elements = sets.agg(F.sum(F.size("elements"))).first()[0] or 0
    bits = min(max(int(n_elements).bit_length(), ORDER_BITS[0]), ORDER_BITS[1])

    def count(batches: Iterator) -> Iterator:
        import numpy as np

        seen = np.zeros(1 << bits, np.int64)
        for batch in batches:
            elements = batch["elements"].flatten().to_numpy(zero_copy_only=False)
            seen += np.bincount(_slot(np, elements, bits), minlength=1 << bits)
        slot = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(seen[slot])], ["slot", "n"])

    import numpy as np

    often = np.zeros(1 << bits, np.int64)
    for batch in (sets.select("elements").mapInArrow(count, "slot bigint, n bigint")
                  .groupBy("slot").agg(F.sum("n").alias("n")).toArrow().to_batches()):
        often[batch["slot"].to_numpy()] = batch["n"].to_numpy()

    def rarest(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            out = []
            for node, comp, elements in zip(batch["node"].to_pylist(), batch["comp"].to_pylist(), batch["elements"]):
                e = elements.values.to_numpy(zero_copy_only=False)
                n, c = len(e), often[_slot(np, e, bits)]
                first = np.lexsort((e, c))[:_prefix(n, threshold)[0]]
                at = np.nonzero(c[first] > 1)[0]            # the others are in one set only
                posted = (at < _prefix(n, threshold)[1]).astype(np.int64)
                out.append((np.full(len(at), node), np.full(len(at), comp), np.full(len(at), n), at, e[first[at]], posted))
            cols = [np.concatenate(x).astype(np.int64) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 6
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["node", "comp", "n", "at", "e", "posted"])

    looked = stored(sets.select("node", "comp", "elements")
                    .mapInArrow(rarest, "node bigint, comp bigint, n bigint, at bigint, e bigint, posted bigint"))
    mixed = (looked.groupBy("e").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("posted").alias("some"))
             .where("lo <> hi AND some = 1").select("e"))
    looked = stored(looked.join(stored(mixed), "e", "left_semi"))
    a, b = (rows.select("e", *[F.col(x).alias(x + side) for x in ("node", "comp", "n", "at")])
            for rows, side in ((looked, "a"), (looked.where("posted = 1"), "b")))
    most = F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb"))    # at the first element in common
    return (a.join(b, "e").where("compa <> compb AND (na > nb OR na = nb AND nodea > nodeb)")
            .where(_fits(F.col("na"), F.col("nb"), threshold))
            .where(most >= threshold / (1 + threshold) * (F.col("na") + F.col("nb")) - 1e-6)
            .select(*_ordered(F.col("nodea"), F.col("nodeb"))).distinct())


def near_links(docs: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members: doc_id, h1, h2 - one row per document; heads: node, h1, h2, least_doc, ... - one row
    per text; groups: node, group - for texts that have a link)."""
    signed = stored(signatures(docs))
    # a text's bands are the same in all of its rows; the texts are numbered as they are stored
    heads = stored(signed.groupBy("h1", "h2").agg(F.min("doc_id").alias("least_doc"), F.first("bands").alias("bands"), F.first("size").alias("size"))
                   .withColumn("node", F.monotonically_increasing_id()))
    members = signed.select("doc_id", "h1", "h2")

    def bucket_rows() -> DataFrame:
        banded = (heads.select("node", "size", "bands", F.posexplode("bands").alias("band", "key"))
                  .select("key", "node", "size", F.get("bands", F.pmod(F.col("band") + 1, F.lit(BANDS))).alias("next1"),
                          F.get("bands", F.pmod(F.col("band") + 2, F.lit(BANDS))).alias("next2")))
        shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("node", "size")).alias("pivot"),
                                           F.min(F.struct(F.col("node").bitwiseXOR(F.col("key")).alias("mixed"), "size")).alias("other"))
        return banded.join(stored(shared.where("n > 1")), "key")

    rows = alone(bucket_rows)
    pairs = (rows.where("node <> pivot.node").where(_fits(F.col("size"), F.col("pivot.size"), threshold))
             .select(*_ordered(F.col("node"), F.col("pivot.node"))).distinct())
    seen = stored(pairs)
    links = alone(lambda: _checked(seen, docs, heads, threshold))
    groups = alone(lambda: components(links))

    def still_open(large_only: bool) -> DataFrame:
        """The rows of buckets that hold several groups; buckets of two are settled by their pivot."""
        g = groups.select("node", F.col("component").alias("comp"))
        now = rows.where(F.col("n") > (SMALL if large_only else 2)).join(g.hint("merge"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        now = stored(now)
        keys = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
        return now.join(stored(keys), "key", "left_semi")

    for _ in range(rounds):
        now = alone(lambda: still_open(True))
        g = groups.select(F.col("node").alias("p"), F.col("component").alias("p_comp"))
        pivot = (now.where(_fits(F.col("size"), F.col("other.size"), threshold))
                 .select("node", "comp", F.col("other.mixed").bitwiseXOR(F.col("key")).alias("p")).join(g.hint("merge"), "p", "left")
                 .where(F.col("comp") != F.coalesce("p_comp", "p")).select(*_ordered(F.col("node"), F.col("p"))))
        new = stored(_neighbours(now, threshold).unionByName(pivot).distinct().join(seen, ["u", "v"], "left_anti"))
        if new.isEmpty():
            break
        more = alone(lambda: _checked(new, docs, heads, threshold))
        seen, links = seen.unionByName(new), links.unionByName(more)
        if more.isEmpty():
            break
        groups = alone(lambda: components(links))

    now = alone(lambda: still_open(False))

    def exactly() -> DataFrame:
        few = now.where(F.col("n") <= SMALL).select("key", "node", "comp", "size")
        a, b = (few.select("key", *[F.col(x).alias(x + side) for x in ("node", "comp", "size")]) for side in "ab")
        few = (a.join(b, "key").where("nodea > nodeb and compa <> compb").where(_fits(F.col("sizea"), F.col("sizeb"), threshold))
               .select(F.col("nodea").alias("u"), F.col("nodeb").alias("v")).distinct().join(seen, ["u", "v"], "left_anti"))
        few = stored(few)
        many = stored(now.where(F.col("n") > SMALL).select("node", "comp").distinct())
        sets = stored(_sets(stored(_nodes(few).union(many.select("node")).distinct()), docs, heads))
        rare = _by_rare_elements(sets.join(many, "node"), threshold).join(seen, ["u", "v"], "left_anti")
        return _agree(stored(few.union(rare).distinct()), sets, threshold)

    more = alone(exactly)
    if not more.isEmpty():
        groups = alone(lambda: components(links.unionByName(more)))
    return members, heads.drop("bands"), groups.select("node", F.col("component").alias("group"))


def _classes(docs: DataFrame, threshold: float, rounds: int) -> tuple[DataFrame, DataFrame]:
    """(members, texts: h1, h2, node, least_doc, class_node, class_id)."""
    members, heads, groups = near_links(docs, threshold, rounds)
    texts = stored(heads.join(groups.hint("merge"), "node", "left").withColumn("class_node", F.coalesce("group", "node")))
    named = texts.groupBy("class_node").agg(F.min("least_doc").alias("class_id"))
    return members, texts.join(named.hint("merge"), "class_node").select("h1", "h2", "node", "least_doc", "class_node", "class_id")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, text_class (least doc_id with the same text), class_id (least
    doc_id of its near-duplicate group), class_node (a number of the group that no other has)."""
    members, texts = _classes(docs, threshold, rounds)
    return (members.join(texts.hint("merge"), ["h1", "h2"])
            .select("doc_id", F.col("least_doc").alias("text_class"), "class_id", "class_node"))


def keep_first(docs: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """The documents with one of each near-duplicate group: a row of its least doc_id. Other rows are
    sifted out before texts are shuffled."""
    members, texts = _classes(docs, threshold, rounds)
    order = F.struct(F.col("least_doc").isNull().alias("no_id"), "least_doc", "node")        # no id after every id
    first = stored(texts.groupBy("class_node").agg(F.min(F.struct(order.alias("o"), "h1", "h2", "least_doc")).alias("f"))
                   .select(F.col("class_node").alias("__class"), F.col("f.h1").alias("__h1"), F.col("f.h2").alias("__h2"),
                           F.col("f.least_doc").alias("__doc")))

    def of(rows: DataFrame, a: str, b: str) -> DataFrame:
        return rows.join(first.hint("merge"), (F.col(a) == F.col("__h1")) & (F.col(b) == F.col("__h2")) & F.col("doc_id").eqNullSafe(F.col("__doc")))

    again = not of(members, "h1", "h2").groupBy("__class").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    h1, h2 = hash128(whole(F.col("text")))
    rows = sifted(docs.withColumns({"__r1": h1, "__r2": h2}), first.select(F.col("__h1").alias("__r1"), F.col("__doc").alias("doc_id")), "__r1", "doc_id")
    kept = of(rows, "__r1", "__r2")
    return (kept.dropDuplicates(["__class"]) if again else kept).select(*docs.columns)
