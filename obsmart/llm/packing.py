"""Packing documents into training sequences by best-fit decreasing.

A document's ids (its text's, then an end id) are cut into full windows of ``window`` ids and one
rest. Full windows are sequences of their own. Rests are packed by best-fit decreasing: from the
longest to the shortest, each goes into the open window with the least room that still holds it,
found in a segment tree over the remaining room; if there is none, it opens a window.

Spark deals the pieces to groups of about ``rows_per_group`` by a hash of the piece, so a long
document's pieces are spread, and each group is packed on its own from a sorted stream: a task
holds its open windows, not its pieces. The number of groups follows the number of pieces. Ids
themselves are not shuffled: a piece travels as its place, length and checksum, and
:func:`sequences` cuts the ids again where they are wanted.

Defined results
    null or empty text: the end id alone, one piece. Repeated rows are packed once each. Ties in
    length go by doc_id, start and checksum. A null doc_id is kept. An empty table gives an empty
    result. Other columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmart.llm.storage import stored
from obsmart.llm.text import whole
from obsmart.llm.tokens import ChunkEncoder, public_tokenizer

WINDOW = 4096
END_ID = 2
ROWS_PER_GROUP = 8192
TOKENIZER = "word_bpe_49k.json"
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class BestFit:
    """Open windows by remaining room; leaf r of the segment tree says whether a window has room r."""

    def __init__(self, window: int):
        self.leaves = 1
        while self.leaves <= window:
            self.leaves *= 2
        self.some = [False] * (2 * self.leaves)
        self.open: dict[int, list[int]] = {}
        self.window, self.n = window, 0

    def _tightest(self, need: int) -> int:
        """The least room >= need of an open window, or -1: up from the leaf until a right
        neighbour holds one, then down its leftmost path."""
        at = need + self.leaves
        if not self.some[at]:
            while at > 1 and (at & 1 or not self.some[at + 1]):
                at //= 2
            if at == 1:
                return -1
            at += 1
            while at < self.leaves:
                at = 2 * at if self.some[2 * at] else 2 * at + 1
        return at - self.leaves

    def _mark(self, room: int, has: bool) -> None:
        at = room + self.leaves
        self.some[at] = has
        while at > 1:
            at //= 2
            now = self.some[2 * at] or self.some[2 * at + 1]
            if self.some[at] == now:
                break
            self.some[at] = now

    def place(self, length: int) -> tuple[int, int]:
        """(window number, offset in it) for a piece of 1 to ``window`` ids."""
        room = self._tightest(length)
        if room < 0:
            number, room, self.n = self.n, self.window, self.n + 1
        else:
            number = self.open[room].pop()
            if not self.open[room]:
                self._mark(room, False)
        if left := room - length:
            held = self.open.setdefault(left, [])
            held.append(number)
            if len(held) == 1:
                self._mark(left, True)
        return number, self.window - room


def pieces(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, tokenizer: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, and ``ids`` (little-endian
    unsigned 32-bit) if wanted. ``tokenizer``: path of a tokenizer file on the executors."""
    kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def cut(batches: Iterator) -> Iterator:
        encoder, end = ChunkEncoder(tokenizer or public_tokenizer(TOKENIZER)), end_id.to_bytes(4, "little")
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                rows = []
                for doc, ids in zip(part["doc_id"].to_pylist(), encoder.encode(part["text"].to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        own = ids[4 * start:4 * min(n, start + window)]
                        row = (doc, start, len(own) // 4, zlib.crc32(own), n)
                        rows.append(row + (own,) if with_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select("doc_id", whole(F.col("text")).alias("text")).mapInArrow(cut, PIECE + (", ids binary" if with_ids else ""))


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, tokenizer: str | None = None,
         rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """The pieces with their sequence_id and offset. Offsets of a sequence run gapless from 0."""
    cut = stored(pieces(docs, window, end_id, tokenizer))
    groups = max(1, -(-cut.count() // rows_per_group))
    dealt = (cut.withColumn("g", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
             .repartition("g").sortWithinPartitions("g", F.desc("length"), "doc_id", "start", "ids_crc32"))

    def fit(batches: Iterator) -> Iterator:
        group, best = None, None
        for batch in batches:
            placed = []
            for g, length in zip(batch["g"].to_pylist(), batch["length"].to_pylist()):
                if g != group:
                    group, best = g, BestFit(window)
                number, at = best.place(length)
                placed.append(((g << 32) + number, at))
            sequence, offset = zip(*placed) if placed else ((), ())
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                                             batch.schema.names[:-1] + ["sequence_id", "offset"])

    return dealt.mapInArrow(fit, PIECE + ", sequence_id bigint, offset bigint")


def sequences(docs: DataFrame, packed: DataFrame, window: int = WINDOW, end_id: int = END_ID,
              tokenizer: str | None = None) -> DataFrame:
    """sequence_id, ids (binary, unpadded): the packed sequences themselves. The documents are
    tokenized again and only the ids are shuffled, once. Fully equal rows of ``docs`` are matched
    by doc_id, start and checksum, and each takes one of the equal places."""
    cut = pieces(docs, window, end_id, tokenizer, with_ids=True)
    # equal pieces have equal ids: one copy serves all of their places
    key = ["start", "length", "ids_crc32", "doc_tokens"]
    cut = cut.groupBy("doc_id", *key).agg(F.first("ids").alias("ids"))
    cut = cut.select(F.col("doc_id").alias("__doc"), *[F.col(k).alias(f"__{k}") for k in key], "ids")
    same = [F.col("doc_id").eqNullSafe(F.col("__doc")), *[F.col(k) == F.col(f"__{k}") for k in key]]
    both = packed.join(cut, same)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return both.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
