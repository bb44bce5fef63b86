"""Scoring texts by online logistic context mixing.

A token (a lower-cased word, or the end of the text) is written as bits. First comes the path to its
symbol in a Huffman tree: the ``TOP`` most frequent tokens are symbols of their own, every other word
belongs to one of ``CLASSES`` symbols by the hash of its first two bytes. Such a word's own bits
follow (:mod:`obsmart.llm.word_bits`): its path among the dictionary's words of the class, or the way
out of it and then its letters. For every bit four predictors are mixed: training counts of the tree
node alone and in two contexts (of the symbol: the symbol before it, the two before it; of a word: the
symbol before it, the word before it; of a letter: bytes before it in the word; all in hashed tables),
and an adaptive count of the text itself. The mixing weights are gated (a set for each kind of what
came before or of the bit, and the depth in the tree), start equal, and are learnt online along each
text; the mix is refined by a second adaptive stage, and both are averaged (:class:`Mixer`). Since
every bit's two chances add to one, the result is a probability of the token sequence, word by word.

The counts cover all training documents: word counts, counts of three symbols in a row, whose bits
fill the symbols' context tables, and counts of the words' bits; all are made per task and added in
Spark. Texts are read twice: for the word counts, and to write them down as symbols, dictionary
places, letters and word hashes (:func:`encode`), from which the bit counts and the scores come. The
tables of bit counts have a fixed number of slots (``SLOTS`` and ``WORD_SLOTS`` for each order) and
the dictionary ``KNOWN`` words at most, so what travels to the tasks is bounded, and contexts that
share a slot are simply mixed. Words outside the dictionary are spelled bit by bit, so none is left
out; for the base score they are joined to their counts.

Many texts are scored at a time, so numpy does the work (:mod:`obsmart.llm.mixer`). A text starts from fresh
weights, and again after every ``SEGMENT`` tokens or ``EVENTS`` bits of its words (what stands before
is still the context), so scores do not depend on the partitioning and a very long text is many lanes, not many steps.

Defined results
    null or empty text: one token, the end, and no bits per byte (null). Without training documents every count is 0. A null
    doc_id counts as a training document. Repeated rows are each returned, with equal scores. An
    empty table gives an empty result. Further columns are not carried. Texts are scored whole.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.llm import mixer
from obsmart.llm.storage import stored
from obsmart.llm.text import whole
from obsmart.llm.word_bits import WORD_SLOTS, WordModel

FOLDS, HELD_OUT = 7, 2
TOP = 31                  # symbols of their own, besides the end of text
CLASSES = 32
SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS    # per order
FLUSH = 300_000           # words counted in a task before they are sent on
SEGMENT = 1024            # tokens over which weights and adaptive counts are learnt
LANES = 2048              # texts whose symbols are scored at a time
WORD_TEXTS = 1024         # texts whose words' bits are scored at a time
KNOWN = 1 << 18           # most frequent words (the dictionary), whose counts travel with the tasks
FEW = 8192                # least size of the dictionary, if there are as many words
BLOCK = 4096              # slots of a table that are added up at once
END = b""                 # the end of a text as a token (no word is empty)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.coalesce(F.crc32(doc_id.cast("string")), F.lit(0)), F.lit(FOLDS)) == HELD_OUT


def _words(text: bytes) -> list[bytes]:
    """Words between white space, A-Z lower-cased."""
    return text.lower().split()


def _class_of(word: bytes) -> int:
    return xxhash.xxh32_intdigest(word[:2]) % CLASSES


def _symbol(symbols: dict, n_top: int, word: bytes) -> int:
    s = symbols.get(word)
    return n_top + _class_of(word) if s is None else s


def _hash(word: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def _hashes(words):
    """:func:`_hash` of many words."""
    import numpy as np

    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64).view(np.int64)


def word_counts(train: DataFrame) -> DataFrame:
    """h (hash of the token), word (its first 64 bytes), c: every token of the training texts with its count."""
    def count(batches: Iterator) -> Iterator:
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([
                pa.array(_hashes(seen)), pa.array(seen.values(), pa.int64()),
                pa.array([w[:64] for w in seen], pa.binary())], ["h", "c", "word"])

        for batch in batches:
            for text in batch["text"]:
                seen.update(_words(text.as_py()))
                seen[END] += 1
                if len(seen) >= FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    return (train.select(F.col("text").cast("binary")).mapInArrow(count, "h bigint, c bigint, word binary")
            .groupBy("h", "word").agg(F.sum("c").alias("c")))


def huffman(counts: list[float]) -> list[list[int]]:
    """Per symbol the bits from the root; node numbers follow from the bits."""
    heap = [(c, i, [i]) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    codes: list[list[int]] = [[] for _ in counts]
    while len(heap) > 1:
        (a, i, left), (b, j, right) = heapq.heappop(heap), heapq.heappop(heap)
        for s in left:
            codes[s].insert(0, 0)
        for s in right:
            codes[s].insert(0, 1)
        heapq.heappush(heap, (a + b, min(i, j), left + right))
    return codes


class BitModel:
    """The tree, the context tables and the mixing; plain arrays, built on the driver from bounded
    tables and sent with the tasks."""

    def __init__(self, top: list[bytes], counts: list[float]):
        import numpy as np

        self.symbols = {w: i for i, w in enumerate(top)}
        codes = huffman(counts)
        number, self.depth = {(): 0}, max(map(len, codes))
        self.node = np.full((len(codes), self.depth), -1, np.int64)
        self.bit = np.zeros((len(codes), self.depth), np.float32)
        for s, code in enumerate(codes):
            for d, b in enumerate(code):
                self.node[s, d] = number.setdefault(tuple(code[:d]), len(number))
                self.bit[s, d] = b
        self.length = np.array([len(c) for c in codes])
        self.n_nodes, self.n_symbols, self.n_top = len(number), len(codes), len(top)
        self.tables: list | None = None       # per order: stretched chance of a 1
        self.words: WordModel | None = None   # bits of the words within the classes

    def symbol(self, word: bytes) -> int:
        return _symbol(self.symbols, self.n_top, word)

    def slots(self, sym, last, last2):
        """Table places (order, ...) for the first node of each token; a node is added to them."""
        np = self._np()
        one = (last.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        two = (one ^ ((last2.astype(np.uint64) + np.uint64(77)) * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0xD6E8FEB86659FD93)
        return np.stack([np.zeros(len(sym), np.uint64), one, two])

    def places(self, context, node):
        """Slot of (order, context, node); node -1 is any slot, to be ignored."""
        np = self._np()
        h = (context + (node + 1).astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(29)
        return ((h * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    @staticmethod
    def _np():
        import numpy as np

        return np

    def histories(self, symbols: list):
        """The symbols of several texts in a row, each with the two before it (n_symbols: none)."""
        np = self._np()
        sym = np.concatenate(symbols)
        last, last2 = np.empty_like(sym), np.empty_like(sym)
        last[1:], last2[2:] = sym[:-1], sym[:-2]
        starts = np.cumsum([0] + [len(s) for s in symbols[:-1]])
        last[starts] = last2[starts] = self.n_symbols
        second = starts + 1
        second = second[second < len(sym)]
        last2[np.setdiff1d(second, starts)] = self.n_symbols
        return sym, last, last2

    def tally(self, symbols: list, seen) -> None:
        """Add the texts' (symbol before the last, last symbol, symbol) triples to ``seen``."""
        np = self._np()
        sym, last, last2 = self.histories(symbols)
        side = self.n_symbols + 1
        seen += np.bincount((last2 * side + last) * side + sym, minlength=side ** 3)

    def count(self, symbols: list, ones, zeros) -> None:
        """Add the bits of the texts to the tables (order, slot)."""
        seen = self._np().zeros((self.n_symbols + 1) ** 3, "int64")
        self.tally(symbols, seen)
        self.count_triples(seen, ones, zeros)

    def count_triples(self, seen, ones, zeros) -> None:
        """Add the bits of the counted triples to the tables (order, slot)."""
        np = self._np()
        side = self.n_symbols + 1
        triple = np.nonzero(seen)[0]
        sym, last, last2, times = triple % side, triple // side % side, triple // side ** 2, seen[triple]
        context = self.slots(sym, last, last2)
        for d in range(self.depth):
            on = np.nonzero(self.length[sym] > d)[0]
            node, one = self.node[sym[on], d], times[on] * self.bit[sym[on], d].astype(np.int64)
            for order in range(3):
                at = self.places(context[order, on], node)
                np.add.at(ones[order], at, one)
                np.add.at(zeros[order], at, times[on] - one)

    def learnt(self, ones, zeros) -> None:
        np = self._np()
        p = (ones + 0.4) / (ones + zeros + 0.8)
        self.tables = [t for t in np.clip(np.log(p / (1 - p)), -8, 8).astype(np.float32)]
        self.direct = self.looked_up()

    def looked_up(self) -> list:
        """The tables' entries by (symbol before the last, last symbol, node), without hashing."""
        np = self._np()
        side, node = self.n_symbols + 1, np.arange(self.n_nodes)
        last2, last = np.divmod(np.arange(side ** 2), side)
        context = self.slots(last, last, last2)
        contexts = [context[0, :1], context[1, :side], context[2]]
        return [t[self.places(c[:, None], node[None, :])].reshape(-1) for t, c in zip(self.tables, contexts)]

    def log10(self, symbols: list):
        """log10 probability of each text's symbols; a text has a lane for every ``SEGMENT`` tokens."""
        np = self._np()
        sym, last, last2 = self.histories(symbols)
        sizes = np.array([len(s) for s in symbols])
        lanes = -(-sizes // SEGMENT)
        text = np.repeat(np.arange(len(sizes)), lanes)
        long = np.minimum(SEGMENT, sizes[text] - SEGMENT * (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)))
        ends = np.append(0, np.cumsum(long))            # tokens before each lane
        length = self.length[sym]
        side = self.n_symbols + 1
        kind = np.where(last < self.n_top, 0, np.where(last < self.n_symbols, 1, 2))

        def bits_of(a: int, b: int) -> tuple:
            own = slice(ends[a], ends[b])
            times = length[own]
            d = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            at = np.repeat(sym[own] * self.depth, times)
            at += d
            node, bit = self.node.reshape(-1).take(at), self.bit.reshape(-1).take(at)
            x = np.empty((3, len(at)), np.float32)
            for table, context, row in zip(self.direct, (last[own] * 0, last[own], last2[own] * side + last[own]), x):
                at = np.repeat(context * self.n_nodes, times)
                at += node
                table.take(at, 0, row, "clip")
            gate = np.repeat(kind[own] * self.depth, times)
            gate += d
            return x, bit.astype(np.int64), gate, node

        bits = np.add.reduceat(length, ends[:-1]) if len(long) else long
        return np.bincount(text, mixer.log10(bits, bits_of), len(sizes))


class Places(dict):
    """Places of the dictionary's words; -1 for any other word."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Classes(dict):
    """Classes by a word's first two bytes."""

    def __missing__(self, two: bytes) -> int:
        self[two] = _class_of(two)
        return self[two]


ENCODED = """row bigint, doc_id bigint, bytes bigint, tokens bigint, known bigint, base double,
             symbols binary, places binary, spelled binary, words array<bigint>, counts array<bigint>"""


def encode(docs: DataFrame, model: BitModel, facts: dict) -> DataFrame:
    """Every text read and parted once, stored: its symbols (a byte each, the end included), the
    tokens' places in the dictionary (four bytes each, -1: outside) and the words outside, each with a
    space; for the dictionary's words the number of known tokens and their base score; the hashes of
    the other words with their counts."""
    import numpy as np

    words, seen = list(facts["counts"]), np.array(list(facts["counts"].values()))
    symbol = np.array([model.symbol(w) for w in words], np.uint8)
    n_top = model.n_top

    def read(batches: Iterator) -> Iterator:
        place, classes = Places(zip(words, range(len(words)))), Classes()
        log_of = np.log10(seen + 1.0)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [_words(t.as_py()) for t in part["text"]]
                for t in texts:
                    t.append(END)
                m, sizes = len(texts), np.array([len(t) for t in texts])
                tokens = list(chain.from_iterable(texts))
                places = np.fromiter(map(place.__getitem__, tokens), np.int32, len(tokens))
                doc, symbols = np.repeat(np.arange(m), sizes), symbol[places]
                inside, outside = places >= 0, np.nonzero(places < 0)[0]
                spelled = [tokens[i] for i in outside.tolist()]
                symbols[outside] = [n_top + classes[w[:2]] for w in spelled]       # a symbol is in the dictionary
                letters = np.bincount(doc[outside], [len(w) + 1 for w in spelled], m)
                # each text's distinct words outside the dictionary with their counts
                hashes, number = np.unique(_hashes(spelled), return_inverse=True)
                pairs, o_count = np.unique(doc[outside] * (len(hashes) + 1) + number, return_counts=True)
                o_doc, number = np.divmod(pairs, len(hashes) + 1)
                ends, letter_ends, list_ends = (np.append(0, np.cumsum(n)).astype(np.int32) for n in (sizes, letters, np.bincount(o_doc, minlength=m)))
                doc, f = doc[inside], places[inside]
                yield pa.RecordBatch.from_arrays([
                    part["row"], part["doc_id"], part["bytes"], pa.array(sizes), pa.array(np.bincount(doc, seen[f] > 0, m).astype(np.int64)),
                    pa.array(np.bincount(doc, log_of[f], m)),
                    pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(ends), pa.py_buffer(symbols)]),
                    pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(4 * ends), pa.py_buffer(places)]),
                    pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(letter_ends), pa.py_buffer(b" ".join([*spelled, b""]))]),
                    pa.ListArray.from_arrays(list_ends, pa.array(hashes[number])), pa.ListArray.from_arrays(list_ends, pa.array(o_count))],
                    ["row", "doc_id", "bytes", "tokens", "known", "base", "symbols", "places", "spelled", "words", "counts"])

    text = whole(F.col("text"))
    return stored(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("bytes"),
                              text.cast("binary").alias("text")).mapInArrow(read, ENCODED))


def _unpacked(column) -> list:
    import numpy as np

    return [np.frombuffer(x.as_buffer(), np.uint8).astype(np.int64) for x in column]


def _items(part, model: BitModel) -> tuple:
    """Items of the words (:class:`WordModel`) of some encoded texts."""
    import numpy as np

    symbols = _unpacked(part["symbols"])
    sym, last, _ = model.histories(symbols)
    starts = np.cumsum([0] + [len(s) for s in symbols[:-1]])
    places = np.frombuffer(b"".join(part["places"].to_pylist()), np.int32).astype(np.int64)
    spelled = np.frombuffer(b"".join(part["spelled"].to_pylist()), np.uint8)
    return model.words.items(sym, last, starts, places, spelled)


def learn_words(encoded: DataFrame, model: BitModel) -> None:
    """Fill the tables of the words' bits from all encoded texts: counted per task, added in Spark a
    block of slots at a time."""
    import numpy as np

    words = model.words

    def count(batches: Iterator) -> Iterator:
        seen = np.zeros((3, 2 * WORD_SLOTS), np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                words.count(_items(batch.slice(at, 512), model), seen)
        cells = seen.reshape(-1, BLOCK)
        block = np.nonzero(cells.any(axis=1))[0]
        for at in range(0, len(block), 256):
            part = block[at:at + 256]
            # the low bytes of all cells first: the others are mostly zero
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([cells[b].view(np.uint8).reshape(-1, 4).T.tobytes() for b in part])], ["block", "cells"])

    def added(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.int64)
        for cells in table["cells"]:
            total += np.frombuffer(cells.as_py(), np.uint8).reshape(4, -1).T.copy().view(np.int32)[:, 0]
        return pa.table({"block": table["block"][:1], "cells": pa.array([total.tobytes()])})

    counted = (encoded.select("symbols", "places", "spelled").mapInArrow(count, "block bigint, cells binary")
               .groupBy("block").applyInArrow(added, "block bigint, cells binary"))
    seen = np.zeros((3 * 2 * WORD_SLOTS // BLOCK, BLOCK), np.int64)
    for batch in counted.toArrow().to_batches():
        for block, cells in zip(batch["block"].to_pylist(), batch["cells"]):
            seen[block] = np.frombuffer(cells.as_py(), np.int64)
    words.learnt(seen.reshape(3, -1))


def learn_bits(encoded: DataFrame, model: BitModel) -> None:
    """Fill the model's tables from all encoded texts: triples of symbols are counted per task and
    added in Spark (at most 65 ** 3 of them), their bits then go to the tables; then the words' bits."""
    import numpy as np

    side = model.n_symbols + 1

    def count(batches: Iterator) -> Iterator:
        seen = np.zeros(side ** 3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                model.tally(_unpacked(batch["symbols"].slice(at, 256)), seen)
        triple = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(triple), pa.array(seen[triple])], ["triple", "n"])

    counted = encoded.select("symbols").mapInArrow(count, "triple bigint, n bigint").groupBy("triple").agg(F.sum("n").alias("n"))
    seen = np.zeros(side ** 3, np.int64)
    for batch in counted.toArrow().to_batches():
        seen[batch["triple"].to_numpy()] = batch["n"].to_numpy()
    ones, zeros = np.zeros((3, SLOTS), np.int64), np.zeros((3, SLOTS), np.int64)
    model.count_triples(seen, ones, zeros)
    model.learnt(ones, zeros)
    learn_words(encoded, model)


def dictionary(vocabulary: DataFrame) -> dict[bytes, int]:
    """The most frequent words with their counts, by count, then word: all from some count on, as far
    as ``KNOWN`` words go; where that leaves few, also words of the next count."""
    # words that were cut for the table (64 bytes) are no candidates
    words = vocabulary.where(F.length("word") < 64).select("word", "c")
    least, size = None, 0
    for c, n in words.groupBy("c").count().orderBy(F.desc("c")).toLocalIterator():
        if size + n > KNOWN:
            break
        least, size = c, size + n
    found = words.where(F.col("c") >= least).toArrow().to_pylist() if least is not None else []
    if size < FEW:
        found += (words if least is None else words.where(F.col("c") < least)).orderBy(F.desc("c"), "word").limit(FEW - size).toArrow().to_pylist()
    return {w["word"]: w["c"] for w in sorted(found, key=lambda w: (-w["c"], w["word"]))}


def vocabulary_of(train: DataFrame):
    """(model without its tables, vocabulary: h, c; facts). The model is bounded: TOP words."""
    vocabulary = stored(word_counts(train))
    n, v = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    counts = dictionary(vocabulary)
    ends = vocabulary.where(F.length("word") == 0).agg(F.sum("c")).first()[0] or 0
    counts[END] = ends
    words = [END] + [w for w in counts if w != END][:TOP]
    tail = vocabulary.where(~F.col("h").isin([_hash(w) for w in words]))
    classes: Counter = Counter()
    for r in tail.groupBy(F.substring("word", 1, 2).alias("two")).agg(F.sum("c").alias("n")).collect():    # <= 65,793 rows
        classes[_class_of(bytes(r["two"]))] += r["n"]
    sizes = [counts[w] + 1.0 for w in words] + [classes.get(k, 0) + 1.0 for k in range(CLASSES)]
    model = BitModel(words, sizes)
    known = list(counts)
    of = [-1 if w in model.symbols else _class_of(w) for w in known]
    rest = [classes.get(k, 0) for k in range(CLASSES)]
    for w, k in zip(known, of):
        if k >= 0:
            rest[k] -= counts[w]
    model.words = WordModel(known, list(counts.values()), of, rest, model.n_top, model.n_symbols)
    return model, vocabulary.select("h", "c"), {"n": int(n), "v": int(v), "counts": counts}


def train_model(train: DataFrame):
    """(model, vocabulary, facts), learnt from all texts of ``train``."""
    model, vocabulary, facts = vocabulary_of(train)
    learn_bits(encode(train.withColumn("doc_id", F.lit(None).cast("long")), model, facts), model)
    return model, vocabulary, facts


def score_encoded(encoded: DataFrame, model: BitModel, vocabulary: DataFrame, facts: dict) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    import math

    whole_mass = math.log10(facts["n"] + facts["v"] + 1)

    def score(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            for at in range(0, batch.num_rows, LANES):
                part = batch.slice(at, LANES)
                bits = model.log10(_unpacked(part["symbols"]))
                for first in range(0, len(part), WORD_TEXTS):
                    bits[first:first + WORD_TEXTS] += model.words.log10(_items(part.slice(first, WORD_TEXTS), model))
                yield pa.RecordBatch.from_arrays([part["row"], pa.array(np.asarray(bits, float))], ["row", "bits"])

    bits = encoded.select("row", "symbols", "places", "spelled").mapInArrow(score, "row bigint, bits double")
    heads = encoded.select("row", "doc_id", "bytes", "tokens", "known", "base", F.lit(None).cast("double").alias("bits"))
    # one row per text and distinct word outside the dictionary, joined to the word's count
    parts = encoded.select("row", F.inline(F.arrays_zip("words", "counts"))).toDF("row", "__h", "__n")
    c = F.coalesce("c", F.lit(0))
    others = parts.join(vocabulary, F.col("__h") == F.col("h"), "left").select(
        "row", F.when(c > 0, F.col("__n")).otherwise(0).alias("known"), (F.col("__n") * F.log10(c + 1)).alias("base"))
    rows = heads.unionByName(bits, allowMissingColumns=True).unionByName(others, allowMissingColumns=True)
    out = rows.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("tokens").alias("n_tokens"), F.sum("known").alias("n_known"),
        (F.sum("base") - whole_mass * F.max("tokens")).alias("base_score"),
        F.max("bits").alias("score"), F.max("bytes").alias("__bytes"))
    per_byte = F.when(F.col("__bytes") > 0, -F.col("score") * F.log2(F.lit(10.0)) / F.col("__bytes"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                      F.lit(facts["n"]).cast("long").alias("train_tokens"), "base_score", "score", per_byte.alias("bits_per_byte"))


def score_texts(docs: DataFrame, model: BitModel, vocabulary: DataFrame, facts: dict) -> DataFrame:
    """The texts of ``docs`` (doc_id, text) scored by a trained model, as :func:`score_encoded` says."""
    return score_encoded(encode(docs, model, facts), model, vocabulary, facts)


def bits_per_byte(scored: DataFrame, docs: DataFrame) -> DataFrame:
    """total_bits, total_bytes, bits_per_byte over all texts of ``scored`` (unique doc_id)."""
    sizes = docs.select("doc_id", F.octet_length(whole(F.col("text"))).alias("bytes"))
    both = scored.select("doc_id", "score").join(sizes, "doc_id")
    return both.agg((-F.sum("score") * F.log2(F.lit(10.0))).alias("total_bits"), F.sum("bytes").alias("total_bytes")).select(
        "total_bits", "total_bytes", (F.col("total_bits") / F.col("total_bytes")).alias("bits_per_byte"))


def score_documents(docs: DataFrame) -> DataFrame:
    """Every document scored by the model of those that are not held out."""
    train = docs.where(~held_out(F.col("doc_id"))).select(whole(F.col("text")).alias("text"))
    model, vocabulary, facts = vocabulary_of(train)
    encoded = encode(docs.select("doc_id", "text"), model, facts)
    learn_bits(encoded.where(~held_out(F.col("doc_id"))), model)
    return score_encoded(encoded, model, vocabulary, facts)
