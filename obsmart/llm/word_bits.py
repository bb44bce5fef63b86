"""Bits of the words that are no symbols of their own, mixed like the bits of the symbols.

After a word's class comes its path in the class's Huffman tree over the words of the dictionary
(the frequent words, whose counts travel with the tasks) and one way out. A word that takes the way
out is spelled: its bytes and a space, each by its path in a Huffman tree of bytes. So every word,
known or not, has bits of its own, and the chances of all words of a class add to one at most.

A path and a letter are both an *item*: a code with three contexts. Of a path they are its class
alone, with the symbol before it, and with the word before it; of a letter the two bytes before it,
the four before it, and all before it in the word. Counts of every bit are kept in hashed tables
(``WORD_SLOTS`` for each order).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from obsmart.llm import mixer

WORD_BITS = 20
WORD_SLOTS = 1 << WORD_BITS   # per order
OWN = 2048                # adaptive counts of a text
DEEP = 16                 # depths in a tree with weights of their own
KINDS = 3                 # a path, a word's first letter, another letter
EVENTS = 4096             # bits over which weights and adaptive counts are learnt
PIECE = 1 << 20           # items of which the lanes work at once
RUN = 1 << 12             # items whose bits are counted at once
A, B, C = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD


def code_lengths(weights: list) -> list[int]:
    """Depth of every leaf of a Huffman tree."""
    n = len(weights)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    above = [0] * (2 * n - 1)
    for node in range(n, 2 * n - 1):
        a, i = heapq.heappop(heap)
        b, j = heap[0]
        above[i] = above[j] = node
        heapq.heapreplace(heap, (a + b, node))
    depth = [0] * (2 * n - 1)
    for node in range(2 * n - 3, -1, -1):
        depth[node] = depth[above[node]] + 1
    return depth[:n]


def canonical(weights: list) -> tuple[list[int], list[int]]:
    """(lengths, codes) of a Huffman code whose codes follow from the lengths."""
    lengths = code_lengths(weights)
    codes, code, before = [0] * len(weights), 0, 0
    for i in sorted(range(len(weights)), key=lambda i: (lengths[i], i)):
        code <<= lengths[i] - before
        codes[i], before = code, lengths[i]
        code += 1
    return lengths, codes


def scrambled(h, salt: int):
    """A 64-bit hash of integers, element by element."""
    import numpy as np

    h = (np.asarray(h).astype(np.uint64) + np.uint64(salt)) * np.uint64(A)
    h ^= h >> np.uint64(29)
    h *= np.uint64(B)
    h ^= h >> np.uint64(32)
    return h


class WordModel:
    """The trees, the bits' tables and the mixing of words; plain arrays, sent with the tasks."""

    def __init__(self, words: list[bytes], counts: list[int], classes: list[int], rest: list[int], n_top: int, n_symbols: int):
        """``classes``: of each dictionary word (-1: it is a symbol); ``rest``: count of each class's other words."""
        import numpy as np

        n = len(words)
        self.n, self.n_top, self.n_symbols, self.n_classes = n, n_top, n_symbols, len(rest)
        classes, counts = np.array(classes, np.int64), np.array(counts, np.int64)
        # leaves: the dictionary words, then each class's way out
        self.length, self.code = np.zeros(n + len(rest), np.int64), np.zeros(n + len(rest), np.uint64)
        self.group = np.append(np.maximum(classes, 0), np.arange(len(rest)))
        for k, others in enumerate(rest):
            leaves = np.append(np.nonzero(classes == k)[0], n + k)
            lengths, codes = canonical([c + 1 for c in counts[leaves[:-1]].tolist()] + [others + 1])
            self.length[leaves], self.code[leaves] = lengths, np.array(codes, np.uint64)
        # contexts of a path: of its class, of the symbol before it, of the word before it (or none)
        self.of_group, self.of_last = scrambled(self.group, 1 << 40), scrambled(np.arange(n_symbols + 1), 2 << 40)
        self.of_before = scrambled(np.arange(n + len(rest) + 1), 3 << 40)
        spelled = np.frombuffer(b" ".join([*words, b""]), np.uint8)
        often = np.repeat(counts, [len(w) + 1 for w in words])
        lengths, codes = canonical([c + 1 for c in np.bincount(spelled, often, 256).astype(np.int64).tolist()])
        self.letter_length, self.letter_code = np.array(lengths), np.array(codes, np.uint64)
        self.tables: list | None = None       # per order: stretched chance of a 1

    def letters(self, spelled, classes) -> tuple:
        """Items of the spelled words: bytes that end with a space each; ``classes``: of the words."""
        import numpy as np

        m = len(spelled)
        ends = np.nonzero(spelled == 32)[0]
        sizes = np.diff(ends, prepend=-1)
        place = np.arange(m) - np.repeat(ends + 1 - sizes, sizes)
        back = []
        for k in range(1, 5):
            b = np.zeros(m, np.int64)
            b[k:] = spelled[:max(m - k, 0)]
            b[place < k] = 256
            back.append(b << (9 * k - 9))
        group = np.where(place == 0, np.repeat(classes, sizes), self.n_classes)
        # all before: a polynomial of the word's bytes, the same wherever the word stands
        power = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, np.uint64(A)), dtype=np.uint64)
        sums = np.append(np.uint64(0), np.cumsum((spelled.astype(np.uint64) + np.uint64(1)) * power[place], dtype=np.uint64))
        prefix = sums[:-1] - np.repeat(sums[ends + 1 - sizes], sizes)
        near = (group << 36) | back[0] | back[1]
        contexts = [scrambled(near, 4 << 50), scrambled(near | back[2] | back[3], 5 << 50), scrambled(prefix ^ self.of_last[0] * group.astype(np.uint64), 6 << 50)]
        return self.letter_length[spelled], self.letter_code[spelled], contexts, np.where(place == 0, 1, 2), sizes

    def items(self, sym, last, starts, ids, spelled) -> tuple:
        """(length, code, contexts, kind) of all items of some texts in a row, and each text's first
        item. ``sym``, ``last``: of the tokens; ``starts``: first token of each text; ``ids``: places
        in the dictionary (-1: spelled)."""
        import numpy as np

        out = ids < 0
        leaf = np.where(out, self.n + sym - self.n_top, ids)
        before = np.empty_like(leaf)
        before[1:] = leaf[:-1]
        before[starts] = self.n + self.n_classes
        group = self.group[leaf]
        length, code, contexts, kind, sizes = self.letters(spelled, group[out])
        spelt = np.zeros(len(sym), np.int64)
        spelt[out] = sizes
        at = np.arange(len(sym)) + np.cumsum(spelt) - spelt           # items before the token
        letter = np.ones(len(sym) + len(spelled), bool)
        letter[at] = False
        letter = np.nonzero(letter)[0]
        own = self.of_group.take(leaf)
        own = [own, own + self.of_last.take(last), own + self.of_before.take(before)]

        def merged(path, letters, dtype):
            both = np.empty(len(at) + len(letter), dtype)
            both[at], both[letter] = path, letters
            return both

        return (merged(self.length[leaf], length, np.int64), merged(self.code[leaf], code, np.uint64),
                [merged(a, b, np.uint64) for a, b in zip(own, contexts)], merged(0, kind, np.int64), at[starts])

    def pieces(self, items: tuple) -> Iterator[tuple]:
        """(first, last item, the cuts between texts there) of runs of at most ``PIECE`` items; a longer text is cut."""
        import numpy as np

        length, starts = items[0], items[4]
        cuts = np.unique(np.concatenate([np.append(starts, len(length)), *(
            np.arange(a, b, PIECE) for a, b in zip(starts, [*starts[1:], len(length)]) if b - a > PIECE)]))
        first = 0
        while first < len(cuts) - 1:
            last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + PIECE, "right")) - 1)
            yield int(cuts[first]), int(cuts[last]), cuts[first:last + 1]
            first = last

    @staticmethod
    def bits(items: tuple, own: slice, times, depth) -> tuple:
        """(depth, bit, slots by order) of some bits of the items ``own``: ``times`` of each."""
        import numpy as np

        length, code, contexts = items[:3]
        item = np.repeat(np.arange(len(times)), times)
        # the code behind a 1: what lies above a bit is the path to it
        path = (code[own] | np.uint64(1) << length[own].astype(np.uint64)).take(item, mode="clip")
        path >>= ((length[own] - 1).take(item, mode="clip") - depth).view(np.uint64)
        bit = path & np.uint64(1)
        path >>= np.uint64(1)
        path *= np.uint64(A)
        slots = []
        for c in contexts:
            h = c[own].take(item, mode="clip")
            h ^= path
            h *= np.uint64(C)
            h >>= np.uint64(64 - WORD_BITS)
            slots.append(h.view(np.int64))
        return depth, bit.view(np.int64), slots

    def count(self, items: tuple, seen) -> None:
        """Add the items' bits to ``seen`` (order, twice the slot and the bit)."""
        import numpy as np

        one = seen.dtype.type(1)
        for lo in range(0, len(items[0]), RUN):
            length = items[0][lo:lo + RUN]
            first = np.cumsum(length) - length
            depth = np.arange(length.sum()) - np.repeat(first, length)
            _, bit, slots = self.bits(items, slice(lo, lo + RUN), length, depth)
            for order, slot in enumerate(slots):
                slot *= 2
                slot += bit
                np.add.at(seen[order], slot, one)

    def learnt(self, seen) -> None:
        import numpy as np

        zeros, ones = seen[:, ::2], seen[:, 1::2]
        p = (ones + 0.4) / (ones + zeros + 0.8)
        self.tables = [t for t in np.clip(np.log(p / (1 - p)), -8, 8).astype(np.float32)]

    def log10(self, items: tuple):
        """log10 probability of each text's items."""
        import numpy as np

        out = np.zeros(len(items[4]))
        for lo, hi, cuts in self.pieces(items):
            got = self._mixed(items, lo, hi, cuts)
            np.add.at(out, np.searchsorted(items[4], cuts[:-1], "right") - 1, got)
        return out

    def _mixed(self, items: tuple, lo: int, hi: int, cuts):
        """log10 probability of the items between every two cuts; each has a lane for every ``EVENTS`` bits."""
        import numpy as np

        items = (items[0][lo:hi], items[1][lo:hi], [c[lo:hi] for c in items[2]], items[3][lo:hi])
        last = np.cumsum(items[0])
        first = last - items[0]
        sizes = np.diff(np.append(0, last)[cuts - lo])                 # bits between the cuts
        lanes = -(-sizes // EVENTS)
        part = np.repeat(np.arange(len(sizes)), lanes)
        long = np.minimum(EVENTS, sizes[part] - EVENTS * (np.arange(len(part)) - np.repeat(np.cumsum(lanes) - lanes, lanes)))
        ends = np.append(0, np.cumsum(long))                           # bits before each lane

        def bits_of(a: int, b: int) -> tuple:
            a, b = ends[a], ends[b]
            own = slice(int(np.searchsorted(last, a, "right")), int(np.searchsorted(first, b)))
            times = np.minimum(last[own], b) - np.maximum(first[own], a)      # a lane may end within an item
            depth, bit, slots = self.bits(items, own, times, np.arange(a, b) - np.repeat(first[own], times))
            x = np.empty((3, len(bit)), np.float32)
            for table, slot, row in zip(self.tables, slots, x):
                table.take(slot, 0, row, "clip")
            gate = np.repeat(items[3][own] * DEEP, times)
            gate += np.minimum(depth, DEEP - 1)
            return x, bit, gate, slots[0] & (OWN - 1)

        return np.bincount(part, mixer.log10(long, bits_of), len(sizes))
