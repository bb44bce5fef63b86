"""Words outside the symbols have bits of their own, in contexts of real words and letters."""

import math
import random
import zlib
from collections import Counter

import numpy as np

from obsmart.llm import word_bits
from obsmart.llm.mixing_lm import _class_of, score_documents
from obsmart.llm.word_bits import DEEP, OWN, WORD_SLOTS, WordModel, canonical

HELD = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 7 == 2]
TRAIN = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 7 != 2]


def filler(rng, n):
    """Words that take the symbols of their own."""
    return [f"w{rng.randrange(31)}" for _ in range(n)]


def scores(spark, rows):
    return {r.doc_id: r.score for r in score_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}


def test_unknown_words_of_a_class_are_told_apart(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(filler(rng, 60) + ["zebra", "zeal"])) for i in TRAIN[:60]]
    unknown = ["zebrb", "zeqqq", "zeqqqqqqqqqqqqq"]         # one class, none of them known
    got = scores(spark, rows + list(zip(HELD, unknown)))
    assert got[HELD[0]] > got[HELD[1]] > got[HELD[2]]       # like a known word; letters never seen; more of them


def test_the_word_before_is_a_context(spark):
    """Four words of one class, equally often; each comes after a word of its own only."""
    rng = random.Random(5)
    pairs = [("zea", "yeb"), ("zec", "yed"), ("zee", "yef"), ("zeg", "yeh")]
    assert len({_class_of(b.encode()) for _, b in pairs}) == 1
    rows = [(i, " ".join(w for pair in pairs for w in (*filler(rng, 12), *pair))) for i in TRAIN[:100]]
    got = scores(spark, rows + [(HELD[0], "zea yeb"), (HELD[1], "zea yed"), (HELD[2], "zec yed"), (HELD[3], "zec yeb")])
    assert got[HELD[0]] > got[HELD[1]] + 0.3 and got[HELD[2]] > got[HELD[3]] + 0.3


def test_codes_are_complete_and_prefix_free():
    lengths, codes = canonical([9, 1, 1, 30, 2, 2, 7])
    written = [format(c, f"0{n}b") for n, c in zip(lengths, codes)]
    assert sum(2.0 ** -n for n in lengths) == 1 and not any(a != b and b.startswith(a) for a in written for b in written)
    assert lengths[3] == 1 and canonical([5]) == ([0], [0])


def small_model():
    rng = random.Random(6)
    words = [b"", b"top"] + [f"{rng.choice('abc')}{i}".encode() for i in range(60)]
    classes = [-1, -1] + [rng.randrange(4) for _ in range(60)]
    model = WordModel(words, [90, 80] + [rng.randrange(1, 60) for _ in range(60)], classes, [3, 0, 9, 1], 2, 6)
    return model, classes, rng


def made(model, classes, rng, n):
    """One text: symbols, places in the dictionary, spelled words."""
    sym, ids, spelled = [], [], []
    for _ in range(n):
        if rng.random() < 0.2:
            sym.append(2 + rng.randrange(4))
            ids.append(-1)
            spelled.append("".join(rng.choices("abcé", k=rng.randint(1, 9))).encode())
        else:
            place = rng.randrange(len(classes))
            ids.append(place)
            sym.append(place if classes[place] < 0 else 2 + classes[place])
    return sym + [0], ids + [0], spelled


def items_of(model, texts):
    sym = np.array([s for t in texts for s in t[0]])
    sizes = [len(t[0]) for t in texts]
    starts = np.cumsum([0] + sizes[:-1])
    last = np.append(6, sym[:-1])
    last[starts] = 6
    spelled = b"".join(w + b" " for t in texts for w in t[2])
    return model.items(sym, last, starts, np.array([i for t in texts for i in t[1]]), np.frombuffer(spelled, np.uint8))


def plain_bits(items):
    """(item, depth, path so far, bit) of every bit of one text, from the codes' digits."""
    for i, (n, code) in enumerate(zip(items[0].tolist(), items[1].tolist())):
        digits = format(code, f"0{n}b") if n else ""
        for d, digit in enumerate(digits):
            yield i, d, int("1" + digits[:d], 2), int(digit)


def places_of(items, i, path):
    mask = (1 << 64) - 1
    return [(((path * word_bits.A & mask) ^ int(c[i])) * word_bits.C & mask) >> (64 - word_bits.WORD_BITS) for c in items[2]]


def plain_mixer(model, items, events):
    squash = lambda x: 1 / (1 + math.exp(-x))
    total = 0.0
    for at, (i, d, path, bit) in enumerate(plain_bits(items)):
        if at % events == 0:
            weights, refine, own, seen = {}, {}, {}, Counter()
        slots = places_of(items, i, path)
        node, gate = slots[0] % OWN, (int(items[3][i]), min(d, DEEP - 1))
        x = [model.tables[o][s] for o, s in enumerate(slots)] + [own.get(node, 0.0)]
        w = weights.setdefault(gate, [0.34] * 4)
        mix = min(8, max(-8, sum(a * b for a, b in zip(w, x))))
        cell = int(mix * 2 + 16)
        told = refine.get(cell, cell / 2 - 8)
        p, refined, chance = squash(mix), squash(told), squash(x[3])
        final = 0.75 * p + 0.25 * refined
        total += math.log10(final if bit else 1 - final)
        weights[gate] = [a + 0.02 * b * (bit - p) for a, b in zip(w, x)]
        refine[cell] = told + 0.08 * (bit - refined)
        seen[node] += 1
        chance = min(0.997, max(0.003, chance + (bit - chance) / min(seen[node] + 1.5, 255)))
        own[node] = math.log(chance / (1 - chance))
    return total


def test_words_in_lockstep_are_the_plain_mixer(monkeypatch):
    """Texts of very unlike lengths, cut after 700 bits, together and alone; counts bit by bit."""
    model, classes, rng = small_model()
    texts = [made(model, classes, rng, n) for n in (0, 1, 3, 40, 0, 300, 90, 2)]
    assert [len(list(plain_bits(items_of(model, [t])))) > 700 for t in texts].count(True) >= 1
    together = items_of(model, texts)
    seen = np.zeros((3, 2 * WORD_SLOTS), np.int64)
    model.count(together, seen)
    slow = np.zeros_like(seen)
    for i, _, path, bit in plain_bits(together):
        for order, slot in enumerate(places_of(together, i, path)):
            slow[order, 2 * slot + bit] += 1
    assert (slow == seen).all() and seen.any()
    model.learnt(seen)
    monkeypatch.setattr(word_bits, "EVENTS", 700)
    alone = [items_of(model, [t]) for t in texts]
    want = [plain_mixer(model, one, 700) for one in alone]
    assert np.allclose(model.log10(together), want, rtol=2e-4)
    assert np.allclose([model.log10(one)[0] for one in alone], want, rtol=2e-4)
    monkeypatch.setattr(word_bits, "PIECE", 50)             # many runs of texts, long texts cut
    short = [k for k, one in enumerate(alone) if len(one[0]) <= 50]
    assert np.allclose(model.log10(together)[short], np.array(want)[short], rtol=2e-4)


def test_every_word_is_in_its_text_and_one_huge_word_is_spelled(spark):
    """The model's bits cover each text to the last letter: a changed letter anywhere changes the score."""
    rows = [(i, "some words here and there") for i in TRAIN[:30]]
    long = "x" * 300_000
    got = scores(spark, rows + [(HELD[0], long), (HELD[1], long[:-1] + "y"), (HELD[2], long), (HELD[3], None)])
    assert got[HELD[0]] != got[HELD[1]] and got[HELD[0]] == got[HELD[2]] and -3 < got[HELD[3]] < 0
