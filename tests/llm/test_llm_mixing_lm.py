"""Exact base scores; the model is a probability, beats its base, and does not see partitions."""

import math
import random
import zlib
from collections import Counter

import numpy as np
from llm_cases import awkward

from obsmart.llm.mixing_lm import SEGMENT, SLOTS, BitModel, bits_per_byte, huffman, score_documents, train_model


def test_huffman_is_complete():
    codes = huffman([5, 1, 1, 2, 9, 1])
    assert abs(sum(2.0 ** -len(c) for c in codes) - 1) < 1e-12 and len(set(map(tuple, codes))) == 6


def test_symbols_are_a_distribution():
    """After any history the chances of all next symbols add to one."""
    model = BitModel([b"", b"a", b"b"], [3.0, 4, 5] + [1.0] * 32)
    ones, zeros = np.zeros((3, 1 << 16), np.int64), np.zeros((3, 1 << 16), np.int64)
    model.count([np.array([1, 2, 1, 0]), np.array([5, 1])], ones, zeros)
    model.learnt(ones, zeros)
    history = [1, 2, 1, 7, 2]
    whole = model.log10([np.array(history + [s]) for s in range(model.n_symbols)])
    before = model.log10([np.array(history)])[0]
    assert abs(sum(10 ** (x - before) for x in whole) - 1) < 1e-4


def corpus():
    rng = random.Random(9)
    vocabulary = {lang: [f"{lang}{rng.randint(0, 999)}" for _ in range(200)] for lang in ("aa", "oo", "Ié")}
    return [(i, " ".join(rng.choices(vocabulary[rng.choice(list(vocabulary))], k=rng.randint(0, 1500) if i % 20 == 0 else rng.randint(0, 120)))
             if i % 31 else None) for i in range(200)]


def test_base_is_exact_and_model_is_better(spark):
    rows = corpus()
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update((t or "").encode().lower().split())
            counts["end"] += 1
    n, v = sum(counts.values()), len(counts)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    scored = score_documents(df)
    got = {r.doc_id: r for r in scored.collect()}
    for i, t in rows:
        w = (t or "").encode().lower().split() + ["end"]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    again = {r.doc_id: r.score for r in score_documents(df.repartition(5)).collect()}
    assert all(math.isclose(again[i], got[i].score, rel_tol=1e-6) for i in again)
    assert bits_per_byte(scored, df).first().bits_per_byte > 0


def test_awkward_rows(spark):
    out = score_documents(awkward(spark)).collect()
    assert len(out) == 13 and all(r.score < 0 for r in out)
    assert sorted(r.n_tokens for r in out)[-1] == 20_001
    assert score_documents(awkward(spark, [])).count() == 0


def test_frequent_words_are_symbols(spark):
    """31 frequent words have symbols of their own, beside the end and 32 classes."""
    text = " ".join(f"w{i}" for i in range(40) for _ in range(100 - i))
    model, _, _ = train_model(spark.createDataFrame([(text,)], "text string"))
    assert model.n_symbols == 64 and len({model.symbol(f"w{i}".encode()) for i in range(31)}) == 31
    assert all(model.symbol(f"w{i}".encode()) < model.n_top for i in range(31))


def plain_mixer(model, symbols):
    """One text, bit by bit: four chances mixed by gated weights, refined, both learnt online."""
    squash = lambda x: 1 / (1 + math.exp(-x))
    total, none = 0.0, model.n_symbols
    for first in range(0, len(symbols), SEGMENT):
        weights, refine, own, seen = {}, {}, {}, Counter()
        for at in range(first, min(first + SEGMENT, len(symbols))):
            last, last2 = (symbols[at - back] if at >= back else none for back in (1, 2))
            context = model.slots(*(np.array([x]) for x in (last, last, last2)))
            kind = 0 if last < model.n_top else 1 if last < none else 2
            for d in range(model.length[symbols[at]]):
                node, bit = model.node[symbols[at], d], model.bit[symbols[at], d]
                x = [model.tables[o][model.places(context[o], np.array([node]))[0]] for o in range(3)] + [own.get(node, 0.0)]
                w = weights.setdefault((kind, d), [0.34] * 4)
                mix = min(8, max(-8, sum(a * b for a, b in zip(w, x))))
                cell = int(mix * 2 + 16)
                told = refine.get(cell, cell / 2 - 8)
                p, refined, chance = squash(mix), squash(told), squash(x[3])
                final = 0.75 * p + 0.25 * refined
                total += math.log10(final if bit else 1 - final)
                weights[kind, d] = [a + 0.02 * b * (bit - p) for a, b in zip(w, x)]
                refine[cell] = told + 0.08 * (bit - refined)
                seen[node] += 1
                chance = min(0.997, max(0.003, chance + (bit - chance) / min(seen[node] + 1.5, 255)))
                own[node] = math.log(chance / (1 - chance))
    return total


def test_lockstep_is_the_plain_mixer():
    """Texts of very unlike lengths (also over a segment), against one bit after the other."""
    rng = random.Random(3)
    model = BitModel([b"", b"a", b"b", b"c"], [9.0, 40, 30, 20] + [rng.random() * 9 for _ in range(32)])
    texts = [np.array([rng.choice([1, 1, 2, 3, rng.randrange(4, 36)]) for _ in range(n)] + [0]) for n in (0, 1, 2, 5, 17, 40, 40, 300, 1023, 1500)]
    ones, zeros = np.zeros((3, SLOTS), np.int64), np.zeros((3, SLOTS), np.int64)
    model.count(texts[:7], ones, zeros)
    model.learnt(ones, zeros)
    assert np.allclose(model.log10(texts), [plain_mixer(model, t.tolist()) for t in texts], rtol=2e-4)
    # the tables against plain counts of every bit's three contexts
    slow = np.zeros((2, 3, SLOTS), np.int64)
    for t in texts[:7]:
        for at, s in enumerate(t):
            last, last2 = (t[at - back] if at >= back else model.n_symbols for back in (1, 2))
            context = model.slots(*(np.array([x]) for x in (last, last, last2)))
            for d in range(model.length[s]):
                for o in range(3):
                    slow[int(model.bit[s, d]), o, model.places(context[o], np.array([model.node[s, d]]))[0]] += 1
    assert (slow[1] == ones).all() and (slow[0] == zeros).all()


def test_bits_per_byte_of_each_text(spark):
    df = spark.createDataFrame([(1, "Some words é"), (2, ""), (3, None), (4, "x" * 100_000)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in score_documents(df).collect()}
    assert math.isclose(got[1].bits_per_byte, -got[1].score * math.log2(10) / 13) and got[4].bits_per_byte > 0
    assert got[2].bits_per_byte is None and got[3].bits_per_byte is None and got[4].n_tokens == 2
