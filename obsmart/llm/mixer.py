"""The logistic mixer of four chances, for the bits of many texts (lanes) at a time.

Each lane has its own weights (a set for each gate), an adaptive count for every node, and a second
adaptive stage; all start afresh and are learnt bit by bit. What does not wait for the bit before it
is not done bit by bit: a node's count follows from the lane's earlier bits of that node alone, and
the weights of a gate from its own earlier bits alone. So the counts come from a sort, and the
weights of all gates of all lanes move at once, each gate's first bit, then its second, and so on.
Only the second stage, which every bit of a lane may share, goes through the lanes in lockstep.
"""

from __future__ import annotations

from collections.abc import Callable

LANES = 2048              # lanes whose second stage moves at a time
BLOCK = 1 << 18           # bits (of whole lanes) whose weights are learnt at a time
PART = 1 << 15            # bits (of whole lanes) that are looked up and sorted at a time
STEPS = 64                # bits of each lane that are looked up at once for the second stage
PLAIN = 248               # bits of a node whose chance is a plain share: no bound is met before


def grouped(group, sizes, low=None) -> tuple:
    """The bits by lane, then group, in order within each: (their places, their ``low`` bits, first place
    and size of each group). ``sizes``: bits of the lanes, one after the other."""
    import numpy as np

    n, shift = len(group), int(sizes.max()).bit_length() + 1
    kind = np.uint32 if int(group.max()) >> (32 - shift) == 0 else np.int64
    lane = np.cumsum(sizes) - sizes
    key = group.astype(kind)
    key <<= kind(shift)
    place = np.arange(n, dtype=kind)
    place -= np.repeat(lane.astype(kind), sizes)
    place <<= kind(1)
    key |= place
    if low is not None:
        key |= low.astype(kind)
    for a, b in zip(lane.tolist(), (lane + sizes).tolist()):
        key[a:b].sort()
    of = key >> kind(shift)
    first = np.empty(n, bool)
    np.not_equal(of[1:], of[:-1], out=first[1:])
    first[lane[sizes > 0]] = True
    starts = np.nonzero(first)[0]
    if low is not None:
        low = (key & kind(1)).astype(np.int32)
    key >>= kind(1)
    key &= kind((1 << (shift - 1)) - 1)
    at = key.astype(np.int64)
    at += np.repeat(lane, sizes)
    return at, low, starts, np.diff(starts, append=n)


def adapted(node, bits, lanes, out) -> None:
    """Stretched chance of a 1 by the earlier bits of the same node and lane: a share with 0.75 added on
    both sides, of some 255 bits at most, between 0.003 and 0.997. ``lanes``: bits of each."""
    import numpy as np

    f = np.float32
    at, bit, starts, sizes = grouped(node, lanes, bits)
    ones = np.cumsum(bit, dtype=np.int32)
    ones -= bit
    before = np.zeros(len(at), np.int32)                               # ones before the group
    before[starts] = ones[starts]
    ones -= np.maximum.accumulate(before, out=before)
    zeros = np.arange(len(at), dtype=np.int32)
    before[starts] = starts
    zeros -= np.maximum.accumulate(before, out=before)
    zeros -= ones
    share = ones.astype(f)
    share += f(0.75)
    rest = zeros.astype(f)
    rest += f(0.75)
    share /= rest
    many = np.nonzero(sizes > PLAIN + 1)[0]
    if len(many):
        many = many[np.argsort(-sizes[many], kind="stable")]           # largest first
        first, size = starts[many] + PLAIN, sizes[many] - PLAIN
        chance = ((ones[first] + 0.75) / (PLAIN + 1.5)).astype(f)
        live = len(size) - np.searchsorted(size[::-1], np.arange(1, size[0]), "right")
        for r, n in enumerate(live.tolist()):                          # bits PLAIN, PLAIN + 1, ...
            here, chance = first[:n] + r, chance[:n]
            chance += (bit[here] - chance) / f(min(PLAIN + r + 2.5, 255))
            np.maximum(chance, f(0.003), out=chance)
            np.minimum(chance, f(0.997), out=chance)
            share[here + 1] = chance / (f(1) - chance)
    np.log(share, out=share)
    out[at] = share


def mixed(x, starts, sizes):
    """The mix of the chances that every column of ``x`` gives to its bit, by weights that each gate
    learns from its bits in order. The bits of gate i are ``sizes[i]`` columns from ``starts[i]`` on."""
    import numpy as np

    f = np.float32
    order = np.argsort(-sizes, kind="stable")                          # longest first
    here, sizes = starts[order], sizes[order]
    live = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), "right")
    out, weights = np.empty(x.shape[1], f), np.full((4, len(sizes)), f(0.34))
    low, high, one, rate = (np.array(v, f) for v in (-8, 8, 1, 0.02))
    room, taken, sums, errors = np.empty((4, len(sizes)), f), np.empty((4, len(sizes)), f), np.empty(len(sizes), f), np.empty(len(sizes), f)
    for k in live.tolist():                                            # the first bits of all gates, their second bits, ...
        at, w, xs, moved, m, e = here[:k], weights[:, :k], taken[:, :k], room[:, :k], sums[:k], errors[:k]
        for row, to in zip(x, xs):
            row.take(at, 0, to, "clip")
        np.multiply(w, xs, moved)
        np.add.reduce(moved, 0, None, m)
        np.maximum(m, low, m)
        np.minimum(m, high, m)
        out[at] = m
        np.exp(m, e)
        np.add(e, one, e)
        np.divide(rate, e, e)                                          # the chance of the other bit
        np.multiply(xs, e, moved)
        np.add(w, moved, w)
        at += 1
    return out


def refined(mix, bits, sizes):
    """log10 of the chance of each lane's bits: every mix averaged with what the lane's second stage
    holds for mixes like it, which is learnt bit by bit. ``sizes``: bits of the lanes, one after the other."""
    import numpy as np

    f = np.float32
    start = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")                          # longest first
    long, start = sizes[order], start[order]
    rows = np.arange(len(sizes)) * 33
    table = np.tile(np.linspace(8, -8, 33).astype(f), len(sizes))      # of a 0, by the mix of a 1
    one, rate = np.array(1, f), np.array(0.08, f)
    total = np.zeros(len(sizes))
    for a in range(0, int(long.max(initial=0)), STEPS):
        live = int(np.searchsorted(-long, -a))                         # lanes longer than a come first
        steps = np.arange(a, min(a + STEPS, int(long[0])))[:, None]
        at = start[:live] + steps                                      # what a lane learns after its end counts no more
        m, bit = mix.take(at, mode="clip"), bits.take(at, mode="clip")
        cell = (m * f(2) + f(16)).astype(np.int64)
        cell += rows[:live]
        move = bit * f(0.08)
        second, error, told = np.empty_like(m), np.empty(live, f), np.empty(live, f)
        for c, s, by in zip(cell, second, move):
            table.take(c, 0, told, "clip")
            np.exp(told, error)
            np.add(error, one, error)
            np.divide(rate, error, s)
            np.subtract(s, by, error)
            np.add(told, error, told)
            table[c] = told
        np.negative(m, out=m)
        np.exp(m, out=m)
        m += one
        np.divide(f(0.75), m, out=m)
        second *= f(0.25 / 0.08)
        m += second
        m -= ~bit
        np.abs(m, out=m)                                               # 1 less it, where the bit is 0
        np.log(m, out=m)
        if long[live - 1] < a + len(steps):
            m *= steps < long[:live]
        total[:live] += m.sum(axis=0, dtype=np.float64)
    out = np.empty(len(sizes))
    out[order] = total / np.log(10)
    return out


def signs(bits):
    """1 for a 1, -1 for a 0."""
    import numpy as np

    out = bits * np.float32(2)
    out -= np.float32(1)
    return out


def blocks(ends, most: int, first: int, last: int):
    """Runs (a, b) of the lanes ``first`` to ``last`` with ``most`` bits, or one lane; ``ends``: bits before each lane."""
    import numpy as np

    while first < last:
        b = min(last, max(first + 1, int(np.searchsorted(ends, ends[first] + most, "right")) - 1))
        yield first, b
        first = b


def log10(sizes, bits_of: Callable):
    """log10 of the chance of each lane's bits. ``sizes``: bits of every lane; ``bits_of(a, b)``: of the
    lanes a to b, bit after bit, three rows of stretched chances, the
    bits, their gates and their nodes (numbers from 0)."""
    import numpy as np

    out = np.zeros(len(sizes))
    for wave in range(0, len(sizes), LANES):
        some = sizes[wave:wave + LANES]
        ends = np.append(0, np.cumsum(some))
        mix, bits = np.empty(ends[-1], np.float32), np.empty(ends[-1], bool)
        for a, b in blocks(ends, BLOCK, 0, len(some)):
            lo, n = ends[a], ends[b] - ends[a]
            if not n:
                continue
            parts = list(blocks(ends, PART, a, b))
            x, node, gate = np.empty((4, n), np.float32), np.empty(n, np.int32), np.empty(n, np.int32)
            for c, d in parts:
                on = slice(ends[c] - lo, ends[d] - lo)
                x[:3, on], bits[ends[c]:ends[d]], gate[on], node[on] = bits_of(wave + c, wave + d)
            adapted(node, bits[lo:lo + n], some[a:b], x[3])
            at, starts, counts = np.empty(n, np.int64), [], []
            for c, d in parts:
                on = slice(ends[c] - lo, ends[d] - lo)
                if on.stop > on.start:
                    x[:, on] *= signs(bits[ends[c]:ends[d]])                # now chances of the bit itself
                    place, _, first, count = grouped(gate[on], some[c:d])
                    for row in x[:, on]:
                        row[:] = row.take(place, mode="clip")
                    at[on] = place + ends[c]
                    starts.append(first + on.start)
                    counts.append(count)
            mix[at] = mixed(x, np.concatenate(starts), np.concatenate(counts))
        mix *= signs(bits)                                             # again of a 1
        out[wave:wave + LANES] = refined(mix, bits, some)
    return out
