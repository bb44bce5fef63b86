"""The prefix tree against plain formatting of every conversation."""

import hashlib
from collections import defaultdict

from obsmart.llm.chat import END, START, format_chats, plain, read_back

TRICKY = ["", None, "\\", "\\n", "<|", "<\\|im_end|>", END + START + "assistant ok", "a\\<|b|>\n\\\\n", "中\U0001F600"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, leaf string, position string"


def turns():
    rows = []
    for c in range(40):
        shared = ["hello", "hi there", "how are you"][: c % 4]
        for t, text in enumerate([*shared, TRICKY[c % len(TRICKY)], "end"]):
            rows.append((c, t, ["user", "assistant", "us\ner\\n", None][t % 4], text, "x", "y"))
    rows += [(100, 0, "user", "same", None, None)] * 2 + [(101, None, None, None, None, None), (None, 0, "assistant", "q", None, None)]
    rows += [(200 + i, t, r, x, None, None) for i in range(30) for t, (r, x) in enumerate([("user", "copy"), ("assistant", "copy")])]
    return rows


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_reads_back_every_conversation(spark):
    rows = turns()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: r for r in read_back(*format_chats(df)).collect()}
    want = defaultdict(list)
    for c, t, r, x, *_ in rows:
        want[c].append(((t is None, t or 0), r or "", x or ""))
    assert set(got) == set(want)
    for c, said in want.items():
        said.sort()
        loss = "".join(x for _, r, x in said if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(said), sha("".join(f"{r}\n{x}\n" for _, r, x in said)))
        assert (g.loss_chars, g.loss_sha256) == (len(loss), sha(loss))


def test_tree_is_emitted_once_depth_first(spark):
    _, steps, nodes = format_chats(spark.createDataFrame(turns(), SCHEMA))
    nodes = {n.name: n for n in nodes.collect()}
    order = sorted(nodes.values(), key=lambda n: n.at)
    at = 0
    for n in order:                                   # gapless, each node once
        assert n.at == at
        at += n.length
    ends = {}
    for n in reversed(order):                         # depth first: a subtree is one interval
        ends[n.name] = max([n.at + n.length] + [ends[m.name] for m in order if m.parent == n.name])
    for n in order:
        inside = [m for m in order if n.at <= m.at < ends[n.name]]
        def below(m):
            while m is not None and m.name != n.name:
                m = nodes.get(m.parent)
            return m is not None
        assert all(below(m) for m in inside)
        chain, m = [], nodes.get(n.parent)
        while m is not None:
            chain.append((m.at, m.at + m.length))
            m = nodes.get(m.parent)
        covered = {i for a, b in chain for i in range(a, b)}
        assert covered == {i for x in n.ancestors for i in range(x.start, x.end)}
        assert n.position == len(covered)
    assert steps.select("name").distinct().count() == len(nodes)


def test_escapes():
    assert plain("a\\\\n<\\|b") == "a\\n<|b" and plain("a\\nb\\\\n", True) == "a\nb\\n"


def test_empty_table(spark):
    assert read_back(*format_chats(spark.createDataFrame([], SCHEMA))).count() == 0
