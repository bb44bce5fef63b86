"""Pipeline stages on the small tables: columns, decisions, order; queries and the entry's guard."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline

import random
from collections import Counter, defaultdict

from test_llm_curriculum import reshared
from test_llm_dartminhash import brute as near_groups
from test_llm_quality import brute as plain_counts
from tokenizers import Tokenizer

from obsmart.llm.tokens import public_tokenizer

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, class_node bigint, kept string"


def test_stages(spark):
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {"documents": docs.count()}
    for name, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, SF))
        rows[name] = docs.count()
        if name != "packing":
            assert docs.columns == first.columns and docs.schema.simpleString() == first.schema.simpleString()
    assert [n for n, _ in pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "packing"]
    assert 0 < rows["quality"] < rows["documents"] and rows["line_dedup"] == rows["quality"] and rows["near_dedup"] < rows["quality"]
    assert rows["packing"] > 0


@pytest.mark.parametrize("key", [k for k in entry.queries() if k.startswith("op")])
def test_queries_read_the_whole_table(spark, key):
    if key.startswith("op12_"):      # its rows are words; tests/llm/test_llm_spelling.py has them
        return
    table, column = {"op2": ("conversations", "conv_id"), "op9": ("pages", "page_id"),
                     "op13": ("embeddings", "vec_id")}.get(key.split("_")[0], ("documents", "doc_id"))
    want = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(column).collect()} | ({-1} if table == "conversations" else set())
    assert {r[0] for r in entry.queries()[key](spark, SF).select(column).collect()} == want


def test_entry_works_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for d, _, files in os.walk(f"{root}/obsmart"):
        if "/llm" in d or "__pycache__" in d:
            continue
        for f in files:
            to = tmp_path / os.path.relpath(d, root) / f
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_bytes(open(f"{d}/{f}", "rb").read())
    (tmp_path / "__spark_entry__.py").write_bytes(open(f"{root}/__spark_entry__.py", "rb").read())
    code = "import __spark_entry__ as e; q = e.queries(); assert not [k for k in q if k.startswith('op') and k[2].isdigit() or k == 'pipeline']; assert e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def fixture():
    """Documents without a language (base rules alone): clean ones, copies and near copies, unlike
    texts under one id, repeated rows, nulls, shared lines, junk, and a long text."""
    rng = random.Random(17)
    word = lambda: "w" + "".join(rng.choices("abcdefghijklmnop", k=5))
    prose = lambda n: "\n".join(" ".join(word() for _ in range(20)) for _ in range(n // 20))
    shared = "a line of boiler plate that stands in many documents"
    rows = []
    for i in range(60):
        text = prose(rng.choice([60, 100, 200]))
        rows.append((i * 7 - 100, text + ("\n" + shared if i % 3 == 0 else ""), "abc"[i % 3] if i % 10 else None))
        if i % 6 == 0:
            near = text.split("\n")
            near[0] = near[0].replace(near[0].split()[3], word())
            rows.append((1000 + i, "\n".join(near), "a"))
        if i % 9 == 0:
            rows.append((2000 + i, text, "b"))
    rows += [(5000, prose(80), "a"), (5000, prose(80), "a"), (None, prose(100), "c"), (None, prose(100), None)]          # ids say little
    rows += [rows[3], rows[3], (6000, None, "a"), (6001, "", "b"), (6002, "spam spam spam " * 40, "c"), (6003, "too short", "a")]
    rows.append((7000, prose(9000), "b"))
    return [(*r[:2], None, r[2], None if r[1] is None else len(r[1]), 3, "x") for r in rows]


def test_run_against_plain_code(spark, tmp_path):
    rows = fixture()
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    out = {}
    for name, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, str(tmp_path)))
        out[name] = [tuple(r) for r in docs.collect()]
    fine = lambda t: (c := plain_counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]
    want = [r for r in rows if fine(r[1])]
    assert sorted(map(repr, out["quality"])) == sorted(map(repr, want)) and 0 < len(want) < len(rows)

    # a line's key counts once per id, so ids that stand for several texts are looked at as they are
    holders = defaultdict(set)
    for r in want:
        for line in r[1].split("\n"):
            if len(line.strip()) >= 20:
                holders[line.strip().lower()].add(r[0])
    least = lambda ids: max(ids, key=lambda i: (i is not None, i or 0))
    cut = [(r[0], "\n".join(x for x in r[1].split("\n") if len(holders[x.strip().lower()]) < 3 or least(holders[x.strip().lower()]) == r[0])) for r in want]
    assert sorted(map(repr, ((r[0], r[1]) for r in out["line_dedup"]))) == sorted(map(repr, cut))
    assert all(r[4] == len(r[1]) for r in out["line_dedup"])

    group = near_groups(list(enumerate(t for _, t in cut)))
    first = {}
    for i, (doc, text) in enumerate(cut):
        key = (doc is None, doc or 0)
        if group[i] not in first or key < first[group[i]][0]:
            first[group[i]] = (key, {text})
        elif key == first[group[i]][0]:
            first[group[i]][1].add(text)
    kept = [(r[0], r[1]) for r in out["near_dedup"]]
    assert len(kept) == len(first) == len({g for g in group.values()})
    by_text = defaultdict(set)
    for i, (_, text) in enumerate(cut):
        by_text[text].add(group[i])
    for doc, text in kept:                                                  # the least id of its group, one row each
        (g,) = by_text[text]
        key, texts = first.pop(g)
        assert (doc is None, doc or 0) == key and text in texts
    assert not first

    sizes = Counter()
    for r in out["near_dedup"]:
        sizes[r[3]] += len(r[1].split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = reshared(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken, longest = Counter(), Counter()
    for r in out["mixing"]:
        taken[r[3]] += len(r[1].split())
    for r in out["near_dedup"]:
        longest[r[3]] = max(longest[r[3]], len(r[1].split()))
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in sizes)
    copies = Counter(out["mixing"])
    assert set(copies) <= set(out["near_dedup"]) and max(copies.values()) <= 3

    pieces = [r.asDict() for r in docs.collect()]
    encode = Tokenizer.from_file(public_tokenizer("word_bpe_49k.json"))
    lengths = sorted((r[0] is None, r[0] or 0, len(encode.encode(r[1], add_special_tokens=False).ids) + 1) for r in out["mixing"])
    whole = defaultdict(int)
    for p in pieces:
        whole[(p["doc_id"] is None, p["doc_id"] or 0, p["doc_tokens"])] += p["length"]
    assert sum(n for *_, n in lengths) == sum(p["length"] for p in pieces)
    assert {k: n for k, n in whole.items()} == {k: k[2] * c for k, c in Counter(lengths).items()}
    used = defaultdict(list)
    for p in pieces:
        used[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_stages_take_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], COLUMNS)
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0
