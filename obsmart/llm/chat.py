"""Chat formatting over a prefix tree of conversations.

Conversations that share their first turns share tree nodes: a node is a turn after a given
sequence of turns, and its text is emitted once, depth first. Every node carries its place in the
emission, its position (as if its conversation stood alone) and its ancestors' intervals in the
emission, so that a model attends from a node to its ancestors and to nothing else.

The tree is never gathered. A node's name is a hash of all turns up to it; distinct conversations
are range-sorted by their names, which is depth-first order, and numbered in two steps (inside
partitions, then by partition sums). A node is emitted by the first conversation that has it, so
each conversation emits one run, its last nodes; running sums of run lengths are made per number
block. A common first turn, or thousands of equal conversations, are a few rows after map-side
aggregation.

Template: ``<|im_start|>`` role LF text ``<|im_end|>`` LF. Inside roles and texts a backslash
becomes two, ``<|`` becomes ``<\\|`` and, in roles, LF becomes ``\\n``; so the control strings occur
only where the template puts them, and reading back restores every text. The loss mask covers the
escaped text of assistant turns. Lengths and offsets count characters of the emission (code
points); a tokenizer that works node by node can be laid over it.

Defined results
    null role or text: empty. Turns go by turn (null last), ties by role and text; repeated rows
    are repeated turns. A null conv_id is a conversation. An empty table gives an empty result.
    Further columns are not carried. Long texts are kept whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsmart.llm.storage import stored

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
BLOCK = 4096             # numbers per block of the running sum


def escaped(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id, turns: array of (role, text) in order, both escaped."""
    row = F.struct(F.col("turn").isNull().alias("last"), F.col("turn"), escaped_role(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"))
    return (turns.select("conv_id", row.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns")))


def _name(df: DataFrame) -> DataFrame:
    """Adds names: for each turn the hash (16 bytes, hex) of all turns up to it."""
    def chain(batches: Iterator) -> Iterator:
        for batch in batches:
            out = []
            for turns in batch["turns"]:
                path, sofar = [], b""
                for t in turns.as_py():
                    role, text = t["role"].encode("utf-8", "surrogatepass"), t["text"].encode("utf-8", "surrogatepass")
                    sofar = hashlib.blake2b(sofar + b"%d:" % len(role) + role + text, digest_size=16).digest()
                    path.append(sofar.hex())
                out.append(path)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.string()))], [*batch.schema.names, "names"])

    return df.mapInArrow(chain, "conv_id bigint, turns array<struct<role:string,text:string>>, names array<string>")


def _numbered(paths: DataFrame) -> DataFrame:
    """``paths`` (leaf, names; distinct) with ``number``: its place in depth-first order, from 0."""
    dealt = stored(paths.repartitionByRange("names").withColumn("part", F.spark_partition_id()))
    sums = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))           # a row per partition
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("names")) - 1
    return (dealt.withColumn("inside", inside).join(sums, "part")
            .select("leaf", "names", (F.col("before") + F.col("inside")).cast("long").alias("number")))


def _node_text() -> Column:
    return F.concat(F.lit(START), F.col("t.role"), F.lit("\n"), F.col("t.text"), F.lit(END + "\n"))


def format_chats(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members: conv_id, leaf; steps: leaf, name - the nodes of each distinct conversation; nodes).

    nodes, one row per tree node: name, parent, depth, role and text (escaped), formatted, loss
    (start and end in ``formatted`` of what is learnt, null if nothing), at (place in the emission),
    position (place in its conversation), first and last (numbers of the conversations below it),
    ancestors (intervals of the emission that it attends to, besides itself; adjoining ones merged).
    """
    named = stored(_name(conversations_of(turns)))
    leaf = F.element_at("names", -1)
    members = named.select("conv_id", leaf.alias("leaf"))
    # equal conversations are one path: only hashes are compared
    paths = stored(_numbered(named.select(leaf.alias("leaf"), "names").groupBy("leaf").agg(F.first("names").alias("names"))))
    steps = stored(paths.select("leaf", "number", F.posexplode("names").alias("depth", "name"), "names")
                   .select("leaf", "number", "depth", "name", F.get("names", F.col("depth") - 1).alias("parent")))
    spans = (steps.groupBy("name").agg(F.min("number").alias("first"), F.max("number").alias("last"),
                                       F.first("depth").alias("depth"), F.first("parent").alias("parent")))
    texts = (named.select(F.explode(F.arrays_zip("names", "turns")).alias("x"))
             .select(F.col("x.names").alias("name"), F.col("x.turns").alias("t")).groupBy("name").agg(F.first("t").alias("t")))
    nodes = spans.join(texts, "name").withColumn("formatted", _node_text())
    begin = F.length(F.lit(START)) + F.length("t.role") + 1
    nodes = stored(nodes.select(
        "name", "parent", "depth", "first", "last", F.col("t.role").alias("role"), F.col("t.text").alias("text"), "formatted",
        F.when(F.col("t.role") == LOSS_ROLE, F.struct(begin.cast("long").alias("start"), (begin + F.length("t.text")).cast("long").alias("end"))).alias("loss"),
        F.length("formatted").cast("long").alias("length")))
    # a conversation emits the nodes that it is the first to have: one run, from its own number on
    lengths = nodes.groupBy("first").agg(F.sum("length").alias("run")).withColumn("block", F.floor(F.col("first") / BLOCK))
    blocks = lengths.groupBy("block").agg(F.sum("run").alias("n"))
    base = F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("block", F.coalesce(base, F.lit(0)).alias("base"))
    within = F.sum("run").over(Window.partitionBy("block").orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    runs = (lengths.withColumn("within", F.coalesce(within, F.lit(0))).join(blocks, "block")
            .select("first", (F.col("base") + F.col("within")).alias("run_at")))
    placed = nodes.select("name", "depth", "first", "length").join(runs, "first")
    along = steps.select("number", "name").join(placed, "name")
    path = F.sort_array(F.collect_list(F.struct("depth", "name", "first", "run_at", "length")))
    return members, steps.select("leaf", "name"), nodes.join(_placed(along.groupBy("number").agg(path.alias("path"))), "name")


def _placed(walks: DataFrame) -> DataFrame:
    """name, at, position, ancestors of every node, told by the path that emits it. A path shares
    the beginning of each run that it passes, so a run's nodes follow each other from its start."""
    kinds = pa.schema([("name", pa.string()), ("at", pa.int64()), ("position", pa.int64()),
                       ("ancestors", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def walk(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for number, path in zip(batch["number"].to_pylist(), batch["path"]):
                at, position, before, run = 0, 0, [], None
                for node in path.as_py():
                    if node["first"] != run:
                        run, at = node["first"], node["run_at"]
                    if run == number:
                        rows.append({"name": node["name"], "at": at, "position": position, "ancestors": list(before)})
                    end = at + node["length"]
                    if before and before[-1]["end"] == at:
                        before[-1] = {"start": before[-1]["start"], "end": end}
                    else:
                        before.append({"start": at, "end": end})
                    at, position = end, position + node["length"]
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return walks.mapInArrow(walk, "name string, at bigint, position bigint, ancestors array<struct<start:bigint,end:bigint>>")


_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)


def plain(text: str, is_role: bool = False) -> str:
    """The text before it was escaped."""
    return _ESCAPE.sub(lambda m: "\n" if is_role and m[1] == "n" else m[1], text)


def read_back(members: DataFrame, steps: DataFrame, nodes: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars: every conversation
    as it is read from its nodes in the emission, by the template and the loss spans."""
    parts = F.sort_array(F.collect_list(F.struct("position", "formatted", "loss")))
    whole = steps.join(nodes.select("name", "position", "formatted", "loss"), "name").groupBy("leaf").agg(parts.alias("parts"))
    kinds = "leaf string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def read(batches: Iterator) -> Iterator:
        def sha(x: str) -> str:
            return hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()

        for batch in batches:
            rows = []
            for leaf, parts in zip(batch["leaf"].to_pylist(), batch["parts"]):
                parts = parts.as_py()
                text = "".join(p["formatted"] for p in parts)
                turns = [(plain(r, True), plain(t)) for r, t in _TURN.findall(text)]
                loss = "".join(plain(p["formatted"][p["loss"]["start"]:p["loss"]["end"]]) for p in parts if p["loss"])
                rows.append((leaf, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)] if rows else [pa.array([], k) for k in (
                pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())],
                ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return members.join(whole.mapInArrow(read, kinds), "leaf").drop("leaf")
