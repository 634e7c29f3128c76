"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share them: a turn is named by a digest of all turns up to it, so equal
names are one node. Nodes are laid out depth first in one sequence, each node's tokens once, with

* position ids that go on from the parent's end, as if the conversation stood alone, and
* the intervals of the sequence in which its ancestors lie: what its tokens may attend to besides themselves.

The layout is a sort by path (names of all ancestors in a row) in ranges, and running sums inside each range on top of
the totals of the ranges before. Nodes, not trees, are sorted and joined, so a first turn that a third of all conversations share
is one row like any other.

Template: `<|role|>`, line end, text, `<|end|>`, line end. Inside texts a backslash is doubled and `<|` becomes
`<\\|`, and inside roles a bar becomes `\\p`, so no control string can come from
the data, and reading back undoes it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bpe
from .common import stored

TRAINED = "assistant"  # the role whose texts the loss covers
END = "<|end|>\n"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def segment(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and end of a formatted turn."""
    return f"<|{_role(role)}|>\n", escape(text), END


def _role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("|", "\\p")


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "|" if m[1] == "p" else m[1], role, flags=re.DOTALL)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted turns."""
    out, at = [], 0
    while at < len(formatted):
        head = formatted.index("|>\n", at + 2)
        end = formatted.index(END, head + 3)
        out.append((_unrole(formatted[at + 2:head]), unescape(formatted[head + 3:end])))
        at = end + len(END)
    return out


def conversations_of(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, turns (role, text) by turn, names of all its nodes.

    Null roles and texts are empty; equal turn numbers go by role, then text; a null turn goes first. Rows without a
    conv_id form a conversation of their own.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn").alias("turn"), blank("role").alias("role"), blank("text").alias("text")))).alias("turns"))

    def name(state: Column, t: Column) -> Column:
        key = F.md5(F.concat(state["key"], F.lit("/"), F.length(t["role"]).cast("string"), F.lit("/"), t["role"], t["text"]).cast("binary"))
        return F.struct(key.alias("key"), F.concat(state["names"], F.array(key)).alias("names"))

    start = F.struct(F.lit("").alias("key"), F.array().cast("array<string>").alias("names"))
    return grouped.withColumn("names", F.aggregate("turns", start, name, lambda s: s["names"]))


def _tokenized(nodes: DataFrame, path: str) -> DataFrame:
    names = ["node", "ancestors", "role", "text"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.codec(path)
        for part in parts:
            tokens, low, high = [], [], []
            for role, text in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                ids = [codec.ids(piece) for piece in segment(role, text)]
                tokens.append(np.concatenate(ids))
                trained = role == TRAINED
                low.append(len(ids[0]) if trained else 0)
                high.append(len(ids[0]) + len(ids[1]) if trained else 0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(tokens, pa.list_(pa.int32())), pa.array(low, pa.int32()), pa.array(high, pa.int32())],
                names=["node", "ancestors", "tokens", "loss_from", "loss_to"])

    return nodes.select(*names).mapInArrow(
        batches, "node string, ancestors array<string>, tokens array<int>, loss_from int, loss_to int")


def _laid_out(nodes: DataFrame) -> DataFrame:
    """Adds `start`: the place of a node's first token in the depth-first sequence."""
    # A path of equally long names sorts ancestors before descendants and keeps subtrees together.
    path = F.concat(F.array_join("ancestors", ""), F.col("node"))
    ranged = stored(nodes.withColumn("path", path).repartitionByRange("path").withColumn("range", F.spark_partition_id()))
    totals = ranged.groupBy("range").agg(F.sum(F.size("tokens")).alias("total"))  # a row for each range
    before = totals.select("range", (F.sum("total").over(Window.orderBy("range")) - F.col("total")).alias("before"))
    running = F.sum(F.size("tokens")).over(Window.partitionBy("range").orderBy("path")) - F.size("tokens")
    return ranged.withColumn("inside", running).join(F.broadcast(before), "range").withColumn(
        "start", F.col("before") + F.col("inside")).drop("range", "inside", "before", "path")


INTERVALS = "array<struct<start:bigint,end:bigint>>"


def _contexts(conversations: DataFrame, place: DataFrame) -> DataFrame:
    """node, position, attends: carried along each conversation, one row a turn, so long ones cost what they hold."""
    lines = (conversations.select("conv_id", F.posexplode("names").alias("k", "above")).join(place, "above").groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("k", F.col("above").alias("node"), "interval"))).alias("line")))
    state = f"struct<position:bigint,attends:{INTERVALS},out:array<struct<node:string,position:bigint,attends:{INTERVALS}>>>"

    def step(s: Column, x: Column) -> Column:
        here = F.struct(x["node"].alias("node"), s["position"].alias("position"), s["attends"].alias("attends"))
        return F.struct((s["position"] + x["interval"]["end"] - x["interval"]["start"]).alias("position"),
                        _merged_with(s["attends"], x["interval"]).alias("attends"),
                        F.concat(s["out"], F.array(here)).alias("out")).cast(state)

    start = F.struct(F.lit(0).cast("long").alias("position"), F.array().cast(INTERVALS).alias("attends"),
                     F.array().cast(f"array<struct<node:string,position:bigint,attends:{INTERVALS}>>").alias("out")).cast(state)
    each = lines.select(F.explode(F.aggregate("line", start, step, lambda s: s["out"])).alias("x")).select("x.*")
    # Conversations that share a node agree on its context.
    return each.groupBy("node").agg(F.first("position").alias("position"), F.first("attends").alias("attends"))


def _merged_with(out: Column, x: Column) -> Column:
    """Intervals in order and one more, made one with the last where they touch."""
    kind = INTERVALS
    def add(out: Column, x: Column) -> Column:
        last = F.element_at(out, -1)
        touching = (F.size(out) > 0) & (F.get(out, F.size(out) - 1)["end"] == x["start"])
        return F.when(touching, F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(last["start"].alias("start"), x["end"].alias("end"))))
                      ).otherwise(F.concat(out, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end")))))
    return add(out, x).cast(kind)


def prefix_tree(turns: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, leaves).

    nodes: node, ancestors (names from the first turn on), tokens, loss_from, loss_to (token range under the loss), start,
    position (position id of the first token; the others follow), attends (intervals of the ancestors, merged).
    leaves: conv_id, node (of the last turn), n_turns. Columns other than conv_id, turn, role and text are not read.
    """
    conversations = stored(conversations_of(turns))
    each = conversations.select("names", F.posexplode("turns").alias("k", "t")).select(
        F.get("names", F.col("k")).alias("node"), F.slice("names", F.lit(1), F.col("k")).alias("ancestors"), "t.role", "t.text")
    distinct = each.groupBy("node").agg(F.first(F.struct("ancestors", "role", "text")).alias("x")).select("node", "x.*")
    # Stored before the layout: dealing out by ranges reads its input twice.
    nodes = stored(_laid_out(stored(_tokenized(distinct, tokenizer))))
    place = nodes.select(F.col("node").alias("above"), F.struct("start", (F.col("start") + F.size("tokens")).alias("end")).alias("interval"))
    full = nodes.join(_contexts(conversations, place), "node").select(
        "node", "ancestors", "tokens", "loss_from", "loss_to", "start", "position", "attends")
    return stored(full), conversations.select("conv_id", F.element_at("names", -1).alias("node"), F.size("names").cast("long").alias("n_turns"))


def read_conversations(nodes: DataFrame, leaves: DataFrame, tokenizer: str) -> DataFrame:
    """Every conversation read back from the sequence: conv_id, turns (role, text), loss (texts under the mask), formatted."""
    # A node is found by its leaf and the leaf's ancestors; the sequence of a leaf is put together in the order of positions.
    whole = nodes.select("node", F.concat("ancestors", F.array("node")).alias("line"))
    parts = leaves.join(whole, "node").select("conv_id", F.explode("line").alias("node"))
    body = nodes.select("node", "position", "tokens", "loss_from", "loss_to")
    lines = parts.join(body, "node").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("position", "tokens", "loss_from", "loss_to"))).alias("parts"))
    kind = leaves.schema["conv_id"].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.codec(tokenizer)
        for row in rows:
            turns, loss, text = [], [], []
            for found in row.column(1):
                pieces = found.as_py()
                ids = [np.array(p["tokens"], np.int32) for p in pieces]
                formatted = codec.decode(np.concatenate(ids))
                turns.append([{"role": r, "text": t} for r, t in read_back(formatted)])
                loss.append([unescape(codec.decode(i[p["loss_from"]:p["loss_to"]])) for i, p in zip(ids, pieces, strict=True) if p["loss_to"]])
                text.append(formatted)
            yield pa.RecordBatch.from_arrays(
                [row.column(0), pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                 pa.array(loss, pa.list_(pa.string())), pa.array(text, pa.string())], names=["conv_id", "turns", "loss", "formatted"])

    return lines.mapInArrow(batches, f"conv_id {kind}, turns array<struct<role:string,text:string>>, loss array<string>, formatted string")

