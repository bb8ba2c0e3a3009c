"""Chat formatting as a prefix tree: shared turns once, depth-first, with positions and ancestor intervals."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import settle
from riskframe.llm.tokens import load

# The template: control strings mark turns, other roles are spelled out.
CONTROL = ("[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<</ROLE>>", "<<SYS>>", "<</SYS>>")
_ESCAPED = re.compile(r"\\|" + "|".join(re.escape(mark) for mark in sorted(CONTROL, key=len, reverse=True)))
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<s> (?P<assistant>.*?) </s>"
    r"|<<ROLE>>(?P<role>.*?)<</ROLE>>(?P<other>.*?)<</SYS>>", re.DOTALL)


def escape(text: str) -> str:
    """Backslashes are doubled and control strings broken by one after their first character."""
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turn(role: str, text: str) -> str:
    if role == "user":
        return f"[INST] {escape(text)} [/INST]"
    if role == "assistant":
        return f"<s> {escape(text)} </s>"
    return f"<<ROLE>>{escape(role)}<</ROLE>>{escape(text)}<</SYS>>"


def read_turns(formatted: str) -> list[tuple[str, str, bool]]:
    """``(role, text, under the loss mask)`` of each turn of a formatted conversation."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"not a formatted conversation at {at}")
        at = m.end()
        if m["user"] is not None:
            out.append(("user", unescape(m["user"]), False))
        elif m["assistant"] is not None:
            out.append(("assistant", unescape(m["assistant"]), True))
        else:
            out.append((unescape(m["role"]), unescape(m["other"]), False))
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation at {at}")
    return out


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, last, node, path, role, text``: one row per turn, its node named by all turns up to it."""
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))
    whole = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "depth", "last", "node", "path", "role", "text"]
        for batch in batches:
            rows = []
            for conv_id, roles, texts in zip(batch["conv_id"].tolist(), batch["roles"], batch["texts"], strict=True):
                node, path = b"", b""
                for depth, (role, text) in enumerate(zip(roles, texts, strict=True)):
                    data = [part.encode("utf-8", "surrogatepass") for part in (role, text)]
                    node = hashlib.blake2b(node + len(data[0]).to_bytes(8, "big") + b"".join(data),
                                           digest_size=16).digest()
                    path += node[:8]
                    rows.append((conv_id, depth, depth == len(roles) - 1, node, path, role, text))
                if len(rows) > 5000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    # Ids pass through Python as text: a number beside a null would become a double there.
    source = whole.select(F.col("conv_id").cast("long").cast("string").alias("conv_id"),
                          F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    paths = source.mapInPandas(
        work, "conv_id string, depth int, last boolean, node binary, path binary, role string, text string")
    return paths.withColumn("conv_id", F.col("conv_id").cast("long"))


def _tokenized(nodes: DataFrame, tokenizer_path: str) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load(tokenizer_path)
        tokenizer.encode_special_tokens = True
        for batch in batches:
            texts = [format_turn(r, t) for r, t in zip(batch["role"].tolist(), batch["text"].tolist(), strict=True)]
            ids = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
            yield pd.DataFrame({
                "node": batch["node"].tolist(), "depth": batch["depth"].tolist(), "path": batch["path"].tolist(),
                "role": batch["role"].tolist(),
                "ids": [np.array(x, dtype="<u4").tobytes() for x in ids], "length": [len(x) for x in ids]})

    return nodes.mapInPandas(work, "node binary, depth int, path binary, role string, ids binary, length long")


_SPANS = "array<struct<start: long, end: long>>"
_SCAN = f"node binary, part int, start long, inherited int, position long, above {_SPANS}, total long"


def _emitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Depth-first scan of a sorted partition: offsets inside it, ancestors inside it, the open path at its end.

    Ancestors that earlier partitions emitted are only counted (``inherited``). The last
    row, without a node, has the tokens of the partition and what stays open.
    """
    part, offset, stack, opened = TaskContext.get().partitionId(), 0, [], None
    names = ["node", "part", "start", "inherited", "position", "above", "total"]
    for batch in batches:
        rows = []
        for node, depth, length in zip(batch["node"].tolist(), batch["depth"].tolist(), batch["length"].tolist(),
                                       strict=True):
            if opened is None:
                opened, stack = depth, [None] * depth
            del stack[depth:]
            above = [span for span in stack if span is not None]
            inside = sum(end - start for start, end in above)
            rows.append((node, part, offset, depth - len(above), inside,
                         [{"start": start, "end": end} for start, end in above], None))
            stack.append((offset, offset + length))
            offset += length
        out = pd.DataFrame(rows, columns=names)
        yield out.astype({"total": "Int64"})
    open_spans = [span for span in stack if span is not None]
    last = pd.DataFrame([(None, part, opened or 0, len(stack) - len(open_spans), 0,
                          [{"start": start, "end": end} for start, end in open_spans], offset)], columns=names)
    yield last


def prefix_tree(spark: SparkSession, paths: DataFrame, tokenizer_path: str) -> DataFrame:
    """``node, depth, role, loss, ids, start, length, position, ancestors`` of each distinct node of ``paths``.

    Nodes follow each other depth-first; ``start`` counts the tokens before a node, so the
    shared tokens of all conversations are emitted once. ``position`` is the position id
    of its first token, counted along its own conversation. A token attends to its node
    up to itself and to ``ancestors``, the intervals of the turns before. ``loss`` marks
    assistant turns. ``ids`` are little-endian unsigned 32-bit values.

    Sorting by path is depth-first order. The order is cut into ranges, so a tree may hold
    any share of all nodes; the tokens and the open path of each range reach the driver
    and are broadcast: one row per range, as long as its deepest path.
    """
    nodes = paths.groupBy("node").agg(*[F.first(c).alias(c) for c in ("depth", "path", "role", "text")])
    nodes = settle(spark, _tokenized(nodes, tokenizer_path), "turns")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = nodes.select("node", "depth", "path", "length").repartitionByRange(parts, "path", "node")
    scan = settle(spark, order.sortWithinPartitions("path", "node").mapInPandas(_emitted, _SCAN), "offsets")

    base, open_path, ranges = 0, [], []
    for row in scan.where("node is null").orderBy("part").collect():
        ranges.append((row["part"], base, open_path[:row["start"]]))
        if row["total"]:
            inside = [(base + s["start"], base + s["end"]) for s in row["above"]]
            open_path = open_path[:row["inherited"]] + inside
        base += row["total"]
    ranges = F.broadcast(spark.createDataFrame(ranges, f"part int, base long, open {_SPANS}"))

    scan = scan.where("node is not null").join(ranges, "part")
    inherited = F.slice("open", F.lit(1), F.col("inherited"))
    shifted = F.transform("above", lambda s: F.struct(
        (s["start"] + F.col("base")).alias("start"), (s["end"] + F.col("base")).alias("end")))
    before = F.aggregate(inherited, F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    scan = scan.select(F.col("node").alias("__node"), (F.col("base") + F.col("start")).alias("start"),
                       (before + F.col("position")).alias("position"), F.concat(inherited, shifted).alias("ancestors"))
    return nodes.join(scan, F.col("node") == F.col("__node")).select(
        "node", "depth", "role", (F.col("role") == "assistant").alias("loss"), "ids", "start", "length", "position",
        "ancestors")


def chat_tree(spark: SparkSession, conversations: DataFrame, tokenizer_path: str) -> tuple[DataFrame, DataFrame]:
    """The tree of all conversations (see ``prefix_tree``) and ``conv_id, node``: the last turn of each conversation.

    ``conversations`` has ``conv_id, turn, role, text``; a conversation is its rows by turn,
    then role and text, so repeated rows are turns of their own. Null roles and texts
    count as empty, null ids are one conversation. Other columns are ignored, an empty
    table gives two empty tables.
    """
    paths = settle(spark, conversation_paths(conversations), "paths")
    tree = settle(spark, prefix_tree(spark, paths, tokenizer_path), "tree")
    return tree, paths.where("last").select("conv_id", "node")


def read_back(tree: DataFrame, nodes: DataFrame, tokenizer_path: str) -> DataFrame:
    """``node, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from the tree's tokens alone.

    For each distinct node of ``nodes`` the tokens of its ancestor intervals and its own
    are put together by position and decoded; the turns are parsed from that text.
    """
    ends = tree.join(nodes.select(F.col("node").alias("__n")).distinct(), F.col("node") == F.col("__n"))
    starts = F.concat(F.col("ancestors.start"), F.array("start"))
    wanted = ends.select(F.col("node").alias("end"), F.explode(starts).alias("at"))
    pieces = wanted.join(tree.select("start", "position", "loss", "ids"), F.col("at") == F.col("start"))
    whole = pieces.groupBy("end").agg(F.sort_array(F.collect_list(F.struct("position", "loss", "ids"))).alias("p"))
    whole = whole.select("end", F.col("p.ids").alias("ids"), F.col("p.loss").alias("loss"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load(tokenizer_path)
        for batch in batches:
            rows = []
            for node, parts, masks in zip(batch["end"].tolist(), batch["ids"].tolist(), batch["loss"].tolist(),
                                          strict=True):
                texts = tokenizer.decode_batch(
                    [np.frombuffer(part, dtype="<u4").tolist() for part in parts], skip_special_tokens=False)
                turns = [turn for text in texts for turn in read_turns(text)]
                digest, loss = hashlib.sha256(), []
                for (role, text, marked), mask in zip(turns, masks, strict=True):
                    digest.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    if mask != marked:
                        raise ValueError("the loss mask disagrees with the turns")
                    if mask:
                        loss.append(text)
                under = "".join(loss)
                rows.append((node, len(turns), digest.hexdigest(), len(under),
                             hashlib.sha256(under.encode("utf-8", "surrogatepass")).hexdigest(),
                             sum(map(len, texts))))
            yield pd.DataFrame(rows, columns=["node", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                              "formatted_chars"])

    return whole.mapInPandas(work, "node binary, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")
