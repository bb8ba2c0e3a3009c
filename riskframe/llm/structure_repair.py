"""Repair of conversation structure: cheapest edits by Four-Russians tables over blocks of rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import ROW, settle, with_row_keys

#: Rows of a block.
BLOCK = 4
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: Kinds of rows: kept initials, in capitals if the text is truncated, ``o`` any other role, ``x`` must go.
SYMBOLS = "uasoUASOx"
_SPACE = " \t\n\x0b\x0c\r"

#: What the repaired roles so far end in: nothing, a system row, a user row, an assistant row. A
#: conversation may end in the first and the last.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_NEXT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A,
         (AFTER_A, "u"): AFTER_U}
#: The role that may be made (inserted or reroled) after each of them.
_MADE = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
_FAR = 1 << 20

Vector = tuple[int, int, int, int]


# ---- costs to go and their tables -------------------------------------------------------------


def _with_inserts(base: list[int]) -> Vector:
    """Costs to go when rows may be inserted first."""
    u = min(base[AFTER_U], INSERT + base[AFTER_A])
    a = min(base[AFTER_A], INSERT + base[AFTER_U])
    return min(base[START], INSERT + u), min(base[AFTER_S], INSERT + u), u, a


END = _with_inserts([0, _FAR, _FAR, 0])


def _moves(state: int, symbol: str) -> list[tuple[str, int, int]]:
    """Edits of a row in ASCII order: letter, cost, next state."""
    out = [("D", DELETE, state)]
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        kept = _NEXT.get((state, symbol.lower()))
        if kept is not None:
            out.append(("K", extra, kept))
        out.append(("R", REROLE + extra, _NEXT[state, _MADE[state]]))
    return out


def _before(after: Vector, symbol: str) -> Vector:
    """Costs to go in front of a row, from those behind it."""
    return _with_inserts([min(cost + after[to] for _, cost, to in _moves(state, symbol)) for state in range(4)])


class Tables:
    """Normalised cost vectors and, for every block of ``block`` symbols, what it makes of each of them.

    Vectors are normalised by their smallest entry. From the vector of the end only a few can
    be reached, so ``to[vector, block]`` and ``adds[vector, block]`` are finite tables.
    """

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors: list[Vector] = [END]
        index = {END: 0}
        to, adds = [], []
        for vector in self.vectors:  # grows while it is read
            steps = [_before(vector, c) for c in SYMBOLS]
            lows = [min(s) for s in steps]
            normal = [tuple(x - low for x in s) for s, low in zip(steps, lows, strict=True)]
            for v in normal:
                if v not in index:
                    index[v] = len(self.vectors)
                    self.vectors.append(v)
            to.append([index[v] for v in normal])
            adds.append(lows)
        self.one_to, self.one_adds = np.array(to), np.array(adds)
        self.to, self.adds = self.one_to, self.one_adds
        for _ in range(block - 1):  # a row in front of shorter blocks
            behind, cost = self.to[:, None, :], self.adds[:, None, :]
            first = np.arange(len(SYMBOLS))[None, :, None]
            self.to, self.adds = (
                self.one_to[behind, first].reshape(len(self.vectors), -1),
                (cost + self.one_adds[behind, first]).reshape(len(self.vectors), -1))
        self._traced: dict[tuple[str, int, int], tuple[list[str], int]] = {}

    def cut(self, symbols: str) -> tuple[str, np.ndarray]:
        """The rows before the first whole block, and the numbers of the blocks."""
        head = len(symbols) % self.block
        codes = _CODE[np.frombuffer(symbols[head:].encode("ascii"), dtype=np.uint8)].reshape(-1, self.block)
        return symbols[:head], codes @ (len(SYMBOLS) ** np.arange(self.block)[::-1])

    def back(self, symbols: str, vector: int) -> tuple[int, int, list[int]]:
        """The vector in front of the rows, what they cost at least, and the vector behind each block."""
        head, blocks = self.cut(symbols)
        total, behind = 0, []
        for block in blocks[::-1].tolist():
            behind.append(vector)
            total += int(self.adds[vector, block])
            vector = int(self.to[vector, block])
        for symbol in head[::-1]:
            at = SYMBOLS.index(symbol)
            total += int(self.one_adds[vector, at])
            vector = int(self.one_to[vector, at])
        return vector, total, behind[::-1]

    def expand(self, rows: str, vector: int, state: int) -> tuple[list[str], int]:
        """The ASCII-least cheapest edits of a few rows, given the vector behind them, and the state they end in.

        Expands the rows backward to the costs to go between them, then walks forward, taking the
        first letter that loses nothing. A letter fixes the next state, so no tie stays open. Each
        row's edits: ``u`` and ``a`` insert a row before it, ``U`` and ``A`` rerole it.
        """
        known = self._traced.get((rows, vector, state))
        if known is None:
            costs = [self.vectors[vector]]
            for symbol in reversed(rows):
                costs.append(_before(costs[-1], symbol))
            costs.reverse()
            out, now = [], state
            for i, symbol in enumerate(rows):
                edits = ""
                while True:
                    left = costs[i][now]
                    made = _NEXT[now, _MADE[now]]
                    moves = [*_moves(now, symbol), ("I", INSERT, None)]
                    letter, to = next((c, t) for c, cost, t in sorted(moves, key=lambda m: m[0])
                                      if cost + (costs[i][made] if t is None else costs[i + 1][t]) == left)
                    if to is None:
                        edits += _MADE[now]
                        now = made
                        continue
                    out.append(edits + (_MADE[now].upper() if letter == "R" else letter))
                    now = to
                    break
            known = self._traced[rows, vector, state] = out, now
        return known

    def trace(self, symbols: str, vector: int, state: int, last: bool) -> tuple[list[str], int]:
        """Each row's edits, and the state behind them; ``last`` adds what must follow the last row."""
        head, _ = self.cut(symbols)
        front, _, behind = self.back(symbols[len(head):], vector)
        out, state = self.expand(head, front, state)
        out = list(out)
        for i, right in enumerate(behind):
            at = len(head) + i * self.block
            edits, state = self.expand(symbols[at:at + self.block], right, state)
            out += edits
        if last and out:
            while state not in (START, AFTER_A):
                out[-1] += _MADE[state]
                state = _NEXT[state, _MADE[state]]
        return out, state


_CODE = np.zeros(256, dtype=np.int64)
for _i, _c in enumerate(SYMBOLS):
    _CODE[ord(_c)] = _i


@lru_cache(maxsize=None)
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


def cost_of(symbols: str, edits: list[str]) -> int:
    total = 0
    for symbol, letters in zip(symbols, edits, strict=True):
        total += INSERT * sum(c in "ua" for c in letters) + DELETE * ("D" in letters)
        total += REROLE * ("U" in letters or "A" in letters)
        total += TRUNCATED * (symbol.isupper() and "D" not in letters)
    return total


def illegal_pairs(initials: str) -> int:
    return sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:], strict=False))


# ---- rows --------------------------------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by ``crc32(conv_id:turn) % 20``, as a test input for repair.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it a
    user row. Nulls count as one space. Other columns are dropped.
    """
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":")
                      for c in ("conv_id", ":", "turn")])
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(name) % 20).alias("__kind"))
    kind = F.col("__kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("__copy")).drop("__copy")


def _initial(role: Column) -> Column:
    letter = F.substring(role, 1, 1)
    return F.when(letter.isin("u", "a", "s"), letter).otherwise("o")


def _same(one: str, other: str) -> Column:
    return F.col(one).eqNullSafe(F.col(other))


def _ordered(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows without texts in order of conversation and turn, with their faults and the range they lie in."""
    solid = F.rtrim(F.col("text"), F.lit(_SPACE))
    slim = rows.select(
        ROW, "conv_id", "turn", F.md5(F.concat_ws("\x00", "role", "text")).alias("said"),
        _initial(F.col("role")).alias("initial"), (solid == "").alias("blank"),
        (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("open"))
    seen = slim.groupBy(F.col("conv_id").alias("__conv"), F.col("said").alias("__said")).agg(
        F.min(F.struct("turn", ROW))[ROW].alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    slim = slim.join(seen, _same("conv_id", "__conv") & (F.col("said") == F.col("__said")), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first") != F.col(ROW), "duplicate").when(
        F.col("open"), "truncated")
    symbol = F.when(fault.isin("blank", "duplicate"), "x").when(fault == "truncated", F.upper("initial")).otherwise(
        F.col("initial"))
    slim = slim.select(ROW, "conv_id", "turn", "initial", fault.alias("fault"), symbol.alias("symbol"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["conv_id", "turn", ROW]
    slim = slim.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return settle(spark, slim.withColumns({"part": F.spark_partition_id(), "seq": F.monotonically_increasing_id()}),
                  "ordered")


def _summary(symbols: pd.Series) -> pd.DataFrame:
    """What rows make of every vector behind them, and of every state before them."""
    known = tables()
    to, states = [], []
    for text in symbols:
        every = range(len(known.vectors))
        to.append([known.back(text, v)[0] for v in every])
        states.append([known.trace(text, v, s, False)[1] for v in every for s in range(4)])
    return pd.DataFrame({"to": to, "states": states})


def _composed(group: pd.DataFrame) -> pd.DataFrame:
    """The vector behind and the state before each range of one conversation, from the ranges' summaries."""
    group = group.sort_values("part").reset_index(drop=True)
    vectors, vector = [], 0
    for to in reversed(group["to"].tolist()):
        vectors.append(vector)
        vector = int(to[vector])
    vectors.reverse()
    states, state = [], START
    for own, v in zip(group["states"].tolist(), vectors, strict=True):
        states.append(state)
        state = int(own[4 * v + state])
    ends = [*group["head"].tolist()[1:], ""]
    cross = [int(bool(y) and x + y not in ("su", "ua", "au")) for x, y in zip(group["tail"], ends, strict=True)]
    last = [False] * (len(group) - 1) + [True]
    return pd.DataFrame({"key": group["key"], "part": group["part"], "vector": vectors, "state": states,
                         "last": last, "cross": cross})


def _traced(symbols: pd.Series, initials: pd.Series, vector: pd.Series, state: pd.Series, last: pd.Series) -> pd.DataFrame:
    known, out = tables(), []
    for text, heads, v, s, end in zip(symbols, initials, vector, state, last, strict=True):
        edits, _ = known.trace(text, int(v), int(s), bool(end))
        audit = "".join(edits).translate(_LETTERS)
        out.append((edits, audit, cost_of(text, edits), illegal_pairs(heads)))
    return pd.DataFrame(out, columns=["edits", "audit", "cost", "illegal"])


_LETTERS = str.maketrans("uaUA", "IIRR")


def repair(spark: SparkSession, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired rows and a report for each conversation of ``turns`` (``conv_id, turn, role, text``).

    Rows follow each other by turn, nulls first, rows of equal turn as they come. A row is blank,
    else a duplicate of an earlier role and text of its conversation, else truncated, else sound. The
    cheapest edits (keep 0, rerole 1, delete 2, insert 5, and 5 for each truncated row that stays; blank
    rows and duplicates must go) make the roles nothing or an optional system row and
    pairs of user and assistant; of equally cheap ones the ASCII-least letters count.

    Rows: ``conv_id, seq, step, edit, role, text``, in order of ``seq, step``; edits are ``K``, ``R``, ``I``.
    Reports: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    All rows are sorted by conversation into ranges, so a conversation may lie in many of
    them; only its kinds of rows, a letter each, meet in a range's task, and only ranges' summaries
    meet in one place (one for each range). Null roles and texts count as one space, a null conv_id
    is a conversation, repeated rows are rows. Other columns are ignored, an empty
    table gives empty results.
    """
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text"))
    summary = F.pandas_udf(_summary, "to array<int>, states array<int>")
    trace = F.pandas_udf(_traced, "edits array<string>, audit string, cost long, illegal long")
    rows = with_row_keys(spark, turns)
    slim = _ordered(spark, rows)

    own = F.sort_array(F.collect_list(F.struct("seq", ROW, "initial", "symbol")))
    ranges = slim.groupBy("conv_id", "part").agg(own.alias("rows"))
    ranges = ranges.select(
        "conv_id", "part", F.transform("rows", lambda r: F.struct(r["seq"].alias("seq"), r[ROW].alias(ROW))).alias("rows"),
        F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("symbols"),
        F.array_join(F.transform("rows", lambda r: r["initial"]), "").alias("initials"))
    ranges = settle(spark, ranges, "ranges")

    # Conversations over several ranges: at most one begins before each range, so there are few.
    split = ranges.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("key")).where("n > 1")
    split = split.select(F.col("conv_id").alias("__conv"), "key")
    long = ranges.join(F.broadcast(split), _same("conv_id", "__conv")).withColumn("s", summary("symbols"))
    long = long.select("key", "part", F.substring("initials", 1, 1).alias("head"),
                       F.substring("initials", -1, 1).alias("tail"), "s.to", "s.states")
    composed = long.groupBy("key").applyInPandas(
        _composed, "key int, part int, vector int, state int, last boolean, cross long")
    # The first range of a split conversation names it: it holds the head of no other one.
    composed = settle(spark, composed.select(F.col("key").alias("__key"), F.col("part").alias("__part"), "vector",
                                             "state", "last", "cross"), "composed")
    place = ranges.join(F.broadcast(split), _same("conv_id", "__conv"), "left").drop("__conv")
    place = place.join(F.broadcast(composed), (F.col("key") == F.col("__key")) & (F.col("part") == F.col("__part")), "left")
    traced = place.select("conv_id", "part", "rows", F.coalesce("cross", F.lit(0)).alias("cross"), trace(
        "symbols", "initials", F.coalesce("vector", F.lit(0)), F.coalesce("state", F.lit(START)),
        F.coalesce("last", F.lit(True))).alias("t"))
    traced = settle(spark, traced.select("conv_id", "part", "rows", "cross", "t.*"), "traced")

    audits = traced.groupBy("conv_id").agg(
        F.sum("cost").alias("cost"), F.sum(F.col("illegal") + F.col("cross")).alias("illegal"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "audit"))), lambda x: x["audit"]), "")
        .alias("audit"))
    faults = [F.sum((F.col("fault") == f).cast("long")).alias(f) for f in ("blank", "duplicate", "truncated")]
    counts = slim.groupBy("conv_id").agg(
        *[F.coalesce(f, F.lit(0)).alias(n) for f, n in zip(faults, ("blank", "duplicate", "truncated"), strict=True)],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    counts = counts.withColumnRenamed("conv_id", "__conv")
    reports = audits.join(counts, _same("conv_id", "__conv")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    steps = traced.select("conv_id", F.explode(F.arrays_zip("rows", "edits")).alias("r"))
    steps = steps.select(F.col("conv_id").alias("__conv"), F.col(f"r.rows.{ROW}").alias("__key"),
                         F.col("r.rows.seq").alias("seq"), F.posexplode(F.split("r.edits", "")).alias("step", "code"))
    steps = steps.where(~F.col("code").isin("D", ""))
    texts = rows.select(F.col(ROW).alias("__row_key"), "role", "text")
    repaired = steps.join(texts, F.col("__key") == F.col("__row_key"))
    code = F.col("code")
    role = F.when(code.isin("u", "U"), "user").when(code.isin("a", "A"), "assistant").otherwise(F.col("role"))
    repaired = repaired.select(
        F.col("__conv").alias("conv_id"), "seq", "step", F.translate(code, "uaUA", "IIRR").alias("edit"),
        role.alias("role"), F.when(code.isin("u", "a"), "").otherwise(F.col("text")).alias("text"))
    return repaired, reports


DIGESTS = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each conversation of sorted rows; rows pass through, none is held."""
    def out(ids: list, digests: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.string())], schema=DIGESTS)

    now, state = None, None
    for batch in batches:
        ids, digests = [], []
        for conv, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if state is not None and conv == now:
                state.update(b"\n")
            else:
                if state is not None:
                    ids.append(now)
                    digests.append(state.hexdigest())
                now, state = conv, hashlib.sha256()
            state.update(f"{role}:{text}".encode())
        yield out(ids, digests)
    if state is not None:
        yield out([now], [state.hexdigest()])


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of repaired rows: ``role:text`` of each, newlines between.

    A SHA-256 is computed in order, so the rows of one conversation stream through one task.
    """
    rows = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "step")
    return rows.select(F.col("conv_id").cast("long"), "role", "text").mapInArrow(
        _digest, "conv_id long, repaired_sha256 string")
