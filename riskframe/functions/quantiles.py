"""Exact quantiles with linear interpolation, for tables of any size, in two scans of most.

Spark's ``percentile`` keeps every distinct value in one aggregation buffer. Here a
mergeable KLL sketch brackets each wanted rank in the first scan. The second scan takes out the
values inside the brackets and counts what lies outside, which proves that a bracket
holds its rank. Brackets that hold too many values for a task are sketched again inside.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted, to_long

# Brackets that hold no more rows than this are ranked.
RANKED_ROWS = 100_000
#: Size of a sketch (some 100 KB), and how far its ranks may be off, as a share of the rows. That share is generous,
#: and a bracket that misses its rank is found out and widened.
SKETCH_SIZE, SLACK = 4096, 0.004


@dataclass
class _Bracket:
    """Where the values at 0-based ranks ``low`` and ``high`` are looked for; ``outer`` is known to hold them."""

    column: str
    low: int
    high: int
    start: float = -math.inf
    end: float = math.inf
    #: Rows expected inside.
    expected: float = math.inf
    slack: float = SLACK
    outer: tuple[float, float, int, int] = (-math.inf, math.inf, 0, 0)

    def prove(self, below: int, inside: int) -> bool:
        """Whether the bracket holds its ranks; if so it becomes the outer one, else the outer one is tried wider."""
        if below <= self.low and self.high < below + inside:
            self.outer = (self.start, self.end, below, inside)
            return True
        self.widen()
        return False

    def widen(self) -> None:
        self.slack *= 8
        self.start, self.end, _, self.expected = self.outer

    def points(self) -> list[float]:
        """Where the ranks lie inside the outer bracket, as shares, with the slack."""
        _, _, below, inside = self.outer
        return [max(0.0, (self.low - below) / inside - self.slack), min(1.0, (self.high + 1 - below) / inside + self.slack)]

    def aim(self, start: float, end: float) -> None:
        self.start, self.end = start, end
        self.expected = 0 if start == end else 2 * self.slack * self.outer[3] + 1


def _value(column: str) -> Column:
    return F.col(quoted(column)).cast("double")


def _inside(b: _Bracket) -> Column:
    value = _value(b.column)
    return value.isNotNull() & (value >= F.lit(b.start)) & (value <= F.lit(b.end))


def _counts(spans: Iterable[list[_Bracket]]) -> list[Column]:
    out = []
    for i, members in enumerate(spans):
        out += [F.count_if(_value(members[0].column) < F.lit(members[0].start)).alias(f"b{i}"),
                F.count_if(_inside(members[0])).alias(f"n{i}")]
    return out


def _by_span(brackets: Iterable[_Bracket]) -> dict[tuple[str, float, float], list[_Bracket]]:
    spans: dict[tuple[str, float, float], list[_Bracket]] = {}
    for b in brackets:
        spans.setdefault((b.column, b.start, b.end), []).append(b)
    return spans


def sketched_brackets(columns: Sequence[str], probs: Sequence[float], prefix: str = "__kll") -> list[Column]:
    """Aggregates for the scan that reads the columns anyway: values around each quantile, per column."""
    points = F.array(*[F.lit(float(min(1.0, max(0.0, p + side)))) for p in probs for side in (-SLACK, SLACK)])
    out = []
    for i, c in enumerate(columns):
        sketch = F.kll_sketch_agg_double(_value(c), F.lit(SKETCH_SIZE))
        out.append(F.when(F.count(_value(c)) > 0, F.kll_sketch_get_quantile_double(sketch, points)).alias(f"{prefix}{i}"))
    return out


def _narrow(df: DataFrame, brackets: list[_Bracket]) -> None:
    """One scan that proves brackets and sketches what is inside them, for narrower ones."""
    spans = list(_by_span(brackets).values())
    sketches = [F.kll_sketch_agg_double(F.when(_inside(m[0]), _value(m[0].column)), F.lit(SKETCH_SIZE)).alias(f"s{i}")
                for i, m in enumerate(spans)]
    row = df.agg(*_counts(spans), *sketches).first()
    found, wanted = [], []
    for i, members in enumerate(spans):
        for b in members:
            if b.prove(row[f"b{i}"], row[f"n{i}"]):
                found.append(b)
                points = F.array(*[F.lit(p) for p in b.points()])
                wanted.append(F.kll_sketch_get_quantile_double(F.lit(row[f"s{i}"]), points).alias(f"q{len(wanted)}"))
    if found:
        values = df.sparkSession.range(1).select(*wanted).first()
        for b, (start, end) in zip(found, values, strict=True):
            if (start, end) == (b.start, b.end):
                b.expected = 0  # as narrow as it gets: the inside is few distinct values
            else:
                b.aim(start, end)


def _intervals(brackets: Iterable[_Bracket]) -> dict[str, list[list[float]]]:
    """The brackets of each column in order, those that overlap as one."""
    out: dict[str, list[list[float]]] = {}
    for b in sorted(brackets, key=lambda b: (b.column, b.start)):
        own = out.setdefault(b.column, [])
        if own and b.start <= own[-1][1]:
            own[-1][1] = max(own[-1][1], b.end)
        else:
            own.append([b.start, b.end])
    return out


def _clamped(column: str, intervals: list[list[float]]) -> Column:
    """The value itself inside the intervals, elsewhere one value that stands for all between two of them."""
    value, out, last = _value(column), None, -math.inf
    for start, end in intervals:
        gap = last if last == -math.inf else math.nextafter(last, math.inf)
        out = (F if out is None else out).when(value < F.lit(start), F.lit(gap)).when(value <= F.lit(end), value)
        last = end
    return out.when(value.isNotNull(), F.lit(math.inf))


def _extract(df: DataFrame, brackets: list[_Bracket]) -> dict[tuple[str, int], float]:
    """One scan that takes out what is inside the brackets; the values of the ranks that they hold.

    What lies outside is counted too, under one value for each gap, so ranks come out right, and a rank
    that falls into a gap shows that its bracket missed it.
    """
    spans = _intervals(brackets)
    names = list(spans)
    # One column per column, then one row per value, all inside generated code.
    wide = df.select(*[_clamped(c, spans[c]).alias(str(i)) for i, c in enumerate(names)])
    counted = to_long(wide, wide.columns, as_type="double", name="span").where("value is not null").groupBy(
        "span", "value").agg(F.count(F.lit(1)).alias("n"))
    wanted, ranks = F.lit(False), {}
    for b in brackets:
        for rank in (b.low, b.high):
            span = str(names.index(b.column))
            if (span, rank) not in ranks:
                wanted = wanted | ((F.col("span") == span) & (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank))
            ranks[span, rank] = b.column
    # Values are distinct here, and a frame of rows is cheaper than one of values.
    window = Window.partitionBy("span").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    found: dict[tuple[str, int], float] = {}
    for r in counted.withColumn("upto", F.sum("n").over(window)).where(wanted).collect():
        for (span, rank), column in ranks.items():
            if r["span"] == span and r["upto"] - r["n"] <= rank < r["upto"] and any(
                    start <= r["value"] <= end for start, end in spans[column]):
                found[column, rank] = r["value"]
    for b in brackets:
        if (b.column, b.low) not in found or (b.column, b.high) not in found:
            b.widen()
    return found


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    counts: dict[str, int] | None = None,
    ranked_rows: int = RANKED_ROWS,
    around: dict[str, list[float] | None] | None = None,
) -> dict[str, list[float | None]]:
    """``{column: [quantile per prob]}`` over non-missing values.

    ``counts`` (values per column) and ``around`` (of ``sketched_brackets`` with the same
    ``probs``) save the first scan when the caller has them from one of its own. NaN must have been turned into
    NULL before.
    """
    if not columns:
        return {}
    if counts is None or around is None:
        row = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(columns)],
                     *sketched_brackets(columns, probs)).first()
        counts = {c: row[f"n{i}"] for i, c in enumerate(columns)}
        around = {c: row[f"__kll{i}"] for i, c in enumerate(columns)}

    brackets: dict[tuple[str, float], _Bracket] = {}
    for c in columns:
        for k, p in enumerate(probs):
            if counts[c]:
                low = math.floor(p * (counts[c] - 1))
                b = _Bracket(c, low, min(low + 1, counts[c] - 1))
                b.outer = (-math.inf, math.inf, 0, counts[c])
                # The slack also covers that ranks are whole numbers, but for the smallest tables.
                if counts[c] * SLACK > 2:
                    b.aim(*around[c][2 * k:2 * k + 2])
                else:
                    b.expected = counts[c]
                brackets[c, p] = b

    found: dict[tuple[str, int], float] = {}
    left = list(brackets.values())
    while left:
        large = [b for b in left if b.expected > ranked_rows]
        while large:
            _narrow(df, large)
            large = [b for b in large if b.expected > ranked_rows and b.start < b.end]
        found.update(_extract(df, left))
        left = [b for b in left if (b.column, b.low) not in found or (b.column, b.high) not in found]

    result: dict[str, list[float | None]] = {}
    for c in columns:
        values: list[float | None] = []
        for p in probs:
            b = brackets.get((c, p))
            if b is None:
                values.append(None)
                continue
            low, high = found[c, b.low], found[c, b.high]
            values.append(low + (high - low) * (p * (counts[c] - 1) - b.low))
        result[c] = values
    return result
