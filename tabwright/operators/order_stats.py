"""Exact percentiles with linear interpolation, for columns of any size.

Spark's ``percentile`` keeps one entry per distinct value in a single task. That is right while the
distinct values are few. For other columns a sketch brackets the wanted ranks, a counting scan
makes the brackets exact, and only the rows between them are looked at. Scans carry counters and
sketches, never the column itself.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.columns import name

DIRECT_LIMIT = 10_000       # distinct values that one percentile aggregate may hold
BRACKET_LIMIT = 1_000_000   # rows between the brackets that may be sorted together
SKETCH_ACCURACY = 2_000
SLACK = 3.0 / SKETCH_ACCURACY


@dataclass
class _Search:
    """Two neighbouring ranks of one column and the closed value range known to hold both."""

    column: str
    lower: int
    upper: int
    rows: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    settled: bool = False

    def inside(self) -> Column:
        value = _value(self.column)
        condition = value.isNotNull()
        if self.low is not None:
            condition = condition & (value >= F.lit(self.low))
        if self.high is not None:
            condition = condition & (value <= F.lit(self.high))
        return F.when(condition, value)

    def bracket(self) -> list[float]:
        """Shares of the range between which the ranks are expected."""
        last = max(self.rows - 1, 1)
        return [max(0.0, (self.lower - self.below) / last - SLACK),
                min(1.0, (self.upper - self.below) / last + SLACK)]

    def narrow(self, low: float, high: float, below: int, upto: int) -> None:
        """Take over a bracket as far as its exact counts confirm it."""
        before, end = self.rows, self.below + self.rows
        if below <= self.lower:
            self.low, self.below = low, below
        if upto > self.upper:
            self.high, end = high, upto
        self.rows = end - self.below
        # A range that stops shrinking consists of ties: few distinct values are left in it.
        self.settled = self.low == self.high or self.rows > before // 2


def _value(column: str) -> Column:
    value = name(column).cast("double")
    return F.when(~F.isnan(value), value + F.lit(0.0))


def _sketch(value: Column, shares: Sequence[float]) -> Column:
    return F.percentile_approx(value, list(shares), SKETCH_ACCURACY)


def _narrow_all(df: DataFrame, searches: Sequence[_Search],
                brackets: Sequence[Sequence[float]]) -> None:
    counters = [m for i, (s, (low, high)) in enumerate(zip(searches, brackets)) for m in (
        F.count_if(_value(s.column) < F.lit(low)).alias(f"b{i}"),
        F.count_if(_value(s.column) <= F.lit(high)).alias(f"u{i}"))]
    counts = df.agg(*counters).first()
    for i, (s, (low, high)) in enumerate(zip(searches, brackets)):
        s.narrow(low, high, counts[f"b{i}"], counts[f"u{i}"])


def _read_off(df: DataFrame, searches: Sequence[_Search]) -> list[tuple[float, float]]:
    """Values at both ranks of each search, from the value counts inside its range."""
    values = [s.inside() for s in searches]
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), v.alias("v"))
                                for i, v in enumerate(values)]))
    # Few rows lie in any range: drop the others before the cells are laid out.
    held = df.where(F.coalesce(*values).isNotNull())
    counted = (held.select(cells.alias("c")).select("c.*").where("v is not null")
               .groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")))
    lower = F.get(F.array(*[F.lit(s.lower - s.below) for s in searches]), F.col("i"))
    upper = F.get(F.array(*[F.lit(s.upper - s.below) for s in searches]), F.col("i"))
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("v"))

    def holds(rank: Column) -> Column:
        return (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)

    hits = (counted.withColumn("upto", upto)
            .groupBy("i").agg(F.max(F.when(holds(lower), F.col("v"))).alias("a"),
                              F.max(F.when(holds(upper), F.col("v"))).alias("b")).collect())
    found = {r.i: (r.a, r.b) for r in hits}
    return [found[i] for i in range(len(searches))]


def exact_percentiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float],
                      direct_limit: int = DIRECT_LIMIT,
                      bracket_limit: int = BRACKET_LIMIT) -> dict[str, list[float | None]]:
    """Exact interpolated percentiles of the present values of each column.

    The limits bound what one task may hold; they change the way, never the result.
    """
    columns = list(columns)
    if not columns:
        return {}
    ends = [e for p in shares for e in (max(0.0, p - SLACK), min(1.0, p + SLACK))]
    first = df.agg(*[m for i, c in enumerate(columns) for m in (
        F.count(_value(c)).alias(f"n{i}"), F.approx_count_distinct(_value(c)).alias(f"d{i}"))]).first()
    counts = {c: first[f"n{i}"] for i, c in enumerate(columns)}
    result: dict[str, list[float | None]] = {c: [None] * len(shares) for c in columns}
    # The distinct estimate is within a few percent; 1.2 leaves room for its error.
    direct = [c for i, c in enumerate(columns)
              if counts[c] and min(counts[c], 1.2 * first[f"d{i}"]) <= direct_limit]
    present = [c for c in columns if counts[c]]
    if not present:
        return result
    # Sketches cost far more than counters: only the columns that are searched get one.
    row = df.agg(*[(F.percentile(_value(c), [float(p) for p in shares]) if c in direct
                    else _sketch(_value(c), ends)).alias(f"p{i}")
                   for i, c in enumerate(present)]).first()
    searches, brackets = [], []
    for i, c in enumerate(present):
        if c in direct:
            result[c] = list(row[f"p{i}"])
            continue
        for j, p in enumerate(shares):
            position = p * (counts[c] - 1)
            searches.append(_Search(c, math.floor(position), math.ceil(position), counts[c]))
            brackets.append(row[f"p{i}"][2 * j:2 * j + 2])
    if not searches:
        return result
    _narrow_all(df, searches, brackets)
    while todo := [s for s in searches if not s.settled and s.rows > bracket_limit]:
        row = df.agg(*[_sketch(s.inside(), s.bracket()).alias(f"s{i}")
                       for i, s in enumerate(todo)]).first()
        _narrow_all(df, todo, [row[f"s{i}"] for i in range(len(todo))])
    values = iter(_read_off(df, searches))
    for c in columns:
        if counts[c] and c not in direct:
            result[c] = []
            for p in shares:
                low, high = next(values)
                position = p * (counts[c] - 1)
                result[c].append(low + (high - low) * (position - math.floor(position)))
    return result


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_percentiles(df, columns, [0.5]).items()}
