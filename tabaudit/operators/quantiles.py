"""Exact, linearly interpolated quantiles without gathering a column in one task.

Up to a checked row count, equal values of a column are counted and the counts
are summed up in value order. Beyond it, quantiles of a sample bracket each
wanted rank, one counting pass checks that the rank lies inside its bracket, and
brackets are narrowed until few values are left; only those are shuffled. The first
narrowing is a column-pruned scan with aggregation buffers of fixed size; further
ones read only the values inside the brackets, which are written once per round.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from tabaudit.functions.values import present
from tabaudit.operators.cleaning import quoted, running
from tabaudit.session import materialize

# Rows of a column up to which all of its values may be sorted by one task.
DIRECT_LIMIT = 1_000_000
# Values a bracket may hold before it is narrowed again.
BRACKET_LIMIT = 1_000_000
# Rows that are sampled to place brackets; sqrt(n) where that is more.
SAMPLE_ROWS = 100_000
# Rank error of the quantiles of a sample is 1 / SKETCH_ACCURACY.
SKETCH_ACCURACY = 10_000


@dataclass(frozen=True)
class _Bracket:
    """Values between which the wanted rank lies, with counts below and inside."""

    column: str
    prob: float
    lower_rank: int
    fraction: float
    low: float
    high: float
    below: int
    inside: int

    @property
    def upper_rank(self) -> int:
        return self.lower_rank + (1 if self.fraction > 0 else 0)

    @property
    def range(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high

    def covers(self) -> bool:
        return self.below <= self.lower_rank and self.upper_rank < self.below + self.inside


def value_column(df: DataFrame, name: str) -> Column:
    return present(quoted(name), df.schema[name].dataType).cast("double")


def column_bounds(df: DataFrame, columns: Sequence[str]):
    """Non-null count, minimum and maximum per column, in one pass."""
    if not columns:
        return {}
    aggs = []
    for i, name in enumerate(columns):
        v = value_column(df, name)
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}")]
    row = df.agg(*aggs).first()
    return {name: (row[f"n{i}"], row[f"l{i}"], row[f"h{i}"]) for i, name in enumerate(columns)}


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    bounds: dict[str, tuple[int, float | None, float | None]] | None = None,
    direct_limit: int = DIRECT_LIMIT,
    bracket_limit: int = BRACKET_LIMIT,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(column, prob, value); ``bounds`` may pass in known (count, min, max) per column."""
    if bounds is None:
        bounds = column_bounds(df, columns)
    brackets, empty = [], []
    for name in columns:
        n, low, high = bounds[name]
        for prob in probs:
            if not n:
                empty.append((name, float(prob), None))
                continue
            position = prob * (n - 1)
            rank = math.floor(position)
            brackets.append(_Bracket(name, prob, rank, position - rank, low, high, 0, n))
    if any(b.inside > direct_limit for b in brackets):
        brackets = _narrow(df, brackets, bracket_limit, sample_rows)
    return _select(df, brackets, empty)


def _inside(df: DataFrame, bounds: tuple[str, float, float]) -> Column:
    name, low, high = bounds
    v = value_column(df, name)
    return F.when((v >= low) & (v <= high), v)


def _values_inside(df: DataFrame, brackets: list[_Bracket]) -> DataFrame:
    """Per column the values inside its brackets, else null; rows without any are left out."""
    ranges: dict[str, list[tuple]] = {}
    for b in brackets:
        ranges.setdefault(b.column, []).append(b.range)
    kept = [
        F.coalesce(*[_inside(df, r) for r in dict.fromkeys(own)]).alias(name)
        for name, own in ranges.items()
    ]
    inside = df.select(*kept)
    return materialize(inside.dropna("all"), "bracket_values")


def _narrow(
    df: DataFrame, brackets: list[_Bracket], limit: int, sample_rows: int
) -> list[_Bracket]:
    def too_wide(b: _Bracket) -> bool:
        return b.inside > limit and b.low < b.high

    wide, done = [b for b in brackets if too_wide(b)], [b for b in brackets if not too_wide(b)]
    slack = 1.0
    while wide:
        tried = _sampled_bounds(df, wide, sample_rows, slack)
        counts = df.agg(
            *[
                agg
                for i, t in enumerate(tried)
                for agg in (
                    F.count_if(_inside(df, wide[i].range) < t.low).alias(f"b{i}"),
                    F.count(_inside(df, t.range)).alias(f"n{i}"),
                )
            ]
        ).first()
        still, missed = [], False
        for i, (old, new) in enumerate(zip(wide, tried)):
            new = replace(new, below=old.below + counts[f"b{i}"], inside=counts[f"n{i}"])
            if not new.covers():
                # The sample missed the rank: keep the old bracket, look wider next time.
                still.append(old)
                missed = True
            elif too_wide(new) and new.inside < old.inside:
                still.append(new)
            else:
                # Small enough, a single value, or a few values that repeat a lot.
                done.append(new)
        slack = slack * 4 if missed else slack
        wide = still
        if wide:
            # Further rounds read only the values that can still matter.
            df = _values_inside(df, wide)
    return done


def _sampled_bounds(
    df: DataFrame, wide: list[_Bracket], sample_rows: int, slack: float
) -> list[_Bracket]:
    """New bounds a little below and above each wanted rank, from quantiles of a sample.

    The margin is five standard errors of a sampled rank plus the sketch's error.
    Brackets over the same values share one sketch.
    """
    smallest = min(b.inside for b in wide)
    rows = max(sample_rows, math.isqrt(smallest))
    fraction = min(1.0, rows / smallest)
    source = df if fraction == 1.0 else df.sample(fraction, seed=17)
    probs: dict[tuple, list[float]] = {}
    spots = []
    for b in wide:
        p = (b.lower_rank - b.below) / (b.inside - 1)
        sampled = max(1.0, b.inside * fraction)
        margin = slack * (2 / SKETCH_ACCURACY + 5 * math.sqrt(p * (1 - p) / sampled) + 1 / sampled)
        share = probs.setdefault(b.range, [])
        spots.append((b.range, len(share)))
        share += [max(0.0, p - margin), min(1.0, p + margin)]
    ranges = list(probs)
    row = source.agg(
        *[
            F.percentile_approx(_inside(df, r), probs[r], SKETCH_ACCURACY).alias(f"e{i}")
            for i, r in enumerate(ranges)
        ]
    ).first()
    out = []
    for b, (r, at) in zip(wide, spots):
        edges = row[f"e{ranges.index(r)}"]
        # At the ends of the scale the sample says nothing, the old bound does.
        low = b.low if not edges or probs[r][at] == 0.0 else edges[at]
        high = b.high if not edges or probs[r][at + 1] == 1.0 else edges[at + 1]
        out.append(replace(b, low=low, high=high))
    return out


def _select(df: DataFrame, brackets: list[_Bracket], empty: list[tuple]) -> DataFrame:
    """Values at the wanted ranks: counts of equal values, summed up in value order.

    A range is sorted by one task; it holds few distinct values by construction.
    """
    spark = df.sparkSession
    blank = spark.createDataFrame(empty, "column string, prob double, value double")
    if not brackets:
        return blank
    ranges = sorted({b.range for b in brackets})
    hits = F.array(
        *[F.struct(F.lit(i).alias("i"), _inside(df, r).alias("v")) for i, r in enumerate(ranges)]
    )
    counted = (
        df.select(F.inline(hits))
        .filter("v IS NOT NULL")
        .groupBy("i", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # One row per bracket: columns times probabilities, so it is small by construction.
    facts = spark.createDataFrame(
        [
            (
                ranges.index(b.range),
                b.column,
                float(b.prob),
                b.lower_rank - b.below,
                b.upper_rank - b.below,
                b.fraction,
            )
            for b in brackets
        ],
        "i int, column string, prob double, lo long, hi long, frac double",
    )
    counted = counted.withColumn("upto", F.sum("n").over(running(["i"], "v")))
    at_lo, at_hi = (
        (F.col(r) < F.col("upto")) & (F.col(r) >= F.col("upto") - F.col("n")) for r in ("lo", "hi")
    )
    a, b = F.max(F.when(at_lo, F.col("v"))), F.max(F.when(at_hi, F.col("v")))
    # Only the one or two rows at a wanted rank leave the join.
    out = (
        counted.join(F.broadcast(facts.withColumnRenamed("i", "j")), (F.col("i") == F.col("j")) & (at_lo | at_hi))
        .groupBy("column", "prob")
        .agg((a + F.max("frac") * (b - a)).alias("value"))
    )
    return out.unionByName(blank) if empty else out
