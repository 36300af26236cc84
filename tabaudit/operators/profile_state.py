"""Profiles of growing tables: one small state per partition and column, merged without the rows.

A state holds counts, mean, centred square sum, bounds and a KLL quantile sketch. States
of disjoint parts merge into that of their union, so a new partition costs one pass
over itself. Merged numbers equal those of one full pass; quantiles lie within the
sketch's rank error of the exact ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabaudit.operators.cleaning import numeric_columns, quoted
from tabaudit.operators.quantiles import value_column

# Values a sketch keeps on its lowest level; its size grows with it, not with the table.
SKETCH_K = 1000


def rank_error(k: int = SKETCH_K) -> float:
    """Difference, as a share of the rows, between a sketched and the true rank, at 99 % confidence."""
    # Published error of KLL sketches for one-sided ranks.
    return 2.296 / k**0.9723


def profile_states(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), k: int = SKETCH_K
) -> DataFrame:
    """One state per group of ``by`` and column, in one pass; null and NaN are missing."""
    names = list(columns if columns is not None else [c for c in numeric_columns(df) if c not in by])
    if not names:
        raise ValueError("no numeric columns to profile")
    states = []
    for name in names:
        v = value_column(df, name)
        n = F.count(v)
        states.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(F.lit(1)).alias("n_rows"),
                n.alias("n"),
                F.avg(v).alias("mean"),
                (F.var_pop(v) * n).alias("squares"),
                F.min(v).alias("low"),
                F.max(v).alias("high"),
                F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"),
            )
        )
    keys = [quoted(c) for c in by]
    return df.groupBy(*keys).agg(F.array(*states).alias("states")).select(*keys, F.inline("states"))


def merged(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of the unions: one per group of ``by`` and column.

    Square sums are taken about the mean of the union, which a first pass over the
    states finds; sketches are merged map-side and then once per task.
    """
    keys = [*by, "column"]
    means = states.groupBy(*map(quoted, keys)).agg(
        (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("centre")
    )
    same = F.lit(True)
    renamed = means.toDF(*[f"_{c}" for c in keys], "_centre")
    for c in keys:
        same = same & quoted(c).eqNullSafe(quoted(f"_{c}"))
    shift = F.col("mean") - F.col("_centre")
    return states.join(renamed, same).groupBy(*map(quoted, keys)).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n").alias("n"),
        F.first("_centre").alias("mean"),
        F.sum(F.col("squares") + F.col("n") * shift * shift).alias("squares"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def summary(states: DataFrame) -> DataFrame:
    """Rows, missing ones, mean, sample deviation and bounds per state."""
    kept = [quoted(c) for c in states.columns if c not in ("n", "squares", "low", "high", "sketch", "mean")]
    return states.select(
        *kept,
        F.col("n").alias("count"),
        (F.col("n_rows") - F.col("n")).alias("null_count"),
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).alias("std"),
        F.col("low").alias("min"),
        F.col("high").alias("max"),
    )


def sketched_quantiles(states: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column, prob, n, value) of each state; a column without values has null."""
    keys = [quoted(c) for c in states.columns if c not in ("n_rows", "n", "mean", "squares", "low", "high", "sketch")]
    found = [
        F.struct(
            F.lit(float(p)).alias("prob"),
            F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias("value"),
        )
        for p in probs
    ]
    return states.select(*keys, "n", F.inline(F.array(*found)))
