"""Metrics per demographic subgroup and the gaps between subgroups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabaudit.functions import rates
from tabaudit.functions.values import age_bin
from tabaudit.operators.cleaning import quoted
from tabaudit.operators.metrics import cells, confusion_counts
from tabaudit.operators.ranking import auc_from_sums, rank_sums

# Default dimensions, and rows a group needs to be reported.
DEFAULT_DIMENSIONS = ("sex", "race", "age")
MIN_GROUP_ROWS = 10


def dimensions_of(df: DataFrame, names: Sequence[str] = DEFAULT_DIMENSIONS) -> dict[str, Column]:
    """Group expression per listed column the table has; ages are binned."""
    return {
        c: age_bin(quoted(c)) if c == "age" else quoted(c).cast("string")
        for c in names
        if c in df.columns
    }


def by_dimension(
    df: DataFrame, dimensions: dict[str, Column], carry: Sequence[str]
) -> DataFrame:
    """One row per row and dimension: (dimension, group, carried columns); null groups drop out."""
    groups = F.array(
        *[
            F.struct(F.lit(name).alias("dimension"), expr.alias("group"))
            for name, expr in dimensions.items()
        ]
    )
    return df.select(*[quoted(c) for c in carry], F.inline(groups)).filter("`group` IS NOT NULL")


def subgroup_metrics(
    df: DataFrame,
    dimensions: dict[str, Column] | None = None,
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    score: str | None = "y_proba",
    min_rows: int = MIN_GROUP_ROWS,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """All dimensions at once; groups with fewer than ``min_rows`` rows are left out.

    ``positive_rate`` is the share of predicted positives and ``true_positive_rate``
    the share of true positives among all rows (a prevalence, not a recall).
    """
    dims = dimensions if dimensions is not None else dimensions_of(df)
    return metrics_of(group_counts(df, dims, y_true, y_pred, score, edges), min_rows)


def group_counts(
    df: DataFrame,
    dimensions: dict[str, Column],
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    score: str | None = "y_proba",
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Confusion counts and, with a score, rank sums of every group of every dimension."""
    if score is None:
        rows = by_dimension(df, dimensions, [y_true, y_pred])
        return confusion_counts(rows, y_true, y_pred, ["dimension", "group"])
    hits = rates.cell_indicators(quoted(y_true), quoted(y_pred))
    return rank_sums(df, dimensions, y_true, score, hits, edges)


def metrics_of(counts: DataFrame, min_rows: int = MIN_GROUP_ROWS) -> DataFrame:
    """Metrics of the groups that ``group_counts`` has counted."""
    keys = ["dimension", "group"]
    auc = auc_from_sums() if "u" in counts.columns else F.lit(None).cast("double")
    tn, fp, fn, tp = cells()
    n = rates.total(tn, fp, fn, tp)
    return counts.filter(n >= min_rows).select(
        *keys,
        n.alias("n_samples"),
        rates.accuracy(tn, fp, fn, tp).alias("accuracy"),
        rates.f1_macro(tn, fp, fn, tp).alias("f1_macro"),
        rates.f1_binary(tn, fp, fn, tp).alias("f1_binary"),
        auc.alias("auc"),
        F.try_divide(tp + fp, n).alias("positive_rate"),
        F.try_divide(tp + fn, n).alias("true_positive_rate"),
    )


def subgroup_disparity(groups: DataFrame) -> DataFrame:
    """(dimension, accuracy_max_diff, f1_max_diff) of dimensions with two groups or more."""

    def gap(c: str) -> Column:
        return (F.max(c) - F.min(c)).alias(
            "accuracy_max_diff" if c == "accuracy" else "f1_max_diff"
        )

    return (
        groups.groupBy("dimension")
        .agg(F.count(F.lit(1)).alias("n_groups"), gap("accuracy"), gap("f1_macro"))
        .filter("n_groups > 1")
        .drop("n_groups")
    )
