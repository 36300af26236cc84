"""Classification rates from the four counts of a binary confusion matrix.

All divisions go through ``try_divide``: an undefined ratio is null, and callers
put 0 where a metric is defined to be 0.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CELLS = ("tn", "fp", "fn", "tp")


def is_one(label: Column, what: str) -> Column:
    """Whether a 0/1 label is 1; a null or any other value is an error when rows are read."""
    error = F.raise_error(F.lit(f"{what} must be 0 or 1, found null or another value"))
    return F.when(label == 1, True).when(label == 0, False).otherwise(error.cast("boolean"))


def cell_indicators(y_true: Column, y_pred: Column) -> dict[str, Column]:
    """One boolean per cell of the confusion matrix."""
    pos, hit = is_one(y_true, "truth"), is_one(y_pred, "prediction")
    return {"tn": ~pos & ~hit, "fp": ~pos & hit, "fn": pos & ~hit, "tp": pos & hit}


def total(tn: Column, fp: Column, fn: Column, tp: Column) -> Column:
    return tn + fp + fn + tp


def accuracy(tn: Column, fp: Column, fn: Column, tp: Column) -> Column:
    return F.try_divide(tn + tp, total(tn, fp, fn, tp))


def precision(hits: Column, false_alarms: Column) -> Column:
    return F.coalesce(F.try_divide(hits, hits + false_alarms), F.lit(0.0))


def recall(hits: Column, misses: Column) -> Column:
    return F.coalesce(F.try_divide(hits, hits + misses), F.lit(0.0))


def class_f1(hits: Column, false_alarms: Column, misses: Column) -> Column:
    """F1 of one class; 0 when the class occurs neither in truth nor in prediction."""
    return F.coalesce(F.try_divide(2 * hits, 2 * hits + false_alarms + misses), F.lit(0.0))


def f1_binary(tn: Column, fp: Column, fn: Column, tp: Column) -> Column:
    return class_f1(tp, fp, fn)


def macro(negative: Column, positive: Column, has_neg: Column, has_pos: Column) -> Column:
    """Mean of a metric over the classes that are present (0/1 flags)."""
    return F.try_divide(has_neg * negative + has_pos * positive, has_neg + has_pos)


def presence(tn: Column, fp: Column, fn: Column, tp: Column) -> tuple[Column, Column]:
    """Whether each class occurs in truth or prediction, as 0/1."""
    return (tn + fp + fn > 0).cast("int"), (tp + fp + fn > 0).cast("int")


def f1_macro(tn: Column, fp: Column, fn: Column, tp: Column) -> Column:
    """Mean F1 over the classes that occur in truth or prediction."""
    return macro(class_f1(tn, fn, fp), class_f1(tp, fp, fn), *presence(tn, fp, fn, tp))
