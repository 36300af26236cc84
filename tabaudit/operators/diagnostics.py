"""Overfitting checks on a scored table that knows its split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabaudit.functions import rates
from tabaudit.operators.metrics import confusion_counts, score_counts

# Gaps above these raise the verdict; a gap equal to one does not.
ALERT_GAP = 0.10
CAUTION_GAP = 0.05
CONSISTENCY_GAP = 0.05


def _counts_in(part: Column) -> dict[str, Column]:
    hits = rates.cell_indicators(F.col("y_true"), F.col("y_pred"))
    return {name: F.count_if(part & hit) for name, hit in hits.items()}


def overfit_gap(scored: DataFrame, part: str = "part") -> DataFrame:
    """Train and test accuracy and binary F1, their gaps, and a three-way verdict."""
    aggs = []
    for p in ("train", "test"):
        for name, agg in _counts_in(F.col(part) == p).items():
            aggs.append(agg.alias(f"{p}_{name}"))
    row = scored.agg(*aggs)
    for p in ("train", "test"):
        cell = [F.col(f"{p}_{name}") for name in rates.CELLS]
        row = row.withColumn(f"{p}_accuracy", rates.accuracy(*cell)).withColumn(
            f"{p}_f1", rates.f1_binary(*cell)
        )
    acc_gap = F.col("train_accuracy") - F.col("test_accuracy")
    f1_gap = F.col("train_f1") - F.col("test_f1")
    verdict = (
        F.when((acc_gap > ALERT_GAP) | (f1_gap > ALERT_GAP), "alert")
        .when((acc_gap > CAUTION_GAP) | (f1_gap > CAUTION_GAP), "caution")
        .otherwise("ok")
    )
    return row.select(
        "train_accuracy",
        "train_f1",
        "test_accuracy",
        "test_f1",
        acc_gap.alias("accuracy_diff"),
        f1_gap.alias("f1_diff"),
        verdict.alias("verdict"),
    )


def fold_scores(scored: DataFrame, fold: str = "fold") -> DataFrame:
    """(fold, n_samples, accuracy, f1_macro, f1_binary), rows without a fold left out."""
    counts = confusion_counts(scored.filter(F.col(fold).isNotNull()), by=[fold])
    return score_counts(counts, [fold])


def cv_test_consistency(scored: DataFrame, part: str = "part", fold: str = "fold") -> DataFrame:
    """Cross-validated macro F1 against both test F1; the verdict compares macro with macro.

    The slots (each fold, and the test part) are counted in one pass.
    """
    slot = F.when(F.col(part) == "test", F.lit(-1)).otherwise(F.col(fold))
    counts = confusion_counts(scored.withColumn("slot", slot), by=["slot"])
    scores = score_counts(counts, ["slot"])
    is_test = F.col("slot") == -1
    row = scores.agg(
        F.avg(F.when(~is_test, F.col("f1_macro"))).alias("f1_cv"),
        F.stddev_pop(F.when(~is_test, F.col("f1_macro"))).alias("f1_cv_std"),
        F.max(F.when(is_test, F.col("f1_macro"))).alias("f1_test_macro"),
        F.max(F.when(is_test, F.col("f1_binary"))).alias("f1_test_binary"),
    )
    macro = F.abs(F.col("f1_cv") - F.col("f1_test_macro"))
    return row.select(
        "*",
        macro.alias("macro_diff"),
        F.abs(F.col("f1_cv") - F.col("f1_test_binary")).alias("binary_diff"),
        F.when(macro > CONSISTENCY_GAP, "check").otherwise("consistent").alias("verdict"),
    )
