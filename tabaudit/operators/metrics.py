"""Classification metrics of a scored table with 0/1 truth and prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabaudit.functions import rates
from tabaudit.operators.cleaning import quoted
from tabaudit.operators.profile import inline_rows
from tabaudit.operators.ranking import auc_from_sums, overall_sums


def confusion_counts(
    df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", by: Sequence[str] = ()
) -> DataFrame:
    """One row per ``by`` group with the counts tn, fp, fn, tp; map-side combined."""
    cells = rates.cell_indicators(quoted(y_true), quoted(y_pred))
    return df.groupBy(*[quoted(b) for b in by]).agg(
        *[F.count_if(hit).alias(name) for name, hit in cells.items()]
    )


def label_problems(
    df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred"
) -> DataFrame:
    """(n_rows, n_valid, and per label its nulls and its other values), one pass.

    The metrics refuse such rows; ``valid_rows`` leaves them out.
    """
    counts = []
    for name, col in (("truth", quoted(y_true)), ("prediction", quoted(y_pred))):
        odd = col.isNotNull() & ~col.isin(0, 1)
        counts += [
            F.count_if(col.isNull()).alias(f"n_null_{name}"),
            F.count_if(odd).alias(f"n_other_{name}"),
        ]
    valid = F.count_if(_is_valid(y_true, y_pred)).alias("n_valid")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), valid, *counts)


def valid_rows(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Rows whose truth and prediction are both 0 or 1."""
    return df.filter(_is_valid(y_true, y_pred))


def _is_valid(y_true: str, y_pred: str) -> Column:
    both = quoted(y_true).isin(0, 1) & quoted(y_pred).isin(0, 1)
    return F.coalesce(both, F.lit(False))


def cells() -> list[Column]:
    return [F.col(c) for c in rates.CELLS]


def confusion_matrix(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """(y_true, y_pred, n), all four cells."""
    entries = [
        F.struct(
            F.lit(int(name in ("fn", "tp"))).alias("y_true"),
            F.lit(int(name in ("fp", "tp"))).alias("y_pred"),
            F.col(name).alias("n"),
        )
        for name in rates.CELLS
    ]
    return inline_rows(confusion_counts(df, y_true, y_pred), entries)


def score_counts(counts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """accuracy, f1_macro and f1_binary of rows that hold confusion counts."""
    return counts.select(
        *[quoted(k) for k in keep],
        rates.total(*cells()).alias("n_samples"),
        rates.accuracy(*cells()).alias("accuracy"),
        rates.f1_macro(*cells()).alias("f1_macro"),
        rates.f1_binary(*cells()).alias("f1_binary"),
    )


def overall_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """(n_samples, accuracy, f1_macro, f1_binary), one pass."""
    return score_counts(confusion_counts(df, y_true, y_pred))


def classification_report(
    df: DataFrame,
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    names: tuple[str, str] = ("0", "1"),
) -> DataFrame:
    """``report_of`` the confusion counts of a scored table."""
    return report_of(confusion_counts(df, y_true, y_pred), names)


def report_of(counts: DataFrame, names: tuple[str, str] = ("0", "1")) -> DataFrame:
    """(class, precision, recall, f1, support) per class, then accuracy and averages.

    A class that occurs neither in truth nor in prediction has a row of zeros and
    takes no part in the macro averages.
    """
    tn, fp, fn, tp = cells()
    per_class = {
        names[0]: (rates.precision(tn, fn), rates.recall(tn, fp), rates.class_f1(tn, fn, fp), tn + fp),
        names[1]: (rates.precision(tp, fp), rates.recall(tp, fn), rates.class_f1(tp, fp, fn), tp + fn),
    }
    n = rates.total(*cells())
    (p0, r0, f0, s0), (p1, r1, f1, s1) = per_class.values()
    acc = rates.accuracy(tn, fp, fn, tp)
    weighted = [F.try_divide(a * s0 + b * s1, n) for a, b in ((p0, p1), (r0, r1), (f0, f1))]
    seen = rates.presence(tn, fp, fn, tp)
    macros = [rates.macro(a, b, *seen) for a, b in ((p0, p1), (r0, r1), (f0, f1))]
    none = F.lit(None).cast("double")
    rows = {
        **per_class,
        "accuracy": (none, none, acc, n),
        "macro avg": (*macros, n),
        "weighted avg": (*weighted, n),
    }
    return inline_rows(
        counts,
        [
            F.struct(
                F.lit(name).alias("class"),
                p.alias("precision"),
                r.alias("recall"),
                f.alias("f1"),
                s.alias("support"),
            )
            for name, (p, r, f, s) in rows.items()
        ],
    )


def roc_auc(df: DataFrame, y_true: str = "y_true", score: str = "y_proba") -> DataFrame:
    """(auc, n_pos, n_neg), exact with ties; null when only one class occurs."""
    return overall_sums(df, y_true, score).select(
        auc_from_sums().alias("auc"), F.col("pos").alias("n_pos"), F.col("neg").alias("n_neg")
    )


def evaluation_summary(
    df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", score: str | None = "y_proba"
) -> DataFrame:
    """Confusion counts, accuracy, both F1 and AUC in one row.

    Everything comes out of the ranking pass; without a score one plain
    aggregation is enough and the AUC is null.
    """
    if score is None:
        return summary_of(confusion_counts(df, y_true, y_pred))
    hits = rates.cell_indicators(quoted(y_true), quoted(y_pred))
    return summary_of(one_row(overall_sums(df, y_true, score, hits)))


def one_row(sums: DataFrame) -> DataFrame:
    """The sums of at most one group as one row, even for a table without rows."""
    counts = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*rates.CELLS, "pos", "neg")]
    return sums.agg(*counts, F.sum("u").alias("u"))


def summary_of(counts: DataFrame) -> DataFrame:
    """``evaluation_summary`` of rows that hold confusion counts and, for the AUC, rank sums."""
    auc = auc_from_sums() if "u" in counts.columns else F.lit(None).cast("double")
    return counts.select(
        *rates.CELLS,
        rates.accuracy(*cells()).alias("accuracy"),
        rates.f1_macro(*cells()).alias("f1_macro"),
        rates.f1_binary(*cells()).alias("f1_binary"),
        auc.alias("auc"),
    )
