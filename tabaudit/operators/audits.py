"""Checks of fitted models against what the rows themselves say.

A tree's first split and its leaf values follow in closed form from counts per feature
value; the coefficients of an unpenalised logistic regression are right exactly if they
reproduce the observed moments of every feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabaudit.operators.cleaning import quoted
from tabaudit.operators.models import LABEL
from tabaudit.session import scratch_path

# Distinct values per feature that are looked at; bin others first.
MAX_VALUES = 256


def tree_nodes(model: Model) -> DataFrame:
    """(tree, node, left, right, feature, threshold, gain, prediction, n_rows) of a fitted tree model.

    ``feature`` is a position in the feature vector; leaves have neither children nor feature.
    """
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    last.write().overwrite().save(path)
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        *[F.when(inner, node[f"{side}Child"]).alias(side) for side in ("left", "right")],
        F.when(inner, node["split"]["featureIndex"]).alias("feature"),
        F.when(inner, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, node["gain"]).alias("gain"),
        node["prediction"].alias("prediction"),
        node["rawCount"].alias("n_rows"),
    )


def split_candidates(df: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """Every way to cut ``df`` in two by one feature, with what each side then predicts.

    (feature, threshold, n_left, n_right, left_value, right_value, gain): ``feature`` is the
    position in ``features``, a threshold lies midway between neighbouring values, a side's
    value is its mean label as -1 or 1, and the gain is the fall in variance of those. Counts of
    rows and labels per feature and value come from one aggregation.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("feature"), quoted(c).cast("double").alias("value"))
            for i, c in enumerate(features)
        ]
    )
    counts = (
        df.select(quoted(label).alias("_label"), F.inline(pairs))
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(2 * F.col("_label") - 1).alias("s"))
    )
    whole = Window.partitionBy("feature")
    ordered = whole.orderBy("value")
    cut = counts.select(
        "feature",
        F.assert_true(
            F.count(F.lit(1)).over(whole) <= MAX_VALUES,
            f"a feature has more than {MAX_VALUES} values: bin it first",
        ).alias("_checked"),
        ((F.col("value") + F.lead("value").over(ordered)) / 2).alias("threshold"),
        F.sum("n").over(ordered).alias("n_left"),
        F.sum("s").over(ordered).alias("s_left"),
        F.sum("n").over(whole).alias("n"),
        F.sum("s").over(whole).alias("s"),
    ).filter(F.col("_checked").isNull() & F.col("threshold").isNotNull())
    n_right, s_right = F.col("n") - F.col("n_left"), F.col("s") - F.col("s_left")
    explained = (
        F.col("s_left") * F.col("s_left") / F.col("n_left")
        + s_right * s_right / n_right
        - F.col("s") * F.col("s") / F.col("n")
    )
    return cut.select(
        "feature",
        "threshold",
        "n_left",
        n_right.alias("n_right"),
        (F.col("s_left") / F.col("n_left")).alias("left_value"),
        (s_right / n_right).alias("right_value"),
        (explained / F.col("n")).alias("gain"),
    )


def root_splits(model: Model, df: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """The first tree's first split beside the best one that the rows allow, one row.

    ``feature``, ``threshold``, ``gain``, ``left_value``, ``right_value``, ``n_left`` and
    ``n_right`` are the fitted tree's; the same with ``best_`` follow from ``df``.
    """
    nodes = tree_nodes(model).filter("tree = 0")
    root = nodes.filter("node = 0").select("feature", "threshold", "gain", "left", "right")
    for side in ("left", "right"):
        child = nodes.select(
            F.col("node").alias(side), F.col("prediction").alias(f"{side}_value"), F.col("n_rows").alias(f"n_{side}")
        )
        root = root.join(child, side)
    # Ties go to the feature and threshold that come first. One row, as is the root.
    best = split_candidates(df, features, label).orderBy(F.desc("gain"), "feature", "threshold").limit(1)
    row = best.first()
    if row is None:
        raise ValueError("no feature has two values, so there is nothing to split")
    known = {f"best_{f.name}": F.lit(row[f.name]).cast(f.dataType) for f in best.schema}
    return root.drop("left", "right").withColumns(known)


def moments(scored: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """(feature, n, observed, fitted): means of label times feature and of probability times feature.

    At the optimum of an unpenalised logistic regression both agree for every feature and
    for the intercept: their differences are the gradient of the mean log loss.
    ``scored`` holds the rows of the fit, with ``y_proba``.
    """
    columns = {"intercept": F.lit(1.0), **{c: quoted(c).cast("double") for c in features}}
    row = scored.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(quoted(label) * x).alias(f"o{i}") for i, x in enumerate(columns.values())],
        *[F.avg(F.col("y_proba") * x).alias(f"p{i}") for i, x in enumerate(columns.values())],
    )
    entries = [
        F.struct(
            F.lit(name).alias("feature"), F.col("n"),
            F.col(f"o{i}").alias("observed"), F.col(f"p{i}").alias("fitted"),
        )
        for i, name in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*entries)))
