"""Fitted models against the rows they were fitted on."""

import pytest
from pyspark.sql import functions as F

from tabaudit.operators import audits, models

FEATURES = ["x", "z"]


@pytest.fixture(scope="module")
def noisy(spark):
    rows = spark.range(400).select(
        F.pmod(F.xxhash64("id"), F.lit(12)).cast("double").alias("x"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)).cast("double").alias("z"),
        (F.col("id") % 4).cast("int").alias("fold"),
        F.col("id").alias("row_id"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(7)).alias("noise"),
    )
    return rows.withColumn("label", (F.col("x") + F.col("z") + F.col("noise") > 9).cast("int")).cache()


def by_hand(rows):
    """(gain, feature, threshold, n_left) of every cut, best first."""

    def spread(side):
        mean = sum(side) / len(side)
        return sum((s - mean) ** 2 for s in side)

    all_labels = [2 * r.label - 1 for r in rows]
    cuts = []
    for i, name in enumerate(FEATURES):
        values = sorted({r[name] for r in rows})
        for a, b in zip(values, values[1:]):
            left = [2 * r.label - 1 for r in rows if r[name] <= a]
            right = [2 * r.label - 1 for r in rows if r[name] > a]
            cuts.append(((spread(all_labels) - spread(left) - spread(right)) / len(rows), i, (a + b) / 2, len(left)))
    return sorted(cuts, key=lambda c: (-c[0], c[1], c[2]))


def test_split_candidates_by_hand(noisy):
    got = audits.split_candidates(noisy, FEATURES).collect()
    want = by_hand(noisy.collect())
    assert len(got) == len(want) == 11 + 4
    found = sorted(((r.gain, r.feature, r.threshold, r.n_left) for r in got), key=lambda c: (-c[0], c[1], c[2]))
    for a, b in zip(found, want):
        assert a[0] == pytest.approx(b[0]) and a[1:] == b[1:]


def test_fitted_root_is_the_best_cut(noisy):
    model = models.fit_model(noisy, FEATURES, models.boosted_trees({"n_estimators": 3, "max_depth": 1}))
    row = audits.root_splits(model, noisy, FEATURES).first()
    for name in ("feature", "threshold", "gain", "left_value", "right_value", "n_left", "n_right"):
        assert row[name] == pytest.approx(row[f"best_{name}"]), name
    nodes = audits.tree_nodes(model)
    assert nodes.select("tree").distinct().count() == 3
    assert nodes.filter("left is null").filter("feature is not null").count() == 0


def test_features_of_many_values_are_refused(noisy):
    with pytest.raises(Exception, match="bin it first"):
        wide = noisy.withColumn("x", F.col("row_id").cast("double"))
        audits.split_candidates(wide, FEATURES).collect()


def test_moments_tell_the_optimum_from_other_coefficients(noisy):
    def gaps(estimator):
        model = models.fit_model(noisy, FEATURES, estimator)
        rows = audits.moments(models.score(model, noisy, [*FEATURES, "label"]), FEATURES).collect()
        assert [r.feature for r in rows] == ["intercept", *FEATURES] and all(r.n == 400 for r in rows)
        return max(abs(r.observed - r.fitted) for r in rows)

    assert gaps(models.logistic_regression(tol=1e-10)) < 1e-6
    assert gaps(models.logistic_regression().setRegParam(0.1)) > 1e-2


def test_every_row_is_scored_once_by_a_model_that_has_not_seen_it(noisy):
    # A deep tree knows the rows it was fitted on by heart if each has a label of its own.
    own = noisy.withColumns({"x": F.col("row_id").cast("double"), "label": (F.xxhash64("row_id") % 2 == 0).cast("int")})
    trees = models.boosted_trees({"n_estimators": 1, "max_depth": 12})
    table = models.out_of_fold(own, ["x"], trees, folds=4, keep=["row_id"])
    assert table.count() == 400 and table.select("row_id").distinct().count() == 400
    hits = table.filter("label = y_pred").count() / 400
    seen = models.score(models.fit_model(own, ["x"], trees), own, ["label"]).filter("label = y_pred").count() / 400
    assert hits < 0.6 and seen > hits + 0.1


def test_ranking_follows_from_the_table(spark):
    rows = [("a", "train", 0, 1, 1), ("a", "train", 1, 0, 1), ("a", "test", None, 1, 1), ("a", "test", None, 0, 0)]
    rows += [("b", "train", 0, 1, 1), ("b", "train", 1, 0, 0), ("b", "test", None, 1, 0), ("b", "test", None, 0, 0)]
    table = spark.createDataFrame(rows, "model string, part string, fold int, label int, y_pred int")
    first, second = models.ranking_of(table).collect()
    assert (first.model, first.f1_cv, first.f1_cv_std, first.f1_test, first.accuracy) == ("a", 0.5, 0.5, 1.0, 1.0)
    assert (second.model, second.f1_cv, second.f1_cv_std, second.accuracy) == ("b", 1.0, 0.0, 0.5)
