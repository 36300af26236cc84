"""Queries over whole models fit the published sizes on all features, not smaller stand-ins."""

import pytest

from pyspark.sql import functions as F

from tabaudit.operators import models
from tabaudit.plans import catalogue, stages, views

N_ORDERS = 200


@pytest.fixture(scope="module")
def orders_dir(spark, tmp_path_factory):
    """Small tables of orders, their lines and customers."""
    base = str(tmp_path_factory.mktemp("orders"))
    key = F.col("id")
    keys = spark.range(1, N_ORDERS + 1)
    tables = {
        "orders": keys.select(
            key.alias("o_orderkey"),
            (key % 20).alias("o_custkey"),
            F.element_at(F.array(*map(F.lit, "FOP")), (key % 3 + 1).cast("int")).alias("o_orderstatus"),
            (key * 7919 % 400000).cast("double").alias("o_totalprice"),
            F.concat((key % 5 + 1).cast("string"), F.lit("-P")).alias("o_orderpriority"),
        ),
        "lineitem": keys.select(
            key.alias("l_orderkey"),
            (key % 50).cast("double").alias("l_quantity"),
            (key % 10 / 100).alias("l_discount"),
        ),
        "customer": spark.range(20).select(
            key.alias("c_custkey"),
            (key * 100).cast("double").alias("c_acctbal"),
            F.concat(F.lit("S"), (key % 3).cast("string")).alias("c_mktsegment"),
            (key % 2).cast("int").alias("c_nationkey"),
        ),
        "nation": spark.range(2).select(key.cast("int").alias("n_nationkey"), key.cast("int").alias("n_regionkey")),
        "region": spark.range(2).select(
            key.cast("int").alias("r_regionkey"), F.concat(F.lit("R"), key.cast("string")).alias("r_name")
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{base}/{name}.parquet")
    return base


N_FEATURES = len(views.NUM_FEATURES) + len(views.CAT_FEATURES)


def test_cross_validation_trains_trees_of_the_published_size(spark, orders_dir, monkeypatch):
    seen = {}

    def cross_validate(train, features, estimator, folds, keep):
        seen.update(features=features, trees=estimator, folds=folds)
        return models.Trained(models.fit_model(train, features, models.logistic_regression()), 1.0, 0.0, train)

    monkeypatch.setattr(stages.models, "cross_validate", cross_validate)
    assert catalogue.gbt_cv_macro_f1(spark, orders_dir).count() == 1
    trees = seen["trees"]
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize()) == (100, 5, 0.1)
    assert len(seen["features"]) == N_FEATURES and seen["folds"] == 5


def test_stored_model_scores_every_row_of_the_test_part(spark, orders_dir):
    rows = catalogue.model_state_roundtrip(spark, orders_dir).collect()
    assert len({r["row_id"] for r in rows}) == len(rows) == N_ORDERS // 5
    # Keys divisible by three belong to finished orders, which one feature tells apart.
    assert all(r["label"] == r["y_pred"] == int(r["row_id"] % 3 == 0) for r in rows)


def test_ranking_compares_models_of_the_published_size(spark, orders_dir, monkeypatch):
    seen = {}

    def compare_models(train, test, features, estimators, folds=models.DEFAULT_FOLDS):
        seen.update(features=features, folds=folds, **estimators)
        return train.limit(1)

    monkeypatch.setattr(models, "compare_models", compare_models)
    catalogue.model_ranking(spark, orders_dir)
    assert len(seen["features"]) == N_FEATURES and seen["folds"] == 5
    assert seen["LogisticRegression"].getMaxIter() == 1000
    assert seen["RandomForest"].getNumTrees() == 100
    boosted = seen["GradientBoosting"]
    assert (boosted.getMaxIter(), boosted.getMaxDepth()) == (100, 3)
