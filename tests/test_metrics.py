import random

import pytest
from pyspark.sql import functions as F

from tabaudit.operators import diagnostics, metrics, ranking, subgroups

GOLDEN = {(0, 0): 7045, (0, 1): 386, (1, 0): 824, (1, 1): 1514}


@pytest.fixture(scope="module")
def golden(spark):
    cells = spark.createDataFrame([(t, p, n) for (t, p), n in GOLDEN.items()], "y_true int, y_pred int, n int")
    return cells.select("y_true", "y_pred", F.explode(F.sequence(F.lit(1), "n"))).drop("col")


def test_published_metrics_follow_from_the_published_counts(golden):
    row = metrics.overall_metrics(golden).first()
    assert row["n_samples"] == 9769
    assert row["accuracy"] == pytest.approx(0.8761388, abs=1e-7)
    assert row["f1_macro"] == pytest.approx(0.8177015, abs=1e-7)
    assert row["f1_binary"] == pytest.approx(0.7144880, abs=1e-7)


def test_published_report(golden):
    rows = {r["class"]: r for r in metrics.classification_report(golden, names=("<=50K", ">50K")).collect()}
    shown = {
        name: tuple(None if r[c] is None else round(r[c], 2) for c in ("precision", "recall", "f1", "support"))
        for name, r in rows.items()
    }
    assert shown["<=50K"] == (0.90, 0.95, 0.92, 7431)
    assert shown[">50K"] == (0.80, 0.65, 0.71, 2338)
    assert shown["accuracy"] == (None, None, 0.88, 9769)
    assert shown["macro avg"] == (0.85, 0.80, 0.82, 9769)
    assert shown["weighted avg"] == (0.87, 0.88, 0.87, 9769)


def test_confusion_matrix_shows_empty_cells(scored):
    df = scored([(1, 1, 0.5)])
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 1}


@pytest.mark.parametrize(
    ("rows", "macro", "binary"),
    [
        ([(0, 0)] * 5, 1.0, 0.0),
        ([(1, 1)] * 5, 1.0, 1.0),
        ([(0, 1)] * 5, 0.0, 0.0),
        ([(0, 0), (1, 0)], 1 / 3, 0.0),
    ],
)
def test_macro_f1_averages_over_the_classes_present(spark, rows, macro, binary):
    row = metrics.overall_metrics(spark.createDataFrame(rows, "y_true int, y_pred int")).first()
    assert (row["f1_macro"], row["f1_binary"]) == (pytest.approx(macro), binary)


def pair_auc(rows):
    pos = [s for y, s in rows if y == 1 and s is not None]
    neg = [s for y, s in rows if y == 0 and s is not None]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize(
    "edges", [None, [], [0.5], [0.2, 0.5, 0.5, 0.5], [i / 50 for i in range(1, 50)]]
)
def test_auc_equals_counting_pairs(spark, edges):
    rng = random.Random(3)
    # A third of all scores are equal, the others are continuous.
    rows = [(rng.randint(0, 1), 0.5 if i % 3 == 0 else rng.random()) for i in range(900)]
    rows += [(1, None), (0, None)]
    df = spark.createDataFrame(rows, "y_true int, s double")
    sums = ranking.overall_sums(df, "y_true", "s", {"n": F.lit(1)}, edges)
    row = sums.select("n", ranking.auc_from_sums().alias("auc")).first()
    assert row["n"] == 902
    assert row["auc"] == pytest.approx(pair_auc(rows), abs=1e-12)


def test_ranking_shuffles_rows_once_for_all_dimensions(people):
    df, _ = people
    edges = ranking.score_edges(df, "y_proba")
    dims = {**subgroups.dimensions_of(df), "other": F.col("y_pred").cast("string")}
    sums = ranking.rank_sums(df, dims, "y_true", "y_proba", edges=edges)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    # Cells, buckets, and one small exchange of bucket totals.
    assert plan.count("Exchange") == 3, plan
    tied = ranking.rank_sums(df, dims, "y_true", "y_proba", edges=[0.3, 0.3, 0.5])
    plan = tied._jdf.queryExecution().executedPlan().toString()
    # Spread rows need their totals brought together once more.
    assert plan.count("Exchange") == 4, plan


def test_a_frequent_score_in_many_groups_is_spread(spark):
    """Half of all rows share a score, over 300 groups; the result is that of counting pairs."""
    rows = [(i % 300, (i * 7) % 5 % 2, 0.25 if i % 2 else (i * 37 % 997) / 997) for i in range(6000)]
    df = spark.createDataFrame(rows, "g int, y_true int, y_proba double").withColumn("y_pred", F.col("y_true"))
    edges = ranking.score_edges(df, "y_proba")
    assert edges.count(0.25) > 1
    dims = {"g": F.col("g").cast("string")}
    sums = ranking.rank_sums(df, dims, "y_true", "y_proba", edges=edges)
    found = {r["group"]: r["auc"] for r in sums.select("group", ranking.auc_from_sums().alias("auc")).collect()}
    assert len(found) == 300
    for g in range(300):
        own = [(y, s) for k, y, s in rows if k == g]
        assert found[str(g)] == pytest.approx(pair_auc(own), abs=1e-12), g
    # The rows of the frequent score are dealt out over several keys, all others are not.
    cells = df.select(F.col("g").alias("_g0"), F.col("y_proba").alias("_s"))
    placed, keys = ranking._with_bucket(cells, edges, ["_g0"])
    spread = {r["_s"] == 0.25: r["n"] for r in placed.groupBy("_s").agg(F.countDistinct("_spread").alias("n")).collect()}
    assert keys == ["_b", "_spread"] and spread[True] == 4 and spread[False] == 1


def test_auc_is_zero_when_every_pair_is_wrong(scored):
    df = scored([(1, 0, 0.1), (0, 0, 0.9)])
    assert metrics.roc_auc(df).first()["auc"] == 0.0


def test_auc_of_one_class_is_null(scored):
    assert metrics.roc_auc(scored([(1, 1, 0.1), (1, 1, 0.9)])).first()["auc"] is None


def test_auc_without_any_score(scored):
    df = scored([(1, 1, None), (0, 0, None)])
    assert tuple(metrics.roc_auc(df).first()) == (None, 0, 0)
    summary = metrics.evaluation_summary(df, score=None).first()
    assert summary["auc"] is None and summary["accuracy"] == 1.0


def test_auc_does_not_depend_on_partitions(spark):
    df = spark.range(5000).select(
        (F.xxhash64("id") % 2 == 0).cast("int").alias("y_true"),
        F.round(F.rand(7), 3).alias("y_proba"),
    ).cache()
    found = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(metrics.roc_auc(df.repartition(int(n))).first()["auc"])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == pytest.approx(found[1], abs=1e-12)


@pytest.fixture(scope="module")
def people(spark):
    rows = []
    for i in range(400):
        # 'big' holds most rows; 'nine' is one row short; 'ten' is just enough.
        sex = "nine" if i < 9 else "ten" if i < 19 else None if i < 30 else "big"
        truth = 0 if sex == "ten" else (i * 7) % 3 % 2
        pred = 0 if sex == "ten" else (i * 5) % 4 % 2
        rows.append((i, truth, pred, (i * 37 % 101) / 101, sex, i % 104))
    schema = "row_id long, y_true int, y_pred int, y_proba double, sex string, age long"
    return spark.createDataFrame(rows, schema), rows


def test_subgroups(people):
    df, rows = people
    out = {(r["dimension"], r["group"]): r for r in subgroups.subgroup_metrics(df).collect()}
    # race is not a column; null and small groups are gone.
    assert {g for d, g in out if d == "sex"} == {"ten", "big"}
    assert {g for d, g in out if d == "age"} == {"<25", "25-35", "35-45", "45-55", ">55"}
    big = [r for r in rows if r[4] == "big"]
    row = out["sex", "big"]
    assert row["n_samples"] == len(big)
    assert row["accuracy"] == pytest.approx(sum(r[1] == r[2] for r in big) / len(big))
    assert row["positive_rate"] == pytest.approx(sum(r[2] for r in big) / len(big))
    assert row["true_positive_rate"] == pytest.approx(sum(r[1] for r in big) / len(big))
    assert row["auc"] == pytest.approx(pair_auc([(r[1], r[3]) for r in big]))
    ten = out["sex", "ten"]
    assert (ten["f1_macro"], ten["f1_binary"], ten["auc"]) == (1.0, 0.0, None)


def test_subgroups_without_scores_agree(people):
    df, _ = people
    keep = ["dimension", "group", "n_samples", "accuracy", "f1_macro", "f1_binary", "positive_rate"]
    with_scores = subgroups.subgroup_metrics(df).select(keep)
    without = subgroups.subgroup_metrics(df, score=None).select(keep)
    assert sorted(with_scores.collect()) == sorted(without.collect())


def test_disparity_needs_two_groups(spark):
    groups = spark.createDataFrame(
        [("sex", "a", 0.9, 0.8), ("sex", "b", 0.7, 0.85), ("race", "x", 0.5, 0.5)],
        "dimension string, group string, accuracy double, f1_macro double",
    )
    rows = subgroups.subgroup_disparity(groups).collect()
    assert len(rows) == 1 and rows[0]["dimension"] == "sex"
    assert rows[0]["accuracy_max_diff"] == pytest.approx(0.2)
    assert rows[0]["f1_max_diff"] == pytest.approx(0.05)


def rows_with(part, right, wrong):
    return [(1, 1, part)] * right + [(1, 0, part)] * wrong


@pytest.mark.parametrize(
    ("train_right", "test_right", "verdict"),
    [(100, 85, "alert"), (100, 93, "caution"), (100, 99, "ok"), (80, 100, "ok")],
)
def test_overfitting_verdict(spark, train_right, test_right, verdict):
    rows = rows_with("train", train_right, 100 - train_right)
    rows += rows_with("test", test_right, 100 - test_right)
    df = spark.createDataFrame(rows, "y_true int, y_pred int, part string")
    row = diagnostics.overfit_gap(df).first()
    assert row["verdict"] == verdict
    assert row["accuracy_diff"] == pytest.approx((train_right - test_right) / 100)


def test_consistency_compares_macro_with_macro(spark):
    rows = []
    for fold in range(5):
        rows += [(0, 0, "train", fold)] * 40 + [(1, 1, "train", fold)] * 8 + [(1, 0, "train", fold)] * 2
    rows += [(0, 0, "test", None)] * 40 + [(1, 1, "test", None)] * 8 + [(1, 0, "test", None)] * 2
    df = spark.createDataFrame(rows, "y_true int, y_pred int, part string, fold int")
    row = diagnostics.cv_test_consistency(df).first()
    assert row["macro_diff"] == pytest.approx(0) and row["verdict"] == "consistent"
    assert row["binary_diff"] > 0.03
    assert row["f1_cv_std"] == pytest.approx(0)
    assert diagnostics.fold_scores(df).count() == 5
