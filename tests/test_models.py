import pytest
from pyspark.sql import functions as F

from tabaudit.operators import metrics, models
from tabaudit.operators.encode import fit_preprocessor
from tabaudit.plans import census, stages
from tabaudit.sources import reports, state, tables

FAST = {"n_estimators": 3, "max_depth": 3}


@pytest.fixture(scope="module")
def run(random_people, tmp_path_factory):
    """All stages on the 100 people."""
    root = str(tmp_path_factory.mktemp("run"))
    return root, stages.run_all(random_people, root, params=FAST, key="row_id")


def test_stages_hand_over(run):
    root, out = run
    assert out["ingest"]["n_rows"] == 100
    # Raw incomes are not part of the validated features; '?' is a valid text.
    assert out["validate"]["success"] is True
    assert 0 < out["train"]["metrics"]["f1_cv"] <= 1
    assert set(out["train"]["metrics"]) == {"f1_cv", "f1_cv_std", "f1_test", "params"}
    matrix = out["evaluate"]["confusion_matrix"]
    assert sum(map(sum, matrix)) == 20
    assert 0 <= out["evaluate"]["auc"] <= 1
    assert set(out["evaluate"]["subgroup_metrics"]) == {"sex", "race", "age"}
    assert out["evaluate"]["groups"].count() > 0


def test_train_and_evaluate_agree_on_the_split(run):
    _, out = run
    assert out["train"]["metrics"]["f1_test"] == pytest.approx(out["evaluate"]["f1_macro"])


def test_documents_and_run_log(run, spark):
    root, out = run
    paths = stages.Paths(root)
    saved = reports.read_document(spark, f"{paths.artifacts}/metrics.json")
    assert saved["f1_cv"] == out["train"]["metrics"]["f1_cv"]
    assert reports.read_document(spark, f"{paths.artifacts}/evaluation_metrics.json")["accuracy"] > 0
    runs = reports.read_runs(spark, paths.runs).collect()
    assert [r["run_id"] for r in runs] == [out["train"]["run_id"]]
    assert set(runs[0]["metrics"]) == {"f1_cv", "f1_cv_std", "f1_test"}


def test_saved_model_scores_the_same(run, spark):
    root, out = run
    paths = stages.Paths(root)
    design = stages.design_table(
        *stages._load(spark, paths, stages.CENSUS),
        state.load_preprocessor(spark, f"{paths.artifacts}/preprocessor"),
    )
    loaded = state.load_model(paths.model)
    assert sorted(models.score(loaded, design, ["row_id"]).collect()) == sorted(
        models.score(out["train"]["model"], design, ["row_id"]).collect()
    )
    with pytest.raises(FileNotFoundError):
        state.load_model(f"{root}/no-model")


def test_evaluating_alone_gives_the_same(run, spark):
    root, out = run
    alone = stages.evaluate_stage(spark, stages.Paths(root))
    assert alone["confusion_matrix"] == out["evaluate"]["confusion_matrix"]
    assert alone["auc"] == pytest.approx(out["evaluate"]["auc"])
    groups = [
        {(r["dimension"], r["group"]) for r in x["groups"].collect()} for x in (alone, out["evaluate"])
    ]
    assert groups[0] == groups[1]


def test_overfitting_check(run, scored):
    _, out = run
    check = out["overfitting"]
    assert check["gap"]["verdict"] in {"alert", "caution", "ok"}
    assert check["gap"]["test_accuracy"] == pytest.approx(out["evaluate"]["accuracy"])
    gap = abs(out["train"]["metrics"]["f1_cv"] - out["train"]["metrics"]["f1_test"])
    assert check["cv"]["macro_diff"] == pytest.approx(gap)
    assert check["cv"]["verdict"] == ("check" if gap > 0.05 else "consistent")
    rows = [(1, 1, "train", 0), (0, 0, "train", 1), (1, 1, "test", None), (0, 0, "test", None)]
    perfect = scored(rows, "y_true int, y_pred int, part string, fold int")
    # The final model's own training score is no cross-validation, so a score has to be given.
    assert stages.check_overfitting(perfect, 0.5)["cv"]["macro_diff"] == 0.5
    with pytest.raises(TypeError):
        stages.check_overfitting(perfect)


def test_overfitting_check_alone_gives_the_same(run, spark, tmp_path):
    root, out = run
    assert stages.overfitting_stage(spark, stages.Paths(root)) == out["overfitting"]
    with pytest.raises(FileNotFoundError, match="out-of-fold"):
        stages.overfitting_stage(spark, stages.Paths(str(tmp_path)))


def test_stored_out_of_fold_predictions(run, spark):
    root, out = run
    stored = spark.read.parquet(stages.Paths(root).out_of_fold)
    assert sorted(stored.collect()) == sorted(out["train"]["out_of_fold"].collect())
    assert stored.count() == 80 and stored.select("row_id").distinct().count() == 80
    assert models.cv_scores(stored) == (out["train"]["metrics"]["f1_cv"], out["train"]["metrics"]["f1_cv_std"])


def test_fit_scopes(run, spark):
    root, _ = run
    with pytest.raises(ValueError, match="fit_scope"):
        stages.features_stage(spark, stages.Paths(root), fit_scope="test")


@pytest.fixture(scope="module")
def points(spark):
    df = spark.range(300).select(
        F.col("id").alias("row_id"),
        (F.xxhash64("id") % 100).cast("double").alias("x"),
        (F.col("id") % 5).cast("int").alias("fold"),
    )
    return df.withColumn("label", ((F.col("x") > 10) | (F.col("row_id") % 17 == 0)).cast("int")).cache()


def test_two_fits_with_one_seed_agree(points):
    trees = models.boosted_trees(FAST)
    a, b = (models.score(models.fit_model(points, ["x"], trees), points, ["row_id"]) for _ in range(2))
    assert sorted(a.collect()) == sorted(b.collect())


def test_macro_f1_evaluator_is_unweighted(spark):
    rows = [(0, 0.0)] * 7045 + [(0, 1.0)] * 386 + [(1, 0.0)] * 824 + [(1, 1.0)] * 1514
    df = spark.createDataFrame(rows, "label int, prediction double")
    assert models.MacroF1().evaluate(df) == pytest.approx(0.8177015, abs=1e-7)
    assert models.MacroF1().isLargerBetter()


def test_model_without_probabilities(points):
    class Fixed:
        def transform(self, df):
            return df.withColumn("prediction", F.lit(1.0))

    out = models.score(Fixed(), points, ["label"])
    assert out.filter("y_proba IS NOT NULL").count() == 0
    assert metrics.overall_metrics(out, "label").first()["n_samples"] == 300
    document = stages.evaluate(out.withColumnRenamed("label", "y_true"))
    assert document["auc"] is None and document["subgroup_metrics"] == {}


def test_nulls_are_refused_by_training(points):
    with pytest.raises(Exception, match="null|NaN"):
        models.fit_model(points.withColumn("x", F.when(F.col("x") > 0, F.col("x"))), ["x"], models.logistic_regression())


def test_comparison_ranks_by_test_score(points):
    out = models.compare_models(
        points, points, ["x"], models.comparison_models(trees=2, max_iter=5), folds=5
    ).collect()
    assert {r["model"] for r in out} == {"LogisticRegression", "RandomForest", "GradientBoosting"}
    tests = [r["f1_test"] for r in out]
    assert tests == sorted(tests, reverse=True)


def test_default_parameters():
    trees = models.boosted_trees()
    assert (trees.getMaxIter(), trees.getStepSize(), trees.getMaxDepth()) == (100, 0.1, 5)
    assert len(census.FEATURE_COLS) == 14


def test_fit_scope_all_sees_every_row(run, spark):
    root, _ = run
    paths = stages.Paths(root)
    where = f"{paths.artifacts}/preprocessor"
    means = {}
    for scope in ("all", "train"):
        stages.features_stage(spark, paths, fit_scope=scope)
        means[scope] = state.load_preprocessor(spark, where).scaler["age"][0]
    features, _ = stages._load(spark, paths, stages.CENSUS)
    assert means["all"] == pytest.approx(features.agg(F.avg("age")).first()[0])
    assert means["train"] != means["all"]


def test_stages_read_csv_where_there_is_no_parquet(run, random_people, spark, tmp_path):
    root, _ = run
    raw = stages.Paths(str(tmp_path)).raw
    features, target = tables.split_source(random_people, census.FEATURE_COLS, "income", "row_id")
    tables.write_csv(features, f"{raw}/features.csv")
    tables.write_csv(target, f"{raw}/targets.csv")
    preprocessor = state.load_preprocessor(spark, f"{stages.Paths(root).artifacts}/preprocessor")
    designs = [
        stages.design_table(*stages._load(spark, p, stages.CENSUS), preprocessor)
        for p in (stages.Paths(str(tmp_path)), stages.Paths(root))
    ]
    assert sorted(designs[0].collect()) == sorted(designs[1].collect())


def test_groups_are_cleaned_once(random_people, spark):
    messy = random_people.withColumn(
        "sex", F.when(F.col("row_id") < 30, F.concat(F.lit(" "), "sex", F.lit(".. ."))).otherwise("?")
    )
    features, target = tables.split_source(messy, census.FEATURE_COLS, "income", "row_id")
    fitted = fit_preprocessor(features, census.NUM_COLS, census.CAT_COLS)
    design = stages.design_table(features, target, fitted)
    groups = {r["group_sex"]: r["sex"] for r in design.collect()}
    # Blanks, then dots, once; the missing entry is a group and a category of its own.
    assert groups == {"Female.. ": 0.0, "Male.. ": 1.0, "nan": 2.0}


def test_training_input_is_spread_over_the_cores(points, spark):
    cores = spark.sparkContext.defaultParallelism
    assert models.spread(points.coalesce(1)).rdd.getNumPartitions() == cores
    many = points.repartition(cores + 3)
    assert models.spread(many) is many


def test_training_input_takes_no_turn_for_a_few_partitions(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism

    def sizes(df):
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]

    # One partition more than cores: the second turn would leave all others idle.
    rows = spark.range(0, 1300 * (cores + 1), 1, cores + 1)
    assert len(sizes(models.spread(rows))) == cores
    # Enough partitions, but most rows in one of them.
    uneven = spark.range(0, 4000, 1, 1).union(spark.range(0, 80, 1, 2 * cores))
    even = sizes(models.spread(uneven))
    assert len(even) == cores and sum(even) == 4080 and max(even) < 1.1 * min(even)
    # Partitions made by the shuffle stay small, whatever the table.
    monkeypatch.setattr(models, "MAX_TASK_ROWS", 500)
    assert len(sizes(models.spread(spark.range(0, 4000, 1, 1)))) >= 8
    empty = spark.range(0)
    assert models.spread(empty) is empty


@pytest.fixture
def dealt(monkeypatch):
    """The tables that are dealt out over the cores."""
    found, spread = [], models.spread
    monkeypatch.setattr(models, "spread", lambda df: found.append(df) or spread(df))
    return found


def test_compared_models_deal_out_their_rows_once(points, dealt):
    two = {str(n): models.logistic_regression(n) for n in (5, 10)}
    out = models.model_predictions(points, points, ["x"], two, keep=["row_id"])
    assert len(dealt) == 1
    counts = {(r["model"], r["part"]): r["count"] for r in out.groupBy("model", "part").count().collect()}
    assert counts == {(m, p): 300 for m in two for p in ("train", "test")}


def test_folds_and_final_fit_deal_out_their_rows_once(points, dealt):
    trained = models.cross_validate(points, ["x"], models.logistic_regression(5), keep=["row_id"])
    assert len(dealt) == 1
    assert trained.out_of_fold.select("row_id").distinct().count() == 300
    assert models.score(trained.model, points).count() == 300


def test_every_model_is_fitted_once_without_each_fold(points):
    class Rows:
        def __init__(self, name):
            self.name = name

        def fit(self, df):
            return self.name, df.columns, df.count()

    # A row without a fold belongs to the whole training part only.
    some = points.withColumn("fold", F.when(F.col("row_id") >= 10, F.col("fold")))
    vectors = models.training_vectors(some, ["x"])
    assert vectors.columns == ["features", "label", "fold"]
    fitted = models.fit_in_turns(vectors, [Rows("a"), Rows("b")], [None, *range(5)], 3)
    assert fitted == {
        (place, side): ("ab"[place], ["features", "label"], 300 if side is None else 232)
        for place in range(2)
        for side in (None, *range(5))
    }


def test_all_of_many_groups_are_listed(spark, tmp_path):
    scored = spark.range(100_010).select(
        F.col("id").alias("row_id"),
        (F.col("id") % 2).cast("int").alias("y_true"),
        (F.col("id") % 2).cast("int").alias("y_pred"),
        F.lit(0.5).alias("y_proba"),
        F.concat(F.lit("g"), F.col("id") % 10_001).alias("sex"),
    )
    document = stages.evaluate(scored, paths=stages.Paths(str(tmp_path)))
    assert document["subgroup_metrics"]["sex"]["disparity"]["accuracy_max_diff"] == 0
    assert spark.read.json(document["subgroups_path"]).count() == 10_001
    assert document["groups"].count() == 10_001


def test_stages_over_paths(run, random_people, spark, tmp_path):
    root, out = run
    paths = stages.Paths(root)
    landed = f"{tmp_path}/landed"
    tables.write_csv(random_people, f"{landed}.csv")
    own = stages.Paths(str(tmp_path))
    ingested = stages.ingest_stage(spark, landed, own, key="row_id", schema=random_people.schema)
    assert ingested["n_rows"] == 100
    checked = stages.validate_stage(spark, own)
    assert checked["success"] == out["validate"]["success"]
    assert checked["null_counts"] == out["validate"]["null_counts"]
    f1_cv = out["train"]["metrics"]["f1_cv"]
    assert stages.overfitting_stage(spark, paths, f1_cv=f1_cv) == out["overfitting"]
    few = {"LogisticRegression": models.logistic_regression(5)}
    assert [r["model"] for r in stages.compare_stage(spark, paths, estimators=few).collect()] == list(few)


def test_scratch_folder_is_one_and_can_be_removed(spark):
    from tabaudit import session

    table = session.materialize(spark.range(5))
    assert all(session.scratch_root(spark) in f for f in table.inputFiles())
