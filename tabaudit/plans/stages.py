"""The stages from landed file to audited classifier.

Every stage can be run alone over paths on shared storage. All of them use the
same cleaning chain and the same split, both pure functions of the rows, so it
does not matter whether they run together or apart.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabaudit.functions.rates import CELLS
from tabaudit.functions.values import POSITIVE_LABEL
from tabaudit.operators import expectations, metrics, models, profile, subgroups
from tabaudit.operators.cleaning import (
    binarize_label,
    clean_features,
    clean_target,
    numeric_columns,
    quoted,
    string_columns,
)
from tabaudit.operators.diagnostics import CONSISTENCY_GAP, overfit_gap
from tabaudit.operators.encode import Preprocessor, fit_preprocessor
from tabaudit.operators.split import fit_split
from tabaudit.plans import census
from tabaudit.session import materialize
from tabaudit.sources import reports, state
from tabaudit.sources.tables import ROW_ID, ingest, load_data, read_table

log = logging.getLogger(__name__)

GROUP_PREFIX = "group_"

# The dimension whose only group is the whole table; no column has this name.
WHOLE = " whole table"


@dataclass(frozen=True)
class Paths:
    """Where the stages hand over, below one root on shared storage."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/data/raw"

    @property
    def processed(self) -> str:
        return f"{self.root}/data/processed"

    @property
    def artifacts(self) -> str:
        return f"{self.root}/artifacts"

    @property
    def model(self) -> str:
        return f"{self.root}/models/model"

    @property
    def out_of_fold(self) -> str:
        return f"{self.artifacts}/out_of_fold"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"


@dataclass(frozen=True)
class Layout:
    """What the stages need to know about a table."""

    features: tuple[str, ...] = tuple(census.FEATURE_COLS)
    target: str = census.TARGET
    num_cols: tuple[str, ...] = tuple(census.NUM_COLS)
    cat_cols: tuple[str, ...] = tuple(census.CAT_COLS)
    rules: tuple[expectations.ColumnRule, ...] = census.RULES
    positive: str = POSITIVE_LABEL
    dimensions: tuple[str, ...] = subgroups.DEFAULT_DIMENSIONS
    feature_schema: object = census.LANDED_FEATURES
    target_schema: object = census.LANDED_TARGET


CENSUS = Layout()


def validation_rows(
    df: DataFrame, rules=census.RULES, key: str | None = None, top: int = 10
) -> DataFrame:
    """The validation report in long form: (section, column, statistic, is_null, value).

    Rules, nulls, types and the basic statistics come from one shared aggregation;
    quartiles, duplicates and top values from one operator each. ``key`` is a
    technical row id: rules may speak of it, but it takes no part in the profile.
    ``is_null`` marks the count of nulls among the top values of a text column.
    """
    data = df.drop(key) if key else df
    counts = expectations.verdict_aggregates(df, rules)
    numeric = numeric_columns(data)
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[agg.alias(f"rule{i}") for i, agg in enumerate(counts.values())],
        *[F.count_if(profile.is_missing(data, c)).alias(f"null{i}") for i, c in enumerate(data.columns)],
        *profile.basic_aggregates(data, numeric),
    ).first()
    lines = [("rules", *rule.split(": ", 1), row[f"rule{i}"]) for i, rule in enumerate(counts)]
    lines += [
        ("rules", column, check, row["rows"])
        for column, check, _ in expectations.schema_problems(df, rules)
    ]
    for i, (name, dtype) in enumerate(data.dtypes):
        lines.append(("null_counts", name, "nulls", row[f"null{i}"]))
        lines.append(("dtypes", name, dtype, 1))
    # A few lines per column and rule.
    out = df.sparkSession.createDataFrame(
        [(*line[:3], float(line[3])) for line in lines],
        "section string, column string, statistic string, value double",
    )
    out = out.unionByName(
        profile.duplicate_rows(data).select(
            F.lit("duplicates").alias("section"),
            F.lit(None).cast("string").alias("column"),
            F.lit("count").alias("statistic"),
            F.col("n_duplicates").cast("double").alias("value"),
        )
    )
    if numeric:
        stats = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
        out = out.unionByName(
            profile.numeric_summary(data, numeric, row).select(
                F.lit("numeric_summary").alias("section"),
                "column",
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(s).alias("statistic"), F.col(s).cast("double").alias("value")
                            )
                            for s in stats
                        ]
                    )
                ),
            )
        )
    if string_columns(data):
        out = out.unionByName(
            profile.top_values(data, top).select(
                F.lit("categorical_distribution").alias("section"),
                "column",
                F.col("value").alias("statistic"),
                F.col("n").cast("double").alias("value"),
            )
        )
    is_null = (F.col("section") == "categorical_distribution") & F.col("statistic").isNull()
    return out.select("section", "column", "statistic", is_null.alias("is_null"), "value")


def validate(
    df: DataFrame,
    output_dir: str | None = None,
    rules=census.RULES,
    key: str | None = None,
    strict: bool = False,
) -> dict:
    """Validation report as a nested document; failures are reported, not raised.

    With ``strict`` a failed rule raises instead. If ``output_dir`` is given, the
    report and all failing rows are written there.
    """
    if strict:
        expectations.require_expectations(df, rules)
    # A few rows per column.
    rows = validation_rows(df, rules, key).collect()
    report: dict = {
        "success": True,
        "schema_issues": [],
        "null_counts": {},
        "dtypes": {},
        "duplicates": {},
        "numeric_summary": {},
        "categorical_distribution": {},
        "categorical_nulls": {},
    }
    for section, column, statistic, is_null, value in rows:
        if section == "rules":
            if value > 0 or statistic == "column_in_dataframe" or statistic.startswith("dtype("):
                report["success"] = False
                report["schema_issues"].append(
                    {"column": column, "check": statistic, "n_failed": int(value)}
                )
        elif section == "null_counts":
            report["null_counts"][column] = int(value)
        elif section == "dtypes":
            report["dtypes"][column] = statistic
        elif section == "duplicates":
            report["duplicates"] = {"count": int(value), "has_duplicates": value > 0}
        elif section == "numeric_summary":
            report["numeric_summary"].setdefault(column, {})[statistic] = value
        elif is_null:
            # Kept apart from values, of which any may be spelt like a missing one.
            report["categorical_nulls"][column] = int(value)
        else:
            report["categorical_distribution"].setdefault(column, {})[statistic] = int(value)
    if output_dir:
        path = f"{output_dir}/validation_report.json"
        reports.write_document(df.sparkSession, report, path)
        report["output_path"] = path
        failures = expectations.failing_rows(df, rules, key)
        report["failure_cases_path"] = reports.write_rows(
            failures, f"{output_dir}/failure_cases.json"
        )
    return report


def placed_target(
    target: DataFrame, layout: Layout = CENSUS, folds: int = 0, seed: int = 42
) -> DataFrame:
    """The cleaned class, its 0/1 label, part and fold per ``row_id``.

    The split is fitted on this narrow table alone, before any join.
    """
    classes = binarize_label(
        clean_target(target, layout.target), layout.target, models.LABEL, layout.positive
    )
    return fit_split(classes, layout.target, ROW_ID, folds=folds, seed=seed).apply(classes)


def _load(spark: SparkSession, paths: Paths, layout: Layout) -> tuple[DataFrame, DataFrame]:
    return load_data(
        spark, paths.raw, paths.processed, layout.feature_schema, layout.target_schema
    )


def features_stage(
    spark: SparkSession, paths: Paths, layout: Layout = CENSUS, fit_scope: str = "train"
) -> dict[str, str]:
    """Fit the preprocessor and save its state.

    By default it sees the training part only; ``fit_scope='all'`` fits on all rows.
    """
    features, target = _load(spark, paths, layout)
    if fit_scope == "train":
        training = placed_target(target, layout).filter("part = 'train'").select(ROW_ID)
        # Scaler and encoder read the rows several times; they are joined once.
        features = materialize(features.join(training, ROW_ID), "training")
    elif fit_scope != "all":
        raise ValueError("fit_scope is 'train' or 'all'")
    fitted = fit_preprocessor(features, layout.num_cols, layout.cat_cols)
    return state.save_preprocessor(fitted, spark, f"{paths.artifacts}/preprocessor")


def design_table(
    features: DataFrame,
    target: DataFrame,
    preprocessor: Preprocessor,
    layout: Layout = CENSUS,
    folds: int = models.DEFAULT_FOLDS,
    seed: int = 42,
) -> DataFrame:
    """Encoded features, label, part, fold and cleaned group columns, written once.

    Group columns get the prefix ``group_``: a feature may have the same name. The
    text chain runs once, as a second run could strip more.
    """
    placed = features.join(placed_target(target, layout, folds, seed), ROW_ID)
    cleaned = clean_features(placed, preprocessor.cat_cols, preprocessor.missing_as_unknown)
    groups = [c for c in layout.dimensions if c in features.columns]
    cleaned = cleaned.withColumns({GROUP_PREFIX + c: quoted(c) for c in groups})
    keep = [ROW_ID, models.LABEL, "part", "fold", *[GROUP_PREFIX + c for c in groups]]
    return materialize(preprocessor.apply(cleaned, keep), "design")


def train(
    design: DataFrame,
    features: list[str],
    params: dict | None = None,
    experiment: str = "income",
    paths: Paths | None = None,
    folds: int = models.DEFAULT_FOLDS,
) -> dict:
    """Cross-validate and fit on the training part, test, log, save.

    The cross-validated predictions, one per training row, are stored too.
    """
    spark = design.sparkSession
    params = {**models.DEFAULT_PARAMS, **(params or {})}
    training = design.filter("part = 'train'")
    keep = [c for c in (ROW_ID,) if c in design.columns]
    fitted = models.cross_validate(
        training, features, models.boosted_trees(params), folds, keep=keep
    )
    held_out = models.score(fitted.model, design.filter("part = 'test'"), [models.LABEL])
    scores = {
        "f1_cv": fitted.f1_cv,
        "f1_cv_std": fitted.f1_cv_std,
        "f1_test": metrics.overall_metrics(held_out, models.LABEL).first()["f1_macro"],
    }
    out: dict = {
        "model": fitted.model,
        "metrics": {**scores, "params": params},
        "out_of_fold": fitted.out_of_fold,
    }
    if paths is not None:
        fitted.out_of_fold.write.mode("overwrite").parquet(paths.out_of_fold)
        out["model_path"] = state.save_model(fitted.model, paths.model)
        out["metrics_path"] = reports.write_document(
            spark, out["metrics"], f"{paths.artifacts}/metrics.json"
        )
        out["run_id"] = reports.log_run(
            spark, paths.runs, experiment, params, scores, out["model_path"]
        )
    return out


def scored_table(model, design: DataFrame) -> DataFrame:
    """Truth, prediction, score, part, fold and groups, written once for all metrics."""
    groups = [c for c in design.columns if c.startswith(GROUP_PREFIX)]
    scored = models.score(model, design, [ROW_ID, models.LABEL, "part", "fold", *groups])
    renamed = scored.withColumnsRenamed(
        {models.LABEL: "y_true", **{g: g.removeprefix(GROUP_PREFIX) for g in groups}}
    )
    return materialize(renamed, "scored")


def evaluate(
    scored: DataFrame, layout: Layout = CENSUS, paths: Paths | None = None
) -> dict:
    """Overall metrics and subgroup gaps of the test part as a nested document.

    The groups themselves are a table: ``groups`` in the result, and the rows at
    ``subgroups_path`` if ``paths`` are given.
    """
    test = scored.filter("part = 'test'") if "part" in scored.columns else scored
    has_score = test.filter(F.col("y_proba").isNotNull()).limit(1).count() > 0
    proba = "y_proba" if has_score else None
    dims = subgroups.dimensions_of(test, layout.dimensions)
    # The whole table is one more dimension, so everything follows from one set of counts.
    sums = materialize(
        subgroups.group_counts(test, {**dims, WHOLE: F.lit(WHOLE)}, score=proba), "counts"
    )
    whole = sums.filter(F.col("dimension") == WHOLE).drop("dimension", "group")
    if proba is not None:
        whole = metrics.one_row(whole)
    else:
        whole = whole.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in CELLS])
    summary = metrics.summary_of(whole).first()
    names = ("<=50K", ">50K") if layout.positive == POSITIVE_LABEL else ("0", "1")
    report = metrics.report_of(whole, names).collect()
    document: dict = {
        "accuracy": summary["accuracy"],
        "f1_macro": summary["f1_macro"],
        "f1_binary": summary["f1_binary"],
        "auc": summary["auc"],
        "confusion_matrix": [[summary["tn"], summary["fp"]], [summary["fn"], summary["tp"]]],
        "classification_report": [r.asDict() for r in report],
        "subgroup_metrics": {},
    }
    groups = None
    if dims:
        groups = subgroups.metrics_of(sums.filter(F.col("dimension") != WHOLE))
        for name in dims:
            document["subgroup_metrics"][name] = {}
        if paths is not None:
            document["subgroups_path"] = reports.write_rows(
                groups, f"{paths.artifacts}/subgroup_metrics.json"
            )
        for row in subgroups.subgroup_disparity(groups).collect():
            entry = row.asDict()
            document["subgroup_metrics"][entry.pop("dimension")]["disparity"] = entry
    if paths is not None:
        document["metrics_path"] = reports.write_document(
            test.sparkSession, document, f"{paths.artifacts}/evaluation_metrics.json"
        )
    return {**document, "groups": groups}


def ingest_stage(
    spark: SparkSession,
    path: str,
    paths: Paths,
    layout: Layout = CENSUS,
    key: str | None = None,
    schema: object = None,
) -> dict:
    """Ingest a landed table, ``path`` being its name without ``.parquet`` or ``.csv``."""
    source = read_table(spark, path, schema)
    return ingest(source, paths.raw, layout.features, layout.target, key)


def validate_stage(
    spark: SparkSession, paths: Paths, layout: Layout = CENSUS, strict: bool = False
) -> dict:
    """Validate the ingested features and write report and failing rows."""
    features = read_table(spark, f"{paths.raw}/features", layout.feature_schema)
    return validate(features, paths.processed, layout.rules, ROW_ID, strict)


def overfitting_stage(
    spark: SparkSession, paths: Paths, layout: Layout = CENSUS, f1_cv: float | None = None
) -> dict:
    """Score the raw tables with the stored model and check train against test.

    Unless it is given, the cross-validated score comes from the stored out-of-fold
    predictions; without them there is nothing to compare with, and the stage fails.
    """
    if f1_cv is None:
        f1_cv, _ = models.cv_scores(state.load_out_of_fold(spark, paths.out_of_fold))
    model = state.load_model(paths.model)
    preprocessor = state.load_preprocessor(spark, f"{paths.artifacts}/preprocessor")
    design = design_table(*_load(spark, paths, layout), preprocessor, layout)
    return check_overfitting(scored_table(model, design), f1_cv)


def compare_stage(
    spark: SparkSession, paths: Paths, layout: Layout = CENSUS, estimators: dict | None = None
) -> DataFrame:
    """Compare models on the raw tables, encoded with the stored preprocessor."""
    preprocessor = state.load_preprocessor(spark, f"{paths.artifacts}/preprocessor")
    design = design_table(*_load(spark, paths, layout), preprocessor, layout)
    return models.compare_models(
        design.filter("part = 'train'"),
        design.filter("part = 'test'"),
        preprocessor.feature_cols,
        estimators or models.comparison_models(),
    )


def evaluate_stage(spark: SparkSession, paths: Paths, layout: Layout = CENSUS) -> dict:
    """Load model, state and raw tables, derive the split again, and evaluate."""
    model = state.load_model(paths.model)
    preprocessor = state.load_preprocessor(spark, f"{paths.artifacts}/preprocessor")
    design = design_table(*_load(spark, paths, layout), preprocessor, layout)
    return evaluate(scored_table(model, design), layout, paths)


def train_stage(
    spark: SparkSession, paths: Paths, layout: Layout = CENSUS, params: dict | None = None
) -> dict:
    """Load state and raw tables, then train."""
    preprocessor = state.load_preprocessor(spark, f"{paths.artifacts}/preprocessor")
    design = design_table(*_load(spark, paths, layout), preprocessor, layout)
    return train(design, preprocessor.feature_cols, params, paths=paths)


def check_overfitting(scored: DataFrame, f1_cv: float) -> dict:
    """Train-test gaps with their verdict, and cross-validation against test.

    ``f1_cv`` has to come from predictions out of fold: those of the final model on the
    rows it was fitted on say nothing about rows it has not seen.
    """
    test = metrics.overall_metrics(scored.filter("part = 'test'")).first()
    diff = abs(f1_cv - test["f1_macro"])
    return {
        "gap": overfit_gap(scored).first().asDict(),
        "cv": {
            "f1_cv": f1_cv,
            "macro_diff": diff,
            "binary_diff": abs(f1_cv - test["f1_binary"]),
            "verdict": "check" if diff > CONSISTENCY_GAP else "consistent",
        },
    }


def run_all(
    source: DataFrame,
    root: str,
    layout: Layout = CENSUS,
    params: dict | None = None,
    key: str | None = None,
    fit_scope: str = "train",
) -> dict:
    """Ingest, validate, fit features, train, evaluate and check, one after the other.

    Training and evaluation share one design table and one scored table.
    """
    spark, paths = source.sparkSession, Paths(root)
    out: dict = {"ingest": ingest(source, paths.raw, layout.features, layout.target, key)}
    features = read_table(spark, f"{paths.raw}/features", layout.feature_schema)
    out["validate"] = validate(features, paths.processed, layout.rules, ROW_ID)
    if not out["validate"]["success"]:
        log.warning("validation found problems, going on: %s", out["validate"]["schema_issues"])
    out["features"] = features_stage(spark, paths, layout, fit_scope)
    preprocessor = state.load_preprocessor(spark, out["features"]["preprocessor"])
    design = design_table(*_load(spark, paths, layout), preprocessor, layout)
    out["train"] = train(design, preprocessor.feature_cols, params, paths=paths)
    scored = scored_table(out["train"]["model"], design)
    out["evaluate"] = evaluate(scored, layout, paths)
    out["overfitting"] = check_overfitting(scored, out["train"]["metrics"]["f1_cv"])
    return out
