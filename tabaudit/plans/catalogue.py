"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabaudit.functions.values import age_bin
from tabaudit.operators import (
    audits,
    cleaning,
    diagnostics,
    encode,
    expectations,
    metrics,
    models,
    profile,
    profile_state,
    quantiles,
    ranking,
    split,
    subgroups,
)
from tabaudit.operators.expectations import ColumnRule
from tabaudit.plans import stages, views
from tabaudit.session import materialize, scratch_path
from tabaudit.sources import reports, state, tables

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

LONG, DOUBLE, TEXT = T.LongType(), T.DoubleType(), T.StringType()

LINE_RULES = (
    ColumnRule("l_orderkey", LONG),
    ColumnRule("l_quantity", DOUBLE, between=(1, 50)),
    ColumnRule("l_discount", DOUBLE, between=(0, 0.05)),
    ColumnRule("l_returnflag", TEXT, allowed=("A", "N")),
)

# A column with the wrong type and one that is not there, besides good ones.
LINE_TYPES = (
    *LINE_RULES,
    ColumnRule("l_linenumber", LONG),
    ColumnRule("l_comment", TEXT),
)

DIRTY_RULES = (
    ColumnRule("c_custkey", LONG),
    ColumnRule("seg_raw", TEXT),
    ColumnRule("label_raw", TEXT, allowed=(">50K", "<=50K")),
    ColumnRule("bal_null", DOUBLE, between=(0, 9000)),
)


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, without a negative zero."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return cleaning.replace_columns(
        df, {c: F.round(cleaning.quoted(c), digits) + F.lit(0.0) for c in doubles}
    )


# -- sources, sinks, shape ---------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    """Write both formats, read the CSV back with its schema."""
    customers = views.dirty_customers(spark, sf_dir)
    base = scratch_path(spark, "csv") + "/customers"
    tables.write_table(customers, base)
    return tables.read_table(spark, base, customers.schema, prefer=("csv", "parquet"))


def _broken_csv(spark, sf_dir) -> str:
    """Customers as lines of CSV, some of them with too many or too few fields or a broken number."""
    path = scratch_path(spark, "broken") + "/customers.csv"
    views.broken_lines(spark, sf_dir).write.text(path)
    return path


_CUSTOMER = "c_custkey long, c_name string, c_nationkey int"


@query
def csv_quarantine(spark, sf_dir):
    """The broken records of a CSV table and why they are broken."""
    path = _broken_csv(spark, sf_dir)
    _, bad = tables.read_csv_quarantined(spark, path, _CUSTOMER, header=False)
    return bad.select("raw", "reason")


@query
def csv_quarantine_counts(spark, sf_dir):
    """Good and broken records add up to the lines of the table."""
    path = _broken_csv(spark, sf_dir)
    good, bad = tables.read_csv_quarantined(spark, path, _CUSTOMER, header=False)
    return tables.quarantine_counts(spark, path, good, bad, header=False)


@query
def ingest_split(spark, sf_dir):
    """Feature and target tables, matched again on their shared row id."""
    source = views.dirty_customers(spark, sf_dir)
    features, target = tables.split_source(
        source, ["seg_raw", "bal_null", "c_nationkey"], "label_raw", key="c_custkey"
    )
    return features.join(target, tables.ROW_ID)


_KEYLESS = ["seg_raw", "label_raw", "c_nationkey"]


@query
def ingest_content_key(spark, sf_dir):
    """Ids of rows without a key, many of them equal, and the split that follows from the ids."""
    source = views.dirty_customers(spark, sf_dir).select(*_KEYLESS)
    features, target = tables.split_source(source, ["seg_raw", "c_nationkey"], "label_raw")
    placed = split.stratified_split(target, "label_raw", tables.ROW_ID)
    return features.join(placed, tables.ROW_ID)


@query
def ingest_summary(spark, sf_dir):
    source = views.dirty_customers(spark, sf_dir)
    return tables.ingest_summary(source, ["seg_raw", "bal_null", "c_nationkey"], "label_raw")


@query
def table_shape(spark, sf_dir):
    return profile.table_shape(views.table(spark, sf_dir, "lineitem"))


@query
def table_info(spark, sf_dir):
    return profile.table_info(views.dirty_customers(spark, sf_dir))


@query
def column_dtypes(spark, sf_dir):
    return profile.column_dtypes(views.table(spark, sf_dir, "documents"))


@query
def infer_column_roles(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    nums, cats = cleaning.infer_column_roles(orders)
    role = (
        F.when(F.col("column").isin(nums), "numeric")
        .when(F.col("column").isin(cats), "categorical")
        .otherwise("none")
    )
    return profile.table_info(orders).select("column", role.alias("role"), "non_null")


# -- cleaning ----------------------------------------------------------------


@query
def sentinel_to_null(spark, sf_dir):
    customers = views.dirty_customers(spark, sf_dir).select("c_custkey", "seg_raw")
    return cleaning.null_sentinels(customers)


@query
def clean_categoricals(spark, sf_dir):
    customers = views.dirty_customers(spark, sf_dir).select("c_custkey", "seg_raw")
    return cleaning.clean_features(customers, ["seg_raw", "not_there"])


@query
def flatten_target(spark, sf_dir):
    """The only column of a target table, whatever its name."""
    target = views.dirty_customers(spark, sf_dir).select("label_raw")
    return cleaning.flatten_target(target).toDF("label").groupBy("label").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def clean_target(spark, sf_dir):
    customers = views.dirty_customers(spark, sf_dir).select("c_custkey", "label_raw")
    return cleaning.clean_target(customers, "label_raw")


@query
def binarize_label(spark, sf_dir):
    customers = views.dirty_customers(spark, sf_dir).select("c_custkey", "label_raw")
    cleaned = cleaning.clean_target(customers, "label_raw")
    return cleaning.binarize_label(cleaned, "label_raw").select("c_custkey", "label")


@query
def age_bins(spark, sf_dir):
    return views.scored_orders(spark, sf_dir).select(
        "row_id", "age", age_bin(F.col("age")).alias("age_group")
    )


# -- profiling ---------------------------------------------------------------


@query
def null_counts(spark, sf_dir):
    return profile.null_counts(views.dirty_customers(spark, sf_dir))


@query
def null_pct_report(spark, sf_dir):
    return profile.null_report(cleaning.null_sentinels(views.dirty_customers(spark, sf_dir)))


@query
def duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(views.table(spark, sf_dir, "documents"), ["text", "lang"])


@query
def duplicate_rows_with_nulls(spark, sf_dir):
    return profile.duplicate_rows(
        views.dirty_customers(spark, sf_dir), ["seg_raw", "label_raw", "bal_null"]
    )


@query
def numeric_summary(spark, sf_dir):
    return rounded(profile.numeric_summary(views.table(spark, sf_dir, "lineitem")))


@query
def numeric_summary_narrowed(spark, sf_dir):
    """The same summary with quartiles found the way large tables need."""
    lines = views.table(spark, sf_dir, "lineitem")
    limits = {"direct_limit": 0, "bracket_limit": 1000, "sample_rows": 10_000}
    return rounded(profile.numeric_summary(lines, **limits))


@query
def exact_quantiles(spark, sf_dir):
    """Deciles of prices, narrowed more than once."""
    return rounded(
        quantiles.quantiles(
            views.table(spark, sf_dir, "lineitem"),
            ["l_extendedprice", "l_discount"],
            [0.1, 0.5, 0.9, 0.99],
            direct_limit=0,
            bracket_limit=100,
            sample_rows=1000,
        )
    )


@query
def profile_state_merged(spark, sf_dir):
    """Profiles of parts of a table with missing values, stored and merged."""
    customers = views.dirty_customers(spark, sf_dir)
    parts = profile_state.profile_states(customers, ["bal_null", "c_custkey"], by=["c_nationkey"])
    stored = materialize(parts, "profiles")
    return rounded(profile_state.summary(profile_state.merged(stored)))


SKETCH_PROBS = (0.1, 0.25, 0.5, 0.9)


@query
def sketched_quantile_bounds(spark, sf_dir):
    """Quantiles from merged sketches of parts, between exact ones at twice the sketch's rank error."""
    lines, names = views.table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"]
    parts = materialize(profile_state.profile_states(lines, names, by=["l_linenumber"]), "profiles")
    found = profile_state.sketched_quantiles(profile_state.merged(parts), SKETCH_PROBS)
    slack = 2 * profile_state.rank_error()
    ends = [F.round(F.col("prob") + sign * slack, 6).alias(side) for side, sign in (("below", -1), ("above", 1))]
    exact = quantiles.quantiles(
        lines, names, [round(p + sign * slack, 6) for p in SKETCH_PROBS for sign in (-1, 1)]
    ).select("column", F.round("prob", 6).alias("at"), F.col("value").alias("end"))
    # A few rows per column of the table.
    joined = found.select("*", *ends).join(F.broadcast(exact), "column")
    bounds = joined.groupBy("column", "prob", "n", "value").agg(
        F.max(F.when(F.col("at") == F.col("below"), F.col("end"))).alias("low"),
        F.max(F.when(F.col("at") == F.col("above"), F.col("end"))).alias("high"),
    )
    inside = F.col("value").between(F.col("low"), F.col("high"))
    return rounded(bounds.select("column", "prob", "n", "low", "high", inside.alias("inside")))


@query
def top_values_tied_texts(spark, sf_dir):
    """Texts of which nearly all occur once: only the first of them are looked at whole."""
    documents = views.table(spark, sf_dir, "documents")
    top = profile.top_values(documents, 5, ["text"], tie_limit=0)
    return top.select(F.md5(F.col("value").cast("binary")).alias("digest"), "n", "rank")


@query
def categorical_top10(spark, sf_dir):
    customers = views.dirty_customers(spark, sf_dir)
    return profile.top_values(customers, 10)


@query
def categorical_top10_texts(spark, sf_dir):
    return profile.top_values(views.table(spark, sf_dir, "documents"), 10)


@query
def top_words(spark, sf_dir):
    """Words of all documents: rare ones are ruled out by their hash slots."""
    text = views.table(spark, sf_dir, "documents").select(F.explode(F.split("text", "[ \n]")).alias("word"))
    return profile.top_values(text, 20, ["word"], slots=512)


@query
def target_distribution(spark, sf_dir):
    customers = cleaning.clean_target(views.dirty_customers(spark, sf_dir), "label_raw")
    return profile.class_distribution(customers, "label_raw")


@query
def correlation_matrix(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return rounded(
        profile.correlation_matrix(
            lines, ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        )
    )


@query
def correlation_matrix_wide(spark, sf_dir):
    """Thirty columns with missing values, from products of matrices."""
    return rounded(profile.correlation_matrix(views.gappy_lines(spark, sf_dir)))


@query
def validation_report_long(spark, sf_dir):
    customers = views.dirty_customers(spark, sf_dir)
    return rounded(stages.validation_rows(customers, DIRTY_RULES, key="c_custkey"))


# -- expectations ------------------------------------------------------------


@query
def expect_columns_and_types(spark, sf_dir):
    return expectations.columns_and_types(views.table(spark, sf_dir, "lineitem"), LINE_TYPES)


@query
def expect_not_null(spark, sf_dir):
    rules = (ColumnRule("seg_raw", TEXT), ColumnRule("bal_null", DOUBLE))
    return expectations.failing_rows(views.dirty_customers(spark, sf_dir), rules, "c_custkey")


@query
def expect_in_range(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return expectations.failing_rows(lines, LINE_RULES[1:3], "l_orderkey")


@query
def expect_in_set(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return expectations.failing_rows(lines, LINE_RULES[3:], "l_orderkey")


@query
def failure_cases(spark, sf_dir):
    return expectations.failing_rows(
        views.dirty_customers(spark, sf_dir),
        DIRTY_RULES,
        "c_custkey",
    )


@query
def strict_expectations(spark, sf_dir):
    """Strict mode hands a sound table on and names the rule that a bad one breaks."""
    orders = views.table(spark, sf_dir, "orders")
    sound = (ColumnRule("o_orderkey", LONG), ColumnRule("o_orderpriority", TEXT))
    kept = expectations.require_expectations(orders, sound).agg(F.count(F.lit(1)).alias("n"))
    try:
        expectations.require_expectations(orders, (ColumnRule("o_totalprice", DOUBLE, between=(0, 1)),))
        message = "nothing raised"
    except expectations.ExpectationError as error:
        message = str(error)
    return kept.select(F.col("n"), F.lit(message).alias("raised"))


@query
def failing_rows_text_key(spark, sf_dir):
    """Rows named by a text key."""
    customers = views.dirty_customers(spark, sf_dir)
    keyed = customers.withColumn("name", F.concat(F.lit("k"), "c_custkey")).drop("c_custkey")
    return expectations.failing_rows(keyed, DIRTY_RULES[1:2], "name")


@query
def failing_rows_nan(spark, sf_dir):
    """NaN is missing: it breaks a rule against nulls, not a range."""
    key = F.col("c_custkey")
    balances = views.table(spark, sf_dir, "customer").select(
        key, F.when(key % 5 == 0, float("nan")).otherwise(F.col("c_acctbal")).alias("balance")
    )
    ranged = ColumnRule("balance", DOUBLE, nullable=True, between=(-10_000, 10_000))
    rules = (ranged, ColumnRule("balance", DOUBLE))
    return expectations.failing_rows(balances, rules, "c_custkey").select("row_id", "column", "check")


@query
def validation_verdict(spark, sf_dir):
    return expectations.verdict(views.table(spark, sf_dir, "lineitem"), LINE_TYPES)


# -- encoders ----------------------------------------------------------------


def _order_training(spark, sf_dir):
    """Order features with their part, and the training part of them.

    Split, scaler and encoder all read the features, so the joins run once and
    their result is written.
    """
    features = materialize(views.order_features(spark, sf_dir), "order_features")
    rows = split.stratified_split(features, "label", "row_id")
    return rows, rows.filter("part = 'train'")


@query
def scaler_fit(spark, sf_dir):
    return rounded(
        encode.fit_scaler(views.order_features(spark, sf_dir), views.NUM_FEATURES)
    )


@query
def scaler_transform(spark, sf_dir):
    features = views.order_features(spark, sf_dir).select("row_id", *views.NUM_FEATURES)
    features = materialize(features, "order_features")
    fitted = encode.fit_preprocessor(features, views.NUM_FEATURES, [])
    return rounded(fitted.apply(features, ["row_id"]))


@query
def ordinal_fit(spark, sf_dir):
    return encode.fit_ordinal(
        views.table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_name"]
    )


@query
def ordinal_fit_ranges(spark, sf_dir):
    """The same codes, numbered range by range as large vocabularies are."""
    customers = views.table(spark, sf_dir, "customer")
    return encode.fit_ordinal(customers, ["c_mktsegment", "c_name"], sort_limit=100)


def _customer_training(spark, sf_dir):
    customers = views.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_name", F.col("c_nationkey").cast("string").alias("nation")
    )
    rows = split.stratified_split(customers, "c_mktsegment", "c_custkey")
    return rows, rows.filter("part = 'train'")


@query
def ordinal_transform(spark, sf_dir):
    """Fitted on the training part, so names of test customers are unseen."""
    rows, training = _customer_training(spark, sf_dir)
    cats = ["c_mktsegment", "c_name", "nation"]
    fitted = encode.fit_preprocessor(training, [], cats)
    return fitted.transform(rows, ["c_custkey"])


@query
def preprocess_data(spark, sf_dir):
    rows, training = _order_training(spark, sf_dir)
    fitted = encode.fit_preprocessor(training, views.NUM_FEATURES, views.CAT_FEATURES)
    return rounded(fitted.transform(rows, ["row_id"]))


@query
def preprocessor_state_roundtrip(spark, sf_dir):
    """Fit with inferred roles, save, load, transform."""
    customers = views.dirty_customers(spark, sf_dir)
    features = customers.drop("c_custkey")
    fitted = encode.fit_preprocessor(features)
    path = scratch_path(spark, "preprocessor")
    state.save_preprocessor(fitted, spark, path)
    return rounded(state.load_preprocessor(spark, path).transform(customers, ["c_custkey"]))


@query
def ordinal_transform_by_shuffle(spark, sf_dir):
    """The same codes, looked up by shuffle joins as those of large vocabularies are."""
    rows, training = _customer_training(spark, sf_dir)
    cats = ["c_mktsegment", "c_name", "nation"]
    fitted = encode.fit_preprocessor(training, [], cats)
    shuffled = encode.build_preprocessor(
        [], cats, {}, fitted.codes, inline_limit=0, broadcast_chars=0
    )
    return shuffled.transform(rows, ["c_custkey"])


@query
def ordinal_fit_long_prefix(spark, sf_dir):
    """Values that only differ behind a long common beginning."""
    names = views.table(spark, sf_dir, "customer").select(
        F.concat(F.repeat(F.lit("x"), 200), "c_name").alias("name")
    )
    codes = encode.fit_ordinal(names, ["name"], sort_limit=100)
    return codes.select(F.right("value", F.lit(18)).alias("ending"), "code")


# -- splits ------------------------------------------------------------------


def _orders_by_status(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("label")
    )


@query
def stratified_split(spark, sf_dir):
    return split.stratified_split(_orders_by_status(spark, sf_dir), "label", "row_id")


@query
def stratified_folds(spark, sf_dir):
    placed = split.stratified_folds(_orders_by_status(spark, sf_dir), "label", "row_id")
    # -1 stands for the test part, so that the column stays a plain integer.
    return placed.withColumn("fold", F.coalesce("fold", F.lit(-1)))


@query
def stratified_folds_many_classes(spark, sf_dir):
    """More classes than are inlined; keys are text."""
    orders = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("row_id"), (F.col("o_custkey") % 200).alias("label")
    )
    placed = split.stratified_folds(orders, "label", "row_id")
    return placed.withColumn("fold", F.coalesce("fold", F.lit(-1)))


# -- metrics -----------------------------------------------------------------


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(views.scored_orders(spark, sf_dir))


@query
def overall_metrics(spark, sf_dir):
    return rounded(metrics.overall_metrics(views.scored_orders(spark, sf_dir)))


@query
def classification_report(spark, sf_dir):
    return rounded(
        metrics.classification_report(
            views.scored_orders(spark, sf_dir), names=("<=50K", ">50K")
        )
    )


def _odd_scored(spark, sf_dir):
    """Scored orders, some without truth or prediction or with values other than 0 and 1."""
    key = F.col("row_id")
    return views.scored_orders(spark, sf_dir).withColumns(
        {
            "y_true": F.when(key % 13 != 0, F.when(key % 29 == 0, 2).otherwise(F.col("y_true"))),
            "y_pred": F.when(key % 7 != 0, F.when(key % 31 == 0, -1).otherwise(F.col("y_pred"))),
        }
    )


@query
def label_problems(spark, sf_dir):
    return metrics.label_problems(_odd_scored(spark, sf_dir))


@query
def metrics_of_valid_rows(spark, sf_dir):
    """Missing and odd labels are counted above and left out here."""
    return rounded(metrics.overall_metrics(metrics.valid_rows(_odd_scored(spark, sf_dir))))


@query
def classification_report_one_class(spark, sf_dir):
    """The absent class has zeros and takes no part in the macro averages."""
    ones = views.scored_orders(spark, sf_dir).filter("y_true = 1").withColumn("y_pred", F.lit(1))
    return rounded(metrics.classification_report(ones))


@query
def roc_auc_infinite_scores(spark, sf_dir):
    scored = views.scored_orders(spark, sf_dir)
    key, inf = F.col("row_id"), F.lit(float("inf"))
    score = F.when(key % 3 == 0, inf).when(key % 5 == 0, -inf).otherwise(F.col("y_proba"))
    return rounded(metrics.roc_auc(scored.withColumn("y_proba", score)))


@query
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(views.scored_orders(spark, sf_dir)))


@query
def evaluation_summary(spark, sf_dir):
    return rounded(metrics.evaluation_summary(views.scored_documents(spark, sf_dir)))


@query
def subgroup_metrics(spark, sf_dir):
    return rounded(
        subgroups.subgroup_metrics(views.scored_orders_by_region(spark, sf_dir), score=None).drop(
            "auc"
        )
    )


@query
def subgroup_auc(spark, sf_dir):
    # Score ranges come from the orders alone; the joined table has the same scores.
    edges = ranking.score_edges(views.scored_orders(spark, sf_dir), "y_proba")
    groups = subgroups.subgroup_metrics(
        views.scored_orders_by_region(spark, sf_dir), edges=edges
    )
    return rounded(groups.select("dimension", "group", "n_samples", "auc"))


@query
def subgroup_small_groups(spark, sf_dir):
    """Most origins are too small to report and some hold a single class."""
    documents = views.scored_documents(spark, sf_dir)
    return rounded(subgroups.subgroup_metrics(documents, {"origin": F.col("origin")}))


@query
def subgroup_disparity(spark, sf_dir):
    groups = subgroups.subgroup_metrics(views.scored_orders_by_region(spark, sf_dir), score=None)
    return rounded(subgroups.subgroup_disparity(groups))


# -- diagnostics, run log ----------------------------------------------------


def _scored_with_folds(spark, sf_dir):
    return split.stratified_folds(views.scored_orders(spark, sf_dir), "y_true", "row_id")


@query
def overfit_gap(spark, sf_dir):
    return rounded(diagnostics.overfit_gap(_scored_with_folds(spark, sf_dir)))


@query
def cv_test_consistency(spark, sf_dir):
    return rounded(diagnostics.cv_test_consistency(_scored_with_folds(spark, sf_dir)))


@query
def report_document(spark, sf_dir):
    """Confusion counts written as a nested document and as rows, and read again."""
    counts = metrics.confusion_matrix(views.scored_orders(spark, sf_dir))
    base = scratch_path(spark, "report")
    document = {"cells": [row.asDict() for row in counts.collect()]}
    reports.write_document(spark, document, f"{base}/document")
    rows = spark.read.json(reports.write_rows(counts, f"{base}/rows"))
    read = spark.createDataFrame(
        reports.read_document(spark, f"{base}/document")["cells"], "y_true int, y_pred int, n long"
    )
    return read.join(rows.withColumnRenamed("n", "n_rows"), ["y_true", "y_pred"])


@query
def run_log_best(spark, sf_dir):
    """Log one run per price threshold, then pick the best."""
    orders = views.scored_orders(spark, sf_dir)
    path = scratch_path(spark, "runs")
    limits = [0.4, 0.5, 0.6]
    # Every threshold is scored in the same pass.
    ruled = orders.select(
        "y_true",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(limit).alias("limit"),
                        (F.col("y_proba") >= limit).cast("int").alias("y_pred"),
                    )
                    for limit in limits
                ]
            )
        ),
    )
    counts = metrics.confusion_counts(ruled, by=["limit"])
    for row in metrics.score_counts(counts, ["limit"]).collect():
        scores = {"f1_test": row["f1_macro"], "accuracy": row["accuracy"]}
        reports.log_run(spark, path, "price-rule", {"limit": row["limit"]}, scores)
    best = reports.best_run(reports.read_runs(spark, path), "price-rule")
    return rounded(
        best.select(
            "experiment",
            F.col("params")["limit"].alias("limit"),
            F.col("metrics")["f1_test"].alias("f1_test"),
            F.col("metrics")["accuracy"].alias("accuracy"),
        )
    )


# -- models ------------------------------------------------------------------


def _binned_design(spark, sf_dir):
    """Orders in bins with part and fold under the noisy label."""
    features = views.binned_orders(spark, sf_dir)
    return materialize(split.stratified_folds(features, "label", "row_id"), "binned_design")


# One tree with one split: small enough for SQL to fit it too.
STUMP = {"n_estimators": 1, "max_depth": 1}


@query
def gbt_root_split(spark, sf_dir):
    """The first split and the leaf values of boosted trees, beside those that the rows call for."""
    training = _binned_design(spark, sf_dir).filter("part = 'train'")
    features = views.BINNED_FEATURES
    model = models.fit_model(training, features, models.boosted_trees(STUMP))
    return rounded(audits.root_splits(model, training, features))


@query
def gbt_predictions(spark, sf_dir):
    """Every order scored by a tree that has not seen it: training rows out of fold, test rows."""
    design = _binned_design(spark, sf_dir)
    predictions = models.model_predictions(
        design.filter("part = 'train'"),
        design.filter("part = 'test'"),
        views.BINNED_FEATURES,
        {"stump": models.boosted_trees(STUMP)},
        keep=["row_id"],
    )
    # -1 stands for the test part, so that the column stays a plain integer.
    return rounded(predictions.withColumn("fold", F.coalesce("fold", F.lit(-1))).drop("model"))


@query
def stump_cv_macro_f1(spark, sf_dir):
    """The train stage with one split a tree, under the noisy label: its scores, which SQL finds too."""
    scores = stages.train(_binned_design(spark, sf_dir), views.BINNED_FEATURES, STUMP)["metrics"]
    return rounded(
        spark.createDataFrame(
            [(scores["f1_cv"], scores["f1_cv_std"], scores["f1_test"])],
            "f1_cv double, f1_cv_std double, f1_test double",
        )
    )


@query
def model_moments_roundtrip(spark, sf_dir):
    """A stored and loaded logistic regression reproduces the moments of its training rows."""
    training = _binned_design(spark, sf_dir).filter("part = 'train'")
    features = views.BINNED_FEATURES
    model = models.fit_model(training, features, models.logistic_regression(tol=1e-10))
    path = scratch_path(spark, "model")
    state.save_model(model, path)
    scored = models.score(state.load_model(path), training, [*features, models.LABEL])
    found = audits.moments(scored, features)
    # Equal up to a gradient of 1e-6 counts as equal; anything else shows.
    near = F.abs(F.col("fitted") - F.col("observed")) < 1e-6
    return rounded(found.withColumn("fitted", F.when(near, F.col("observed")).otherwise(F.col("fitted"))))


@query
def small_model_ranking(spark, sf_dir):
    """Three kinds of model over one feature, at sizes that SQL can fit too."""
    design = _binned_design(spark, sf_dir)
    return rounded(
        models.compare_models(
            design.filter("part = 'train'"),
            design.filter("part = 'test'"),
            ["price_bin"],
            {
                "LogisticRegression": models.logistic_regression(tol=1e-10),
                "RandomForest": models.random_forest(1, bootstrap=False, maxDepth=1),
                # Says yes only where it is sure, so it differs from the others.
                "GradientBoosting": models.boosted_trees(
                    {"n_estimators": 1, "max_depth": 2}
                ).setThresholds([0.2, 0.8]),
            },
        )
    )


def _design(spark, sf_dir, finished=True):
    """Encoded order features with part and fold, and their names.

    Whether an order is finished is decided by one of the features, so the right
    predictions are known. The other label, whether it is costly, is noisy.
    """
    features = views.order_features(spark, sf_dir)
    if finished:
        label = (F.col("o_orderstatus") == "F").cast("int")
        features = features.withColumn("label", label)
    features = materialize(features, "order_features")
    rows = split.stratified_folds(features, "label", "row_id")
    fitted = encode.fit_preprocessor(
        rows.filter("part = 'train'"), views.NUM_FEATURES, views.CAT_FEATURES
    )
    keep = ["row_id", "label", "part", "fold"]
    return materialize(fitted.transform(rows, keep), "design"), fitted.feature_cols


def _gbt_scored(spark, sf_dir, finished):
    """The test part, scored by trees of the published size."""
    design, features = _design(spark, sf_dir, finished)
    model = models.fit_model(design.filter("part = 'train'"), features, models.boosted_trees())
    scored = models.score(model, design.filter("part = 'test'"), ["row_id", "label"])
    return materialize(scored, "scored")


@query
def gbt_scored(spark, sf_dir):
    """Label and prediction of every order in the test part."""
    scored = _gbt_scored(spark, sf_dir, True)
    return scored.select("row_id", "label", "y_pred", (F.col("y_proba") > 0.5).alias("likely"))


@query
def gbt_scored_noisy(spark, sf_dir):
    """Rows and labels of the test part under a noisy label; predictions follow probabilities."""
    scored = _gbt_scored(spark, sf_dir, False)
    agrees = (F.col("y_pred") == 1) == (F.col("y_proba") > 0.5)
    return scored.select("row_id", "label", agrees.alias("agrees"))


@query
def gbt_holdout_metrics(spark, sf_dir):
    """Train, then test: overall metrics of the held-out part."""
    return rounded(metrics.evaluation_summary(_gbt_scored(spark, sf_dir, True), "label"))


@query
def gbt_cv_macro_f1(spark, sf_dir):
    """The train stage at its published size: cross-validated macro F1, its deviation, that of the test part."""
    scores = stages.train(*_design(spark, sf_dir))["metrics"]
    return rounded(
        spark.createDataFrame(
            [(scores["f1_cv"], scores["f1_cv_std"], scores["f1_test"])],
            "f1_cv double, f1_cv_std double, f1_test double",
        )
    )


@query
def model_state_roundtrip(spark, sf_dir):
    """A stored and loaded logistic regression over all features predicts the whole test part."""
    design, features = _design(spark, sf_dir)
    model = models.fit_model(design.filter("part = 'train'"), features, models.logistic_regression())
    path = scratch_path(spark, "model")
    state.save_model(model, path)
    test = design.filter("part = 'test'")
    return models.score(state.load_model(path), test, ["row_id", "label"]).drop("y_proba")


@query
def model_ranking(spark, sf_dir):
    """The three compared models at their published sizes over all features."""
    design, features = _design(spark, sf_dir)
    return rounded(
        models.compare_models(
            design.filter("part = 'train'"),
            design.filter("part = 'test'"),
            features,
            models.comparison_models(),
        )
    )
