import math
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabaudit.operators import profile
from tabaudit.operators.quantiles import quantiles


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_null_counts(census_rows):
    df = census_rows({}, {"age": None}, {"workclass": None})
    counts = as_dict(profile.null_counts(df), "column", "null_count")
    assert counts["age"] == 1 and counts["workclass"] == 1 and counts["sex"] == 0


def test_nan_counts_as_null_and_is_skipped(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "v double")
    assert as_dict(profile.null_counts(df), "column", "null_count") == {"v": 2}
    row = profile.numeric_summary(df).first()
    assert (row["count"], row["mean"], row["max"], row["q50"]) == (2, 2.0, 3.0, 2.0)


def test_null_report_keeps_columns_with_nulls_most_first(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5, None), (3, 6, 7)], "a int, b int, c int")
    assert [tuple(r) for r in profile.null_report(df).collect()] == [
        ("c", 2, 66.67), ("b", 1, 33.33),
    ]


def test_duplicates(census_rows):
    df = census_rows({}, {}, {"age": 50}).drop("row_id")
    assert tuple(profile.duplicate_rows(df).first()) == (3, 1, True)


def test_duplicates_tell_fields_nulls_and_signs_apart(spark):
    rows = [
        ("ab", "c", 0.0), ("a", "bc", 0.0),
        (None, "-", 1.0), ("-", None, 1.0),
        ("x", "y", 0.0), ("x", "y", -0.0),
        (None, None, None), (None, None, float("nan")),
        ("1:a", "", 2.0), ("1", ":a", 2.0),
    ]
    df = spark.createDataFrame(rows, "a string, b string, v double")
    assert profile.duplicate_rows(df).first()["n_duplicates"] == 2
    assert tuple(profile.duplicate_rows(df.limit(0)).first()) == (0, 0, False)


def test_duplicates_of_nested_and_other_types(spark):
    rows = spark.sql(
        "SELECT array(1, cast(null as int)) a, binary('x') b, timestamp'2024-01-01 00:00:00' t, "
        "cast(1.10 as decimal(5,2)) d, named_struct('k', 1) s FROM range(3)"
    )
    assert tuple(profile.duplicate_rows(rows).first()) == (3, 2, True)


def test_summary_of_one_row_and_of_no_values(spark):
    df = spark.createDataFrame([(4.0, None)], "v double, w double")
    rows = {r["column"]: r for r in profile.numeric_summary(df).collect()}
    assert rows["v"]["std"] is None and rows["v"]["q25"] == 4.0
    assert rows["w"]["count"] == 0 and rows["w"]["mean"] is None and rows["w"]["q50"] is None


@pytest.mark.parametrize("direct", [True, False])
def test_quantiles_match_linear_interpolation(spark, direct):
    rng = random.Random(5)
    heavy = [math.exp(rng.gauss(0, 6)) for _ in range(3000)]
    # A third of the rows share one value, the rest spans many magnitudes.
    values = heavy + [1.0] * 1500 + [-v for v in heavy[:700]]
    few = [float(rng.randrange(3)) for _ in values]
    df = spark.createDataFrame(list(zip(values, few)), "v double, k double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.731, 0.99, 1.0]
    limits = {} if direct else {"direct_limit": 0, "bracket_limit": 50, "sample_rows": 300}
    found = {(r["column"], r["prob"]): r["value"] for r in quantiles(df, ["v", "k"], probs, **limits).collect()}
    for name, data in (("v", values), ("k", few)):
        for p in probs:
            assert found[name, p] == pytest.approx(np.quantile(data, p), rel=1e-12), (name, p)


def test_top_values_break_ties_by_value_with_null_last(spark):
    rows = [(v,) for v in ["b", "b", "a", "a", None, None, "c"]]
    df = spark.createDataFrame(rows, "v string")
    out = profile.top_values(df, 3).orderBy("rank").collect()
    assert [(r["value"], r["n"]) for r in out] == [("a", 2), ("b", 2), (None, 2)]


@pytest.mark.parametrize("ties", [0, 1, 10_000])
@pytest.mark.parametrize("k", [1, 4, 7, 50])
def test_long_texts_rank_like_short_ones(spark, k, ties):
    words = ["a"] * 9 + ["b"] * 9 + [None] * 9 + ["c"] * 4 + list("defgh") * 2 + ["z"]
    df = spark.createDataFrame([(w and w * 100, w) for w in words], "long string, short string")
    out = profile.top_values(df, k, tie_limit=ties).collect()
    ranks = {
        name: {r["rank"]: (r["value"] and r["value"][0], r["n"]) for r in out if r["column"] == name}
        for name in df.columns
    }
    assert ranks["long"] == ranks["short"]
    assert len(ranks["short"]) == min(k, 10)
    assert profile.top_values(df.limit(0), k).count() == 0


@pytest.mark.parametrize("slots", [1, 7, 64])
@pytest.mark.parametrize("k", [1, 3, 10, 60])
def test_slots_keep_all_winners(spark, slots, k):
    rng = random.Random(k)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)] + [None] * 40 + list("ab") * 40
    df = spark.createDataFrame([(w, f"x{i}") for i, w in enumerate(words)], "skewed string, only string")
    kinds = ["skewed", "only"]
    plain = profile.top_values(df, k, kinds).collect()
    assert sorted(map(str, profile.top_values(df, k, kinds, slots=slots).collect())) == sorted(map(str, plain))
    assert profile.top_values(df.limit(0), k, kinds, slots=0).count() == 0


def test_slots_spare_the_shuffle_of_rare_values(spark):
    """A third of the rows hold ten values, the others 40,000 more."""
    values = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("hot"), F.col("id") % 10))
        .otherwise(F.col("id").cast("string"))
        .alias("v")
    )
    kept = profile.slot_survivors(values, ["v"], 10).distinct().count()
    assert 10 <= kept < 4_000
    top = profile.top_values(values, 10).orderBy("rank").collect()
    assert [(r["value"], r["n"]) for r in top] == [(f"hot{i}", 2000) for i in range(10)]


@pytest.mark.parametrize("pair_columns", [0, 12])
def test_correlation_handles_constants_and_nulls(spark, pair_columns):
    rows = [(1.0, 2.0, 7.0, 1.0), (2.0, 4.0, 7.0, None), (3.0, 7.0, 7.0, 2.0), (4.0, 8.0, 7.0, 9.0)]
    df = spark.createDataFrame(rows, "a double, b double, k double, n double")
    matrix = profile.correlation_matrix(df, pair_columns=pair_columns)
    r = {(x["col_a"], x["col_b"]): x["r"] for x in matrix.collect()}
    assert len(r) == 16
    assert r["a", "b"] == pytest.approx(statistics.correlation([1, 2, 3, 4], [2, 4, 7, 8]))
    assert r["a", "b"] == r["b", "a"]
    assert r["a", "k"] is None and r["k", "k"] is None
    assert r["a", "n"] == pytest.approx(statistics.correlation([1, 3, 4], [1, 2, 9]))
    assert r["n", "n"] == pytest.approx(1.0)


def test_shape_info_and_classes(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), ("y", 3)], "label string, v int")
    assert tuple(profile.table_shape(df).first()) == (3, 2)
    assert as_dict(profile.table_info(df), "column", "non_null") == {"label": 3, "v": 2}
    assert as_dict(profile.column_dtypes(df), "column", "dtype") == {"label": "string", "v": "int"}
    assert as_dict(profile.class_distribution(df, "label"), "label", "pct") == {
        "x": 66.67, "y": 33.33,
    }


def test_hot_value_is_combined_before_the_shuffle(spark):
    """A value that fills the table reaches the second stage once per task."""
    df = spark.range(1000).select(F.lit("hot").alias("v"))
    plan = profile.top_values(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert profile.top_values(df).first()["n"] == 1000


@pytest.mark.parametrize("pair_columns", [0, 12])
def test_correlation_of_complete_columns(spark, pair_columns):
    rows = [(float(i), 1e-9 * (i * 7 % 11), 5.0, float(-i)) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, small double, same double, down double")
    matrix = profile.correlation_matrix(df, pair_columns=pair_columns)
    r = {(x["col_a"], x["col_b"]): x["r"] for x in matrix.collect()}
    a, small = [x[0] for x in rows], [x[1] for x in rows]
    assert r["a", "small"] == pytest.approx(statistics.correlation(a, small))
    assert r["a", "down"] == pytest.approx(-1) and r["small", "small"] == pytest.approx(1)
    assert r["same", "a"] is None and r["same", "same"] is None
    one = profile.correlation_matrix(df.limit(1), pair_columns=pair_columns).collect()
    assert len(one) == 16 and all(x["r"] is None for x in one)


@pytest.mark.parametrize("block", [256, 64])
def test_wide_correlation_with_missing_values(spark, monkeypatch, block):
    """200 columns, a third of all values missing: every pair over the rows that have both."""
    monkeypatch.setattr(profile, "BLOCK_COLUMNS", block)
    draw = np.random.default_rng(5)
    table = draw.normal(size=(120, 200)) * 10.0 ** draw.integers(-3, 4, 200) + draw.normal(size=(120, 1))
    table[draw.random(table.shape) < 0.33] = np.nan
    table[:, 7] = 3.0
    table[:, 8] = np.nan
    names = [f"c{i}" for i in range(200)]
    df = spark.createDataFrame(pd.DataFrame(table, columns=names))
    got = profile.correlation_matrix(df).toPandas().pivot(index="col_a", columns="col_b", values="r")
    want = pd.DataFrame(table, columns=names).corr(min_periods=2)
    assert np.allclose(got.loc[names, names].to_numpy(), want.to_numpy(), atol=1e-9, equal_nan=True)
    aggregates = []
    monkeypatch.setattr(type(df), "agg", lambda self, *a, real=type(df).agg: aggregates.append(len(a)) or real(self, *a))
    profile.correlation_matrix(df)
    assert aggregates == [400]
