import pytest
from pyspark.sql import functions as F, types as T

from tabaudit.operators import expectations as ex
from tabaudit.plans import census, stages


def failures(df, rules=census.RULES):
    return sorted(map(tuple, ex.failing_rows(df, rules, "row_id").collect()), key=str)


def test_valid_table_has_no_failures(census_rows):
    df = census_rows({}, {"age": 17, "hours-per-week": 99}, {"workclass": None, "age": 90})
    assert failures(df) == []
    assert ex.require_expectations(df, census.RULES) is df
    assert all(r.success for r in ex.verdict(df, census.RULES).collect())


@pytest.mark.parametrize(
    ("name", "bad", "check"),
    [
        ("age", 15, "in_range(17, 90)"),
        ("age", 10, "in_range(17, 90)"),
        ("age", 95, "in_range(17, 90)"),
        ("sex", "Invalid", "isin(Male, Female)"),
        ("education-num", 20, "in_range(1, 16)"),
        ("hours-per-week", 120, "in_range(1, 99)"),
        ("capital-gain", -100, "in_range(0, 100000)"),
        ("education", None, "not_nullable"),
    ],
)
def test_one_bad_value(census_rows, name, bad, check):
    df = census_rows({}, {name: bad})
    text = None if bad is None else str(bad)
    assert failures(df) == [(1, name, check, text)]
    with pytest.raises(ex.ExpectationError, match=name):
        ex.require_expectations(df, census.RULES)


def test_every_failure_is_reported(census_rows):
    df = census_rows({"age": 5, "sex": "x"}, {"age": None}, {"fnlwgt": 0})
    assert failures(df) == sorted(
        [
            (0, "age", "in_range(17, 90)", "5"),
            (0, "sex", "isin(Male, Female)", "x"),
            (1, "age", "not_nullable", None),
            (2, "fnlwgt", "in_range(1, 1500000)", "0"),
        ],
        key=str,
    )
    counts = {r.rule: r.n_failed for r in ex.verdict(df, census.RULES).collect() if not r.success}
    assert counts == {
        "age: in_range(17, 90)": 1,
        "age: not_nullable": 1,
        "sex: isin(Male, Female)": 1,
        "fnlwgt: in_range(1, 1500000)": 1,
    }


def test_a_null_does_not_change_the_type(census_rows):
    df = census_rows({"age": None})
    assert failures(df) == [(0, "age", "not_nullable", None)]


def test_missing_columns_and_wrong_types_have_no_row(spark):
    df = spark.createDataFrame([(1, "x", 2)], "row_id long, age string, fnlwgt int")
    found = failures(df)
    assert (None, "age", "dtype(bigint)", "string") in found
    assert (None, "fnlwgt", "dtype(bigint)", "int") in found
    assert sum(check == "column_in_dataframe" for _, _, check, _ in found) == 12
    assert all(row is None for row, *_ in found)


def test_unrelated_table_still_gives_a_report(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "a long")
    report = stages.validate(df)
    assert report["success"] is False
    assert len(report["schema_issues"]) == len(census.RULES)
    assert report["numeric_summary"]["a"]["mean"] == 2.0


def test_extra_columns_and_order_do_not_matter(census_rows):
    df = census_rows({}).withColumn("extra", F.lit(1))
    assert failures(df.select(*reversed(df.columns))) == []


def test_rules_on_an_empty_list(spark):
    df = spark.createDataFrame([(1,)], "a long")
    assert ex.failing_rows(df, [], None).count() == 0
    rule = ex.ColumnRule("a", T.LongType(), nullable=True)
    assert ex.failing_rows(df, [rule]).count() == 0


def test_report(census_rows, tmp_path, spark):
    df = census_rows({"workclass": None}, {})
    report = stages.validate(df, str(tmp_path), key="row_id")
    assert report["success"] is True
    assert report["schema_issues"] == []
    assert report["null_counts"]["workclass"] == 1
    assert report["dtypes"]["age"] == "bigint"
    assert report["duplicates"] == {"count": 0, "has_duplicates": False}
    assert report["numeric_summary"]["age"]["count"] == 2
    assert report["categorical_distribution"]["workclass"] == {"Private": 1}
    assert report["categorical_nulls"]["workclass"] == 1
    assert spark.read.json(report["output_path"]).count() == 1


def test_report_of_a_bad_table(census_rows, tmp_path, spark):
    report = stages.validate(census_rows({"age": 5}, {"age": 5}), str(tmp_path), key="row_id")
    assert report["success"] is False
    assert report["schema_issues"] == [
        {"column": "age", "check": "in_range(17, 90)", "n_failed": 2}
    ]
    assert report["duplicates"] == {"count": 1, "has_duplicates": True}
    assert spark.read.json(report["failure_cases_path"]).count() == 2
    with pytest.raises(ex.ExpectationError):
        stages.validate(census_rows({"age": 5}), strict=True)
