import pytest
from pyspark.sql import functions as F

from tabaudit.functions.text import clean_text, strip_text
from tabaudit.functions.values import age_bin
from tabaudit.operators import cleaning


def column(df, name):
    return [r[name] for r in df.collect()]


def texts(spark, *values, name="workclass"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string").coalesce(1)


def test_sentinels_become_null_in_string_columns_only(spark):
    df = spark.createDataFrame(
        [("Private", "?", 25), (" ?", "Sales", 30), ("Local-gov", None, 35)],
        "workclass string, occupation string, age long",
    ).coalesce(1)
    out = cleaning.null_sentinels(df)
    assert column(out, "workclass") == ["Private", None, "Local-gov"]
    assert column(out, "occupation") == [None, "Sales", None]
    assert column(out, "age") == [25, 30, 35]
    assert column(df, "workclass") == ["Private", " ?", "Local-gov"]


def test_other_spellings_of_the_sentinel_stay_a_category(spark):
    df = texts(spark, "? ", "  ?", "?.", "??")
    assert column(cleaning.clean_features(df, ["workclass"]), "workclass") == ["?", "?", "?", "??"]


def test_missing_is_one_category_or_unknown(spark):
    df = texts(spark, "?", " ?", None, "Private")
    assert column(cleaning.clean_features(df, ["workclass"]), "workclass") == [
        "nan", "nan", "nan", "Private",
    ]
    unknown = cleaning.clean_features(df, ["workclass"], missing_as_unknown=True)
    assert column(unknown, "workclass") == [None, None, None, "Private"]


def test_categoricals_lose_blanks_and_dots(spark):
    df = texts(spark, " Private ", " Local-gov", "Self-emp.", "Local-gov...")
    assert column(cleaning.clean_categoricals(df, ["workclass", "absent"]), "workclass") == [
        "Private", "Local-gov", "Self-emp", "Local-gov",
    ]


def test_blanks_go_before_dots_and_neither_goes_twice(spark):
    df = texts(spark, " b. .", "\tb\n", " b　", "\x1cb..", ". b", "")
    assert column(df.select(strip_text(F.col("workclass")).alias("t")), "t") == [
        "b. ", "b", "b", "b", ". b", "",
    ]


@pytest.mark.parametrize(
    ("dirty", "clean"),
    [
        ([">50K.", "<=50K.", ">50K."], [">50K", "<=50K", ">50K"]),
        ([" >50K ", "<=50K", "  >50K"], [">50K", "<=50K", ">50K"]),
        ([">50K", "<=50K"], [">50K", "<=50K"]),
    ],
)
def test_target(spark, dirty, clean):
    assert column(cleaning.clean_target(texts(spark, *dirty, name="income")), "income") == clean


def test_numbers_are_cleaned_as_text(spark):
    df = spark.createDataFrame([(1,), (None,)], "code int").coalesce(1)
    assert column(df.select(clean_text(F.col("code")).alias("t")), "t") == ["1", "nan"]


def test_labels(spark):
    df = texts(spark, ">50K", "<=50K", None, name="income")
    assert column(cleaning.binarize_label(df, "income"), "label") == [1, 0, 0]
    numbers = spark.createDataFrame([(1,), (0,)], "y int").coalesce(1)
    assert column(cleaning.binarize_label(numbers, "y"), "label") == [1, 0]


def test_age_bins_are_closed_on_the_right(spark):
    ages = [-3, 0, 1, 25, 26, 35, 45, 46, 55, 56, 100, 101, None]
    df = spark.createDataFrame([(a,) for a in ages], "age long").coalesce(1)
    assert column(df.select(age_bin(F.col("age")).alias("g")), "g") == [
        None, None, "<25", "<25", "25-35", "25-35", "35-45", "45-55", "45-55", ">55", ">55", None, None,
    ]


def test_roles_follow_types_in_table_order(spark):
    df = spark.createDataFrame(
        [], "s string, l long, flag boolean, d double, at timestamp, t string"
    )
    assert cleaning.infer_column_roles(df) == (["l", "d"], ["s", "t"])
    assert cleaning.infer_column_roles(df, ["d"], []) == (["d"], [])
    assert cleaning.infer_column_roles(df, None, ["t"]) == (["l", "d"], ["t"])
    # Inference runs because one list is missing, so an empty list is filled as well.
    assert cleaning.infer_column_roles(df, [], None) == (["l", "d"], ["s", "t"])


def test_flatten_target(spark):
    df = spark.createDataFrame([("a", 1)], "income string, other int")
    assert cleaning.flatten_target(df).columns == ["income"]
