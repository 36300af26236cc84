import math

import pytest
from pyspark.sql import functions as F

from tabaudit.operators import encode
from tabaudit.plans import census
from tabaudit.sources import state


def codes_of(df):
    return {(r["column"], r["value"]): r["code"] for r in df.collect()}


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (4.0, 5)], "v double, k int")
    stats = {r["column"]: r for r in encode.fit_scaler(df, ["v", "k"]).collect()}
    assert stats["v"]["mean"] == pytest.approx(7 / 3)
    assert stats["v"]["scale"] == pytest.approx(math.sqrt(14 / 9))
    assert stats["k"]["scale"] == 1.0


def test_codes_follow_code_points(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "B", "é", "a", "10", "9", "a", None]], "c string")
    assert codes_of(encode.fit_ordinal(df, ["c"])) == {
        ("c", v): float(i) for i, v in enumerate(["10", "9", "B", "a", "b", "é"])
    }


def test_codes_by_ranges_equal_codes_by_one_sort(spark):
    names = spark.range(2000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("c"), (F.col("id") % 3).cast("string").alias("d")
    )
    by_sort = codes_of(encode.fit_ordinal(names, ["c", "d"]))
    by_range = codes_of(encode.fit_ordinal(names, ["c", "d"], sort_limit=150))
    assert by_range == by_sort and len(by_sort) == 2003


@pytest.mark.parametrize(
    "limits",
    [{}, {"inline_limit": 0}, {"inline_limit": 0, "broadcast_chars": 0}],
    ids=["inlined", "broadcast", "shuffled"],
)
def test_unseen_values_get_minus_one_whatever_the_lookup(spark, limits):
    train = spark.createDataFrame([("a", 1.0), ("c", 3.0)], "c string, v double")
    codes = encode.fit_ordinal(train, ["c"])
    fitted = encode.build_preprocessor(["v"], ["c"], {"v": (2.0, 1.0)}, codes, **limits)
    new = spark.createDataFrame([(1, "a", 2.0), (2, "b", 2.0), (3, "c", 5.0), (4, None, 2.0)], "id int, c string, v double")
    out = sorted(map(tuple, fitted.apply(new, ["id"]).collect()))
    assert out == [(1, 0.0, 0.0), (2, 0.0, -1.0), (3, 3.0, 1.0), (4, 0.0, -1.0)]


def test_features_are_numeric_first_and_the_rest_is_dropped(random_people):
    fitted = encode.fit_preprocessor(random_people, census.NUM_COLS, census.CAT_COLS)
    out = fitted.transform(random_people)
    assert out.columns == [*census.NUM_COLS, *census.CAT_COLS]
    assert set(dict(out.dtypes).values()) == {"double"}
    assert out.count() == 100
    row = out.agg(F.avg("age"), F.stddev_pop("age")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1)


def test_state_round_trip(spark, random_people, tmp_path):
    fitted = encode.fit_preprocessor(random_people.drop("row_id", "income"))
    saved = state.save_preprocessor(fitted, spark, str(tmp_path / "pre"))
    assert set(saved) == {"preprocessor", "scaler_stats", "category_codes", "preprocessor_meta"}
    loaded = state.load_preprocessor(spark, saved["preprocessor"])
    # Inferred roles come in table order.
    assert loaded.num_cols == census.NUM_COLS and loaded.cat_cols == census.CAT_COLS
    before = sorted(map(tuple, fitted.transform(random_people, ["row_id"]).collect()))
    after = sorted(map(tuple, loaded.transform(random_people, ["row_id"]).collect()))
    assert before == after
    with pytest.raises(FileNotFoundError):
        state.load_preprocessor(spark, str(tmp_path / "nothing"))


def test_sentinel_rows_survive_and_are_a_category(census_rows):
    df = census_rows({}, {"workclass": "?"}, {"workclass": "Local-gov"})
    fitted = encode.fit_preprocessor(df, census.NUM_COLS, census.CAT_COLS)
    out = {r["row_id"]: r["workclass"] for r in fitted.transform(df, ["row_id"]).collect()}
    # 'Local-gov' < 'Private' < 'nan'
    assert out == {0: 1.0, 1: 2.0, 2: 0.0}
    unknown = encode.fit_preprocessor(
        df, census.NUM_COLS, census.CAT_COLS, missing_as_unknown=True
    )
    out = {r["row_id"]: r["workclass"] for r in unknown.transform(df, ["row_id"]).collect()}
    assert out == {0: 1.0, 1: -1.0, 2: 0.0}


def test_a_column_of_nulls_has_no_codes(spark):
    df = spark.createDataFrame([(None,), (None,)], "c string")
    fitted = encode.fit_preprocessor(df, [], ["c"], missing_as_unknown=True)
    assert [r["c"] for r in fitted.transform(df).collect()] == [-1.0, -1.0]
