"""States of parts, merged, against one pass; broken CSV records."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from tabaudit.operators import profile_state
from tabaudit.sources import tables


@pytest.fixture
def grown(spark):
    """Three parts of very different sizes and means, one without values."""
    values = F.when(F.col("id") < 5000, F.col("id") % 997 + 1e6).when(F.col("id") < 5010, F.col("id") / 7.0)
    part = F.when(F.col("id") < 5000, "a").when(F.col("id") < 5010, "b")
    return spark.range(5020).select(part.alias("part"), values.alias("v"))


def test_merged_states_equal_one_pass(grown):
    states = profile_state.profile_states(grown, ["v"], by=["part"])
    assert states.count() == 3
    row = profile_state.summary(profile_state.merged(states)).first()
    values = [r.v for r in grown.collect() if r.v is not None]
    assert (row["n_rows"], row["count"], row["null_count"]) == (5020, 5010, 10)
    assert math.isclose(row["mean"], statistics.fmean(values), rel_tol=1e-12)
    assert math.isclose(row["std"], statistics.stdev(values), rel_tol=1e-9)
    assert (row["min"], row["max"]) == (min(values), max(values))
    # Merging in two steps changes nothing but the order of sums.
    first = profile_state.merged(states.filter("part = 'a'"))
    rest = profile_state.merged(states.filter("part is null or part = 'b'"))
    again = profile_state.summary(profile_state.merged(first.unionByName(rest))).first()
    assert again["count"] == row["count"] and math.isclose(again["std"], row["std"], rel_tol=1e-9)


def test_merged_by_a_key_that_may_be_null(grown):
    states = profile_state.profile_states(grown, ["v"], by=["part"])
    out = {r["part"]: r for r in profile_state.summary(profile_state.merged(states, by=["part"])).collect()}
    assert {k: r["count"] for k, r in out.items()} == {"a": 5000, "b": 10, None: 0}
    assert out[None]["mean"] is None and out[None]["std"] is None and out[None]["null_count"] == 10


def test_sketched_quantiles_keep_their_bound(spark):
    """One part holds a third of the rows, the others are many and small."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("part"),
        (F.col("id") * 7919 % 60_000).cast("double").alias("v"),
    )
    states = profile_state.profile_states(df, ["v"], by=["part"], k=400)
    probs = (0.01, 0.25, 0.5, 0.99)
    rows = profile_state.sketched_quantiles(profile_state.merged(states), probs).collect()
    slack = 2 * profile_state.rank_error(400)
    assert {r["n"] for r in rows} == {60_000}
    assert all(abs(r["value"] / 60_000 - r["prob"]) <= slack for r in rows)


def test_states_of_no_rows_and_no_values(spark):
    empty = spark.createDataFrame([], "v double")
    states = profile_state.merged(profile_state.profile_states(empty))
    assert profile_state.summary(states).first()["count"] == 0
    assert profile_state.sketched_quantiles(states, [0.5]).first()["value"] is None
    with pytest.raises(ValueError):
        profile_state.profile_states(spark.createDataFrame([], "t string"))


def test_broken_records_are_set_aside(spark, tmp_path):
    folder = tmp_path / "x.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('id,t,_raw\n1,a,0.5\n2,"b, c",x\n\n3,d\n4,e,1,2\n')
    (folder / "b.csv").write_text("id,t,_raw\nz,f,1.5\n,,\n")
    schema = "id long, t string, _raw double"
    good, bad = tables.read_csv_quarantined(spark, str(folder), schema)
    assert good.columns == ["id", "t", "_raw"]
    assert {tuple(r) for r in good.collect()} == {(1, "a", 0.5), (None, None, None)}
    assert {(r["raw"], r["file"][-5:], r["reason"]) for r in bad.collect()} == {
        ('2,"b, c",x', "a.csv", "value of _raw"),
        ("3,d", "a.csv", "fields"),
        ("4,e,1,2", "a.csv", "fields"),
        ("z,f,1.5", "b.csv", "value of id"),
    }
    assert tuple(tables.quarantine_counts(spark, str(folder), good, bad).first()) == (6, 2, 4, True)
