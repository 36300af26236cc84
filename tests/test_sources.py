import pytest
from pyspark.sql import functions as F

from tabaudit.plans import census
from tabaudit.session import materialize, scratch_path
from tabaudit.operators.split import stratified_split
from tabaudit.sources import reports, tables

SCHEMA = "id long, t string, v double"


@pytest.fixture
def rows(spark):
    data = [(1, " ?", 0.1), (2, None, None), (3, 'say "hi", x', -1e-7), (4, " b.. ", 2.0)]
    return spark.createDataFrame(data, SCHEMA)


def content(df):
    return sorted(map(tuple, df.collect()))


def test_csv_keeps_blanks_quotes_and_nulls(rows, spark, tmp_path):
    tables.write_csv(rows, str(tmp_path / "x.csv"))
    assert content(tables.read_csv(spark, str(tmp_path / "x.csv"), SCHEMA)) == content(rows)


def test_line_breaks_need_multi_line(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb", 1.0)], SCHEMA)
    path = str(tmp_path / "x.csv")
    tables.write_csv(df, path)
    assert content(tables.read_csv(spark, path, SCHEMA, multi_line=True)) == content(df)
    with pytest.raises(Exception, match="MALFORMED"):
        tables.read_csv(spark, path, SCHEMA).collect()


def test_timestamps_survive_csv(spark, tmp_path):
    df = spark.sql("SELECT timestamp'2024-03-01 10:11:12.123456' AS at, 1 AS n")
    tables.write_csv(df, str(tmp_path / "t.csv"))
    assert content(tables.read_csv(spark, str(tmp_path / "t.csv"), df.schema)) == content(df)


def test_both_formats_are_written_and_preference_decides(rows, spark, tmp_path):
    base = str(tmp_path / "table")
    assert tables.write_table(rows, base) == [f"{base}.parquet", f"{base}.csv"]
    marked = rows.withColumn("t", F.lit("from csv"))
    tables.write_csv(marked, f"{base}.csv")
    assert "from csv" not in {r["t"] for r in tables.read_table(spark, base, SCHEMA).collect()}
    first = tables.read_table(spark, base, SCHEMA, prefer=("csv", "parquet"))
    assert {r["t"] for r in first.collect()} == {"from csv"}


def test_reading_falls_back_and_fails_clearly(rows, spark, tmp_path):
    tables.write_csv(rows, str(tmp_path / "only.csv"))
    assert tables.read_table(spark, str(tmp_path / "only"), SCHEMA).count() == 4
    with pytest.raises(ValueError, match="schema"):
        tables.read_table(spark, str(tmp_path / "only"))
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"), SCHEMA)


def test_one_failing_sink_is_tolerated(rows, tmp_path, monkeypatch, spark):
    def broken(*_):
        raise OSError("disk full")

    monkeypatch.setattr(tables, "write_csv", broken)
    base = str(tmp_path / "a")
    assert tables.write_table(rows, base) == [f"{base}.parquet"]
    # Binary columns cannot go to CSV, and here Parquet is blocked by a file.
    (tmp_path / "b.parquet").mkdir()
    (tmp_path / "c").write_text("a file, not a folder")
    with pytest.raises(OSError, match="disk full"):
        tables.write_table(rows, str(tmp_path / "c" / "x"))


def test_parquet_failure_leaves_csv(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(tables, "write_csv", lambda df, path: written.append(path))
    # Parquet has no type for an interval column of this kind.
    df = spark.sql("SELECT make_interval(1) AS i")
    assert tables.write_table(df, str(tmp_path / "x")) == [str(tmp_path / "x.csv")] == written


def test_nan_becomes_null_on_read(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "v double").write.parquet(str(tmp_path / "n.parquet"))
    assert [r["v"] for r in tables.read_table(spark, str(tmp_path / "n")).orderBy("v").collect()] == [None, 1.0]


def test_split_source(spark):
    source = spark.createDataFrame([(7, "a", ">50K"), (9, "b", "<=50K")], "k int, f string, income string")
    features, target = tables.split_source(source, ["f"], "income", key="k")
    assert sorted(map(tuple, features.join(target, "row_id").collect())) == [
        (7, "a", ">50K"), (9, "b", "<=50K"),
    ]
    with pytest.raises(ValueError, match="no column g"):
        tables.split_source(source, ["f", "g"], "income")


def test_ids_without_a_key_are_fixed_by_a_write(spark):
    source = spark.range(1000).repartition(5).select(F.col("id").alias("f"), (F.col("id") * 2).alias("y"))
    features, target = tables.split_source(source, ["f"], "y")
    joined = features.join(target, "row_id")
    assert joined.count() == 1000 and joined.filter("y != 2 * f").count() == 0


def test_ingest_and_load(random_people, spark, tmp_path):
    out = tables.ingest(random_people, str(tmp_path / "raw"), census.FEATURE_COLS, "income", "row_id")
    assert out["n_rows"] == 100 and out["n_features"] == 14
    sizes = {r["label"]: r["n"] for r in out["target_dist"].collect()}
    assert set(sizes) == {" >50K.", "<=50K"} and sum(sizes.values()) == 100
    assert len(out["written_files"]) == 6
    X, y = tables.load_data(spark, str(tmp_path / "raw"), str(tmp_path / "processed"))
    assert X.columns == ["row_id", *census.FEATURE_COLS] and y.columns == ["row_id", "income"]
    X.limit(3).write.parquet(str(tmp_path / "processed" / "features_processed.parquet"))
    X, y = tables.load_data(spark, str(tmp_path / "raw"), str(tmp_path / "processed"))
    assert (X.count(), y.count()) == (3, 100)


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    ids = [reports.log_run(spark, path, "e", {"d": i}, {"f1_test": f}) for i, f in enumerate([0.5, 0.9, 0.7])]
    reports.log_run(spark, path, "other", {}, {"f1_test": 1.0})
    reports.log_run(spark, path, "e", {}, {"loss": 5.0})
    best = reports.best_run(reports.read_runs(spark, path), "e").collect()
    assert [(r["run_id"], r["params"]["d"]) for r in best] == [(ids[1], "1")]


def test_documents(spark, tmp_path):
    path = reports.write_document(spark, {"a": [1, None], "é": {"b": 0.5}}, str(tmp_path / "d.json"))
    assert reports.read_document(spark, path) == {"a": [1, None], "é": {"b": 0.5}}


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base) and a != b
    assert materialize(spark.range(3)).count() == 3


def test_content_ids_do_not_depend_on_partitions(spark):
    hot = spark.range(100_000).select(F.lit("hot").alias("f"), F.lit(None).cast("double").alias("x"), F.lit("p").alias("y"))
    other = spark.range(500).select(
        (F.col("id") % 150).cast("string").alias("f"), (F.col("id") % 3 / 4).alias("x"), (F.col("id") % 2).cast("string").alias("y")
    )
    rows = tables.materialize(hot.unionByName(other), "rows")
    seen = set()
    for n in (1, 8, 200):
        dealt = rows.repartition(n) if n > 1 else rows.coalesce(1)
        features, target = tables.split_source(dealt, ["f", "x"], "y")
        ids = features.select(tables.ROW_ID)
        assert ids.count() == ids.distinct().count() == 100_500
        placed = stratified_split(target, "y", tables.ROW_ID)
        joined = features.join(placed, tables.ROW_ID)
        sums = joined.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("row_id", "f", "x", "y", "part").cast("decimal(38,0)"))
        ).first()
        seen.add(tuple(sums))
    assert len(seen) == 1 and next(iter(seen))[0] == 100_500


def test_content_ids_of_odd_tables(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, 0.0), (2, None, -0.0)]
    df = spark.createDataFrame(rows, "_part int, `a.b` string, _digest double")
    got = tables.with_content_id(df, "id")
    assert got.columns == ["_part", "a.b", "_digest", "id"]
    assert sorted(r.id.split("-")[1] for r in got.collect()) == ["0", "0", "1", "1"]
    assert tables.with_content_id(df.limit(0), "id").count() == 0
