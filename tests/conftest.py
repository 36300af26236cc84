"""Session and small tables shared by the tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F, types as T  # noqa: E402

from tabaudit.plans import census  # noqa: E402
from tabaudit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("checkpoints")
    session = local_session(
        "4", "tests", **{"spark.checkpoint.dir": str(folder), "spark.sql.shuffle.partitions": "4"}
    )
    yield session
    session.stop()


VALID_ROW = {
    "age": 39,
    "workclass": "Private",
    "fnlwgt": 77516,
    "education": "Bachelors",
    "education-num": 13,
    "marital-status": "Never-married",
    "occupation": "Sales",
    "relationship": "Husband",
    "race": "White",
    "sex": "Male",
    "capital-gain": 2174,
    "capital-loss": 0,
    "hours-per-week": 40,
    "native-country": "United-States",
}


@pytest.fixture
def census_rows(spark):
    """Build a census table from the changes each row makes to a valid one."""

    def build(*changes: dict):
        schema = T.StructType([T.StructField("row_id", T.LongType()), *census.FEATURE_SCHEMA])
        rows = [
            tuple([i, *({**VALID_ROW, **change}[c] for c in census.FEATURE_COLS)])
            for i, change in enumerate(changes)
        ]
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture(scope="session")
def random_people(spark):
    """100 people drawn from hashes of their row id, with an income that depends on them."""

    def draw(name: str, low: int, high: int):
        return F.pmod(F.xxhash64("row_id", F.lit(name)), F.lit(high - low)) + low

    def pick(name: str, *values: str):
        return F.element_at(F.array(*map(F.lit, values)), (draw(name, 0, len(values)) + 1).cast("int"))

    people = spark.range(100).select(F.col("id").alias("row_id")).select(
        "row_id",
        draw("age", 25, 65).alias("age"),
        pick("workclass", "Private", "?", "Local-gov", " Self-emp.").alias("workclass"),
        draw("fnlwgt", 50000, 400000).alias("fnlwgt"),
        pick("education", "Bachelors", "HS-grad", "Masters", "11th").alias("education"),
        draw("education-num", 8, 16).alias("education-num"),
        pick("marital", "Married", "Never-married", "Divorced").alias("marital-status"),
        pick("occupation", "Sales", "Tech-support", "?", "Craft-repair").alias("occupation"),
        pick("relationship", "Husband", "Wife", "Own-child", "Unmarried").alias("relationship"),
        pick("race", "White", "Black", "Other").alias("race"),
        pick("sex", "Male", "Female").alias("sex"),
        draw("gain", 0, 5000).alias("capital-gain"),
        draw("loss", 0, 500).alias("capital-loss"),
        draw("hours", 30, 60).alias("hours-per-week"),
        pick("country", "United-States", "Mexico", "India", "Cuba").alias("native-country"),
    )
    rich = F.col("age") + F.col("hours-per-week") + draw("noise", 0, 20) > 100
    return people.withColumn(
        "income", F.when(rich, F.lit(" >50K.")).otherwise(F.lit("<=50K"))
    ).cache()


@pytest.fixture
def scored(spark):
    """A scored table from (y_true, y_pred, how many) or full rows."""

    def build(rows, schema="y_true int, y_pred int, y_proba double"):
        return spark.createDataFrame(rows, schema)

    return build
