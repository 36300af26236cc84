"""JSON reports and the run log."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

RUNS_SCHEMA = (
    "run_id string, experiment string, params map<string,string>, "
    "metrics map<string,double>, model_path string"
)


def write_rows(report: DataFrame, path: str) -> str:
    """A report table as JSON lines."""
    report.write.mode("overwrite").json(path)
    return path


def write_document(spark: SparkSession, document: dict, path: str) -> str:
    """One nested document, assembled from rows that are already aggregated."""
    text = json.dumps(document, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=False).first()["value"])


def log_run(
    spark: SparkSession,
    path: str,
    experiment: str,
    params: dict,
    metrics: dict[str, float],
    model_path: str | None = None,
) -> str:
    """Append one run to the log table and return its id."""
    run_id = uuid.uuid4().hex
    row = (
        run_id,
        experiment,
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
        model_path,
    )
    spark.createDataFrame([row], RUNS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(path)


def best_run(runs: DataFrame, experiment: str, metric: str = "f1_test") -> DataFrame:
    """The run of an experiment with the highest value of a metric."""
    value = F.col("metrics")[metric]
    return (
        runs.filter((F.col("experiment") == experiment) & value.isNotNull())
        .orderBy(value.desc(), "run_id")
        .limit(1)
    )
