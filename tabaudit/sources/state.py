"""Fitted preprocessors and models on shared storage."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from py4j.protocol import Py4JJavaError

from tabaudit.operators.encode import SCALER_SCHEMA, Preprocessor, build_preprocessor

SCALER, CODES, META = "scaler_stats", "category_codes", "preprocessor_meta"

_META_SCHEMA = "num_cols array<string>, cat_cols array<string>, missing_as_unknown boolean"


def save_preprocessor(fitted: Preprocessor, spark: SparkSession, path: str) -> dict[str, str]:
    """Write scaler statistics, category codes and column lists as Parquet tables."""
    stats = [(c, *fitted.scaler[c]) for c in fitted.num_cols]
    meta = [(fitted.num_cols, fitted.cat_cols, fitted.missing_as_unknown)]
    tables = {
        SCALER: spark.createDataFrame(stats, SCALER_SCHEMA),
        CODES: fitted.codes,
        META: spark.createDataFrame(meta, _META_SCHEMA),
    }
    saved = {name: f"{path}/{name}" for name in tables}
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(saved[name])
    return {"preprocessor": path, **saved}


def load_preprocessor(spark: SparkSession, path: str) -> Preprocessor:
    try:
        meta = spark.read.schema(_META_SCHEMA).parquet(f"{path}/{META}").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no preprocessor at {path}") from None
    stats = spark.read.schema(SCALER_SCHEMA).parquet(f"{path}/{SCALER}").collect()
    return build_preprocessor(
        meta["num_cols"],
        meta["cat_cols"],
        {r["column"]: (r["mean"], r["scale"]) for r in stats},
        spark.read.parquet(f"{path}/{CODES}"),
        meta["missing_as_unknown"],
    )


def save_model(model: Model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except (Py4JJavaError, AnalysisException) as error:
        raise FileNotFoundError(f"no model at {path}") from error


def load_out_of_fold(spark: SparkSession, path: str) -> DataFrame:
    """The cross-validated predictions that training stored."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no out-of-fold predictions at {path}") from error
