"""The census income table: columns, roles and rules."""

from __future__ import annotations

from pyspark.sql import types as T

from tabaudit.operators.expectations import ColumnRule

_INT, _TEXT = T.LongType(), T.StringType()

# The table's columns in order, and what each must hold.
RULES = (
    ColumnRule("age", _INT, between=(17, 90)),
    ColumnRule("workclass", _TEXT, nullable=True),
    ColumnRule("fnlwgt", _INT, between=(1, 1500000)),
    ColumnRule("education", _TEXT),
    ColumnRule("education-num", _INT, between=(1, 16)),
    ColumnRule("marital-status", _TEXT),
    ColumnRule("occupation", _TEXT, nullable=True),
    ColumnRule("relationship", _TEXT),
    ColumnRule("race", _TEXT),
    ColumnRule("sex", _TEXT, allowed=("Male", "Female")),
    ColumnRule("capital-gain", _INT, between=(0, 100000)),
    ColumnRule("capital-loss", _INT, between=(0, 5000)),
    ColumnRule("hours-per-week", _INT, between=(1, 99)),
    ColumnRule("native-country", _TEXT, nullable=True),
)

TARGET = "income"

FEATURE_COLS = [rule.name for rule in RULES]
NUM_COLS = [rule.name for rule in RULES if rule.dtype == _INT]
CAT_COLS = [rule.name for rule in RULES if rule.dtype == _TEXT]

FEATURE_SCHEMA = T.StructType([T.StructField(r.name, r.dtype) for r in RULES])
LANDED_FEATURES = T.StructType([T.StructField("row_id", _INT), *FEATURE_SCHEMA.fields])
LANDED_TARGET = T.StructType([T.StructField("row_id", _INT), T.StructField(TARGET, _TEXT)])
