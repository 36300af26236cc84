"""Declared expectations on a table: types, nulls, ranges and allowed values.

Rules compile to one boolean column each, true where the row fails. Both the
list of failing rows and the verdict read the table once, whatever the number
of rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabaudit.functions.values import present
from tabaudit.operators.cleaning import quoted

def failure_schema(key_type: T.DataType) -> T.StructType:
    """The row id keeps the type of the table's key."""
    return T.StructType(
        [
            T.StructField("row_id", key_type),
            T.StructField("column", T.StringType()),
            T.StructField("check", T.StringType()),
            T.StructField("failure_case", T.StringType()),
        ]
    )


class ExpectationError(ValueError):
    """Raised by ``require_expectations`` with the rules that failed."""


@dataclass(frozen=True)
class ColumnRule:
    """What one column must hold. Nulls and NaN break only the ``nullable`` rule."""

    name: str
    dtype: T.DataType
    nullable: bool = False
    between: tuple[float, float] | None = None
    allowed: tuple[str, ...] | None = None


def _row_checks(rule: ColumnRule, dtype: T.DataType) -> list[tuple[str, Column]]:
    """(check name, fails) for the checks of one rule that look at values."""
    col = present(quoted(rule.name), dtype)
    checks = []
    if not rule.nullable:
        checks.append(("not_nullable", col.isNull()))
    if rule.between is not None:
        low, high = rule.between
        checks.append((f"in_range({low}, {high})", ~col.between(low, high)))
    if rule.allowed is not None:
        checks.append((f"isin({', '.join(rule.allowed)})", ~col.isin(*rule.allowed)))
    return checks


def _comparable(df: DataFrame, rule: ColumnRule) -> bool:
    """Whether value checks make sense for the type the column really has."""
    if rule.name not in df.columns:
        return False
    actual = df.schema[rule.name].dataType
    same_family = isinstance(actual, T.NumericType) == isinstance(rule.dtype, T.NumericType)
    return same_family and isinstance(actual, T.StringType) == isinstance(rule.dtype, T.StringType)


def applicable_checks(
    df: DataFrame, rules: Sequence[ColumnRule]
) -> list[tuple[str, str, Column]]:
    """(column, check, fails) of every value check the table can be asked."""
    return [
        (rule.name, check, fails)
        for rule in rules
        if _comparable(df, rule)
        for check, fails in _row_checks(rule, df.schema[rule.name].dataType)
    ]


def schema_problems(df: DataFrame, rules: Sequence[ColumnRule]) -> list[tuple[str, str, str | None]]:
    """(column, check, found) for missing columns and wrong types; reads no rows."""
    problems = []
    for rule in rules:
        if rule.name not in df.columns:
            problems.append((rule.name, "column_in_dataframe", None))
        elif df.schema[rule.name].dataType != rule.dtype:
            found = df.schema[rule.name].dataType.simpleString()
            problems.append((rule.name, f"dtype({rule.dtype.simpleString()})", found))
    return problems


def columns_and_types(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """One row per declared column: declared and found type, and rows checked."""
    entries = []
    for rule in rules:
        found = df.schema[rule.name].dataType.simpleString() if rule.name in df.columns else None
        entries.append(
            F.struct(
                F.lit(rule.name).alias("column"),
                F.lit(rule.dtype.simpleString()).alias("declared"),
                F.lit(found).cast("string").alias("found"),
                F.lit(found == rule.dtype.simpleString()).alias("ok"),
                F.col("n_rows"),
            )
        )
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(F.array(*entries)))


def failing_rows(df: DataFrame, rules: Sequence[ColumnRule], key: str | None = None) -> DataFrame:
    """Every failed check as a record: row, column, check and offending value.

    Missing columns and wrong types concern no single row, so their ``row_id``
    is null. Without a ``key`` the ``row_id`` is null throughout.
    """
    spark = df.sparkSession
    static = [
        (None, column, check, found) for column, check, found in schema_problems(df, rules)
    ]
    key_type = df.schema[key].dataType if key else T.LongType()
    out = spark.createDataFrame(static, failure_schema(key_type))
    checks = applicable_checks(df, rules)
    if not checks:
        return out
    row_id = quoted(key) if key else F.lit(None).cast(key_type)
    records = F.array_compact(
        F.array(
            *[
                F.when(
                    fails,
                    F.struct(
                        F.lit(column).alias("column"),
                        F.lit(check).alias("check"),
                        quoted(column).cast("string").alias("failure_case"),
                    ),
                )
                for column, check, fails in checks
            ]
        )
    )
    # Rows that pass everything leave before the array is built.
    broken = checks[0][2]
    for _, _, fails in checks[1:]:
        broken = broken | fails
    found = df.filter(broken).select(row_id.alias("row_id"), F.inline(records))
    return out.unionByName(found) if static else found


def verdict_aggregates(df: DataFrame, rules: Sequence[ColumnRule]) -> dict[str, Column]:
    """``rule name -> failing row count`` aggregates, to be fused with other aggregates."""
    return {
        f"{column}: {check}": F.count_if(F.coalesce(fails, F.lit(False)))
        for column, check, fails in applicable_checks(df, rules)
    }


def verdict(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """Failing rows per rule in one pass. A column-level failure counts every row."""
    counts = verdict_aggregates(df, rules)
    names = list(counts)
    row = df.agg(
        F.count(F.lit(1)).alias("_n_rows"), *[counts[n].alias(f"_r{i}") for i, n in enumerate(names)]
    )
    entries = [(n, F.col(f"_r{i}"), F.col(f"_r{i}") == 0) for i, n in enumerate(names)]
    entries += [
        (f"{column}: {check}", F.col("_n_rows"), F.lit(False))
        for column, check, _ in schema_problems(df, rules)
    ]
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("rule"), failed.alias("n_failed"), ok.alias("success"))
                    for n, failed, ok in entries
                ]
            )
        )
    )


def require_expectations(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """Strict mode: raise at the first sign of failure, else hand the table on."""
    problems = schema_problems(df, rules)
    if problems:
        raise ExpectationError(f"schema does not match: {problems}")
    failed = verdict(df, rules).filter(~F.col("success")).collect()
    if failed:
        raise ExpectationError("; ".join(f"{r.rule}: {r.n_failed} rows" for r in failed))
    return df
