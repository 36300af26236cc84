"""Missing-value spellings, categorical text, targets and column roles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F, types as T

from tabaudit.functions.text import MISSING_TOKEN, clean_text, sentinel_to_null
from tabaudit.functions.values import POSITIVE_LABEL, binary_label


def quoted(name: str):
    """Column by name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def running(keys: Sequence[str], order: str) -> WindowSpec:
    """All rows of the key up to the current one."""
    rows = Window.partitionBy(*keys).orderBy(order)
    return rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def replace_columns(df: DataFrame, new: dict) -> DataFrame:
    """All columns in their order, those in ``new`` replaced; one projection."""
    return df.select(*[new[c].alias(c) if c in new else quoted(c) for c in df.columns])


def null_sentinels(df: DataFrame) -> DataFrame:
    """Missing-value spellings become null in every string column."""
    return replace_columns(df, {c: sentinel_to_null(quoted(c)) for c in string_columns(df)})


def clean_categoricals(
    df: DataFrame, columns: Sequence[str], missing_token: str | None = MISSING_TOKEN
) -> DataFrame:
    """Text chain on the listed columns that the table has."""
    listed = [c for c in columns if c in df.columns]
    return replace_columns(df, {c: clean_text(quoted(c), missing_token) for c in listed})


def clean_features(
    df: DataFrame, columns: Sequence[str], missing_as_unknown: bool = False
) -> DataFrame:
    """The one cleaning chain all stages use: sentinels to null, then the text chain.

    By default a missing entry becomes a category of its own. With
    ``missing_as_unknown`` it stays null and is encoded like an unseen value.
    """
    token = None if missing_as_unknown else MISSING_TOKEN
    return clean_categoricals(null_sentinels(df), columns, token)


def clean_target(df: DataFrame, column: str | None = None) -> DataFrame:
    """Text chain on the target, by default the table's first column."""
    name = column or df.columns[0]
    return replace_columns(df, {name: clean_text(quoted(name))})


def flatten_target(df: DataFrame) -> DataFrame:
    """The first column of a target table on its own."""
    return df.select(quoted(df.columns[0]))


def binarize_label(
    df: DataFrame, column: str, out: str = "label", positive: str = POSITIVE_LABEL
) -> DataFrame:
    return df.withColumn(out, binary_label(quoted(column), df.schema[column].dataType, positive))


def infer_column_roles(
    df: DataFrame, num_cols: Sequence[str] | None = None, cat_cols: Sequence[str] | None = None
) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns in table order; given lists win.

    If only one list is given the other is inferred. An empty list counts as not
    given once inference runs, that is, unless both lists are given.
    """
    if num_cols is not None and cat_cols is not None:
        return list(num_cols), list(cat_cols)
    return list(num_cols or numeric_columns(df)), list(cat_cols or string_columns(df))
