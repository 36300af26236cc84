"""Expressions on numbers, labels and whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

# Age bins, open on the left and closed on the right.
AGE_EDGES = (0, 25, 35, 45, 55, 100)
AGE_LABELS = ("<25", "25-35", "35-45", "45-55", ">55")

# Fixed value: the positive class of the census target.
POSITIVE_LABEL = ">50K"


def present(col: Column, dtype: T.DataType) -> Column:
    """``col`` with NaN turned into null, so that aggregates skip it."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(col, F.lit(None).cast(dtype))
    return col


def right_closed_bin(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin ``(lower, upper]`` a value falls in; null outside every bin."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    # Walking up from the lowest edge, the first upper bound not below the value wins.
    out = F.when(col <= edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        out = out.when(col <= upper, F.lit(label))
    return out


def age_bin(col: Column) -> Column:
    return right_closed_bin(col, AGE_EDGES, AGE_LABELS)


def binary_label(col: Column, dtype: T.DataType, positive: str = POSITIVE_LABEL) -> Column:
    """0/1 label: text is compared with the positive class, numbers pass through."""
    if isinstance(dtype, T.StringType):
        return F.coalesce((col == positive).cast("int"), F.lit(0))
    return col


def row_digest(schema: T.StructType, columns: Sequence[str]) -> Column:
    """256-bit digest of a row over ``columns``; equal rows, nulls included, agree.

    Grouping on the digest instead of the row moves 32 bytes per row through the
    shuffle, however wide the table or long its texts. Each field is written as
    ``length:text`` (or ``-`` for null), so neighbouring fields cannot run together.
    """
    parts = []
    for name in columns:
        dtype = schema[name].dataType
        col = F.col(f"`{name}`")
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            # -0.0 and 0.0 are one value, and so are NaN and null.
            col = present(F.when(col == 0, F.lit(0.0).cast(dtype)).otherwise(col), dtype)
        if isinstance(dtype, T.BinaryType):
            text = F.hex(col)
        elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            text = F.to_json(F.struct(col.alias("v")), {"ignoreNullFields": "false"})
            text = F.when(col.isNotNull(), text)
        elif isinstance(dtype, T.TimestampType):
            text = F.unix_micros(col).cast("string")
        else:
            text = col.cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        )
    return F.unhex(F.sha2(F.concat(*parts), 256))
