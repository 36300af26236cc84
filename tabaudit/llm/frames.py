"""Small helpers on DataFrames shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabaudit.operators.cleaning import quoted
from tabaudit.session import materialize

# White space that separates words: space and the control characters 9 to 13.
BLANKS = " \t\n\x0b\f\r"
WORD = "[^\\x20\\x09-\\x0D]+"
# Tables of up to so many narrow rows are sent to all tasks; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


def packed(df: DataFrame) -> DataFrame:
    """One struct column ``_row`` with all columns, so that no other name can clash with them."""
    return df.select(F.struct(*[quoted(c) for c in df.columns]).alias("_row"))


def field(name: str) -> Column:
    return F.col("_row").getField(name)


def unpacked(df: DataFrame, columns: list[str], changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns inside ``_row`` again, some of them replaced."""
    changed = changed or {}
    return df.select(*[changed.get(c, field(c)).alias(c) for c in columns])


def unused(name: str, columns: list[str]) -> str:
    """``name``, with as many underscores before it as make it differ from all of ``columns``."""
    while name.lower() in {c.lower() for c in columns}:
        name = "_" + name
    return name


def broadcast_if_few(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, to be broadcast if a count finds at most ``rows`` rows; else joined as the planner sees fit.

    Beyond the bound that is a sort-merge join, which spills and whose hot keys are split.
    """
    few = df.limit(rows + 1).count() <= rows
    return F.broadcast(df) if few else df


def marked(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", flag: str = "trusted") -> DataFrame:
    """``docs`` with a flag that tells whether the id is in the only column of ``ids``."""
    ids = broadcast_if_few(ids.toDF("_marked_id").filter("_marked_id is not null").distinct())
    joined = docs.join(ids, docs[id_col] == F.col("_marked_id"), "left")
    return joined.select(*[docs[c] for c in docs.columns], F.col("_marked_id").isNotNull().alias(flag))


def held_out(id_: Column, below: str) -> Column:
    """Whether the MD5 of the id starts with a hex digit smaller than ``below``."""
    return F.md5(id_.cast("string").cast("binary")) < below


def lower_quantile(values: DataFrame, value: Column, share: float, width: float, by: list[str] = ()):
    """The bin (of ``width``) that holds the quantile of ``value``, per group of ``by``, as ``bin``.

    Values are counted in bins first, so that a window meets one row per bin.
    """
    bins = values.groupBy(*by, F.floor(value / F.lit(width)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    whole = Window.partitionBy(*by)
    ranked = bins.select(
        *by, "bin", F.sum("n").over(whole.orderBy("bin")).alias("upto"), F.sum("n").over(whole).alias("all")
    )
    return ranked.filter(F.col("upto") >= F.lit(share) * F.col("all")).groupBy(*by).agg(
        F.min("bin").alias("bin")
    )


def carried(events: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """Replace each of ``values`` by its last non-null value up to the row in the order of ``order``.

    Rows are dealt out by ranges of the order; the last values of each range are
    carried over to the next ones, one row per range.
    """
    placed = materialize(
        events.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    position = F.struct(*order)
    ends = placed.groupBy("_range").agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), position)).alias(f"_end_{v}") for v in values]
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(
        "_range",
        *[F.last(f"_end_{v}", ignorenulls=True).over(earlier).alias(f"_end_{v}") for v in values],
    )
    upto = Window.partitionBy("_range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # One row per shuffle partition: its number is a setting, not a matter of the data.
    joined = placed.join(F.broadcast(before), "_range")
    found = [
        F.coalesce(F.last(v, ignorenulls=True).over(upto), F.col(f"_end_{v}")).alias(v)
        for v in values
    ]
    return joined.select(*[c for c in events.columns if c not in values], *found)
