"""Running sums over a whole table in a global order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabaudit.session import materialize


def with_sum_before(
    df: DataFrame, order: Sequence[Column], out: str = "before", weight: Column | None = None
) -> DataFrame:
    """Add the sum of ``weight`` (1: the number) of all rows before a row in ``order``.

    Rows are dealt out by ranges of the full order and written; only the sums of
    the ranges, one row per shuffle partition, are added up in one task. ``order``
    should tell all rows apart.
    """
    weight = weight if weight is not None else F.lit(1)
    ordered = df.withColumns({f"_o{i}": c for i, c in enumerate(order)})
    keys = [f"_o{i}" for i in range(len(order))]
    ordered = ordered.withColumn("_weight", weight.cast("long"))
    # Struct order puts nulls first, as the ascending ranges do.
    ranged = materialize(
        ordered.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    sums = ranged.groupBy("_range").agg(F.sum("_weight").alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    own = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce(F.sum("_weight").over(own), F.lit(0))
    joined = ranged.join(F.broadcast(starts), "_range").withColumn(out, before)
    return joined.drop("_range", "_start", "_weight", *keys)
