"""Exact stratified hold-out and folds that any stage can derive again.

Rows of a class are ordered by ``md5(seed|key)``. The first ones, up to the class
quota, are the test part; the rest is cut into consecutive folds. Since only a
few ranks per class matter, the hashes at those ranks are looked up once and each
row is then placed by comparing its own hash with them: with few classes the table
is labelled in a map-only pass, with many after a join with the table of classes.
Class sizes, quotas and thresholds are tables, whatever the number of classes.
Order, number and size of partitions do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabaudit.operators.cleaning import quoted, running
from tabaudit.operators.positions import with_sum_before
from tabaudit.session import materialize

# Classes up to which thresholds are inlined rather than joined.
INLINE_CLASSES = 64
# Narrow rows up to which a table is broadcast rather than shuffled.
BROADCAST_ROWS = 500_000


def row_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), quoted(key).cast("string")))


@dataclass(frozen=True)
class SplitPlan:
    """Thresholds per class: slot 0 is the test part, slots 1..k are the folds.

    ``cuts`` has ``c`` (the class) and ``limits`` (a hash per slot); ``inline`` holds
    its rows if there are few.
    """

    label: str
    key: str
    seed: int
    folds: int
    label_type: T.DataType
    cuts: DataFrame
    n_classes: int
    inline: tuple[tuple[object, tuple[str, ...]], ...] | None

    def apply(self, df: DataFrame, part: str = "part", fold: str = "fold") -> DataFrame:
        """Add ``part`` ('train'/'test') and ``fold`` (null in the test part)."""
        h, label = row_hash(self.key, self.seed), quoted(self.label)
        if self.inline is not None:
            limits = F.lit(None).cast("array<string>")
            for value, hashes in self.inline:
                same = label.eqNullSafe(F.lit(value).cast(self.label_type))
                limits = F.when(same, F.array(*map(F.lit, hashes))).otherwise(limits)
            placed = df.withColumn("_limits", limits)
        else:
            table = self.cuts.toDF("_class", "_limits")
            if self.n_classes <= BROADCAST_ROWS:
                table = F.broadcast(table)
            placed = df.join(table, label.eqNullSafe(F.col("_class")), "left").drop("_class")
        slot = reduce(
            add,
            [(h > F.get(F.col("_limits"), F.lit(i))).cast("int") for i in range(max(1, self.folds))],
        )
        out = placed.withColumn(part, F.when(slot == 0, "test").otherwise("train"))
        if self.folds:
            out = out.withColumn(fold, F.when(slot > 0, slot - 1))
        return out.drop("_limits")


def fit_split(
    df: DataFrame,
    label: str,
    key: str,
    test_size: float = 0.2,
    folds: int = 0,
    seed: int = 42,
) -> SplitPlan:
    """Find the hash at every rank where a class changes from one slot to the next.

    Three narrow passes: class sizes, rows per class and hash bucket, and the hashes
    in those buckets that contain a wanted rank. ``key`` must be unique and not null:
    a null, or a repeated key at a threshold, raises an error.
    """
    sizes = materialize(
        df.groupBy(quoted(label).alias("c")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(quoted(key).isNull()).alias("nulls")
        ),
        "classes",
    )
    totals = sizes.agg(F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.count("*").alias("c")).first()
    if totals["nulls"]:
        raise ValueError(f"{totals['nulls']} rows have no {key}: a split needs a key in every row")
    n = totals["n"] or 0
    ranks = _slot_ranks(sizes, n, test_size, folds)
    hashed = df.select(quoted(label).alias("c"), row_hash(key, seed).alias("h")).withColumn(
        "b", F.substring("h", 1, bucket_digits(n))
    )
    cuts = materialize(_limits(hashed, ranks, key), "cuts")
    inline = None
    if totals["c"] <= INLINE_CLASSES:
        inline = tuple((r["c"], tuple(r["limits"])) for r in cuts.collect())
    return SplitPlan(label, key, seed, folds, df.schema[label].dataType, cuts, totals["c"], inline)


def _slot_ranks(sizes: DataFrame, n: int, test_size: float, folds: int) -> DataFrame:
    """``c`` and ``ranks``: the last rank of the test part, and of each fold but the last.

    Test rows are shared out in proportion, the total rounded up, the largest
    remainders first. Folds are the sizes that result when the training labels,
    sorted, are dealt out in turn.
    """
    total = math.ceil(test_size * n) if test_size else 0
    wide = lambda x: F.lit(x).cast("decimal(38,0)")
    share = F.col("n").cast("decimal(19,0)") * F.lit(total).cast("decimal(19,0)")
    exact = ((F.col("share") - F.col("remainder")) / wide(max(n, 1))).cast("long")
    quotas = sizes.select("c", "n", share.cast("decimal(38,0)").alias("share")).withColumn(
        "remainder", F.col("share") % wide(max(n, 1))
    ).select("c", "n", exact.alias("floor"), "remainder")
    left = total - (quotas.agg(F.sum("floor")).first()[0] or 0)
    placed = with_sum_before(quotas, [-F.col("remainder"), *_class_order()], "place")
    quota = F.col("floor") + (F.col("place") < left).cast("long")
    counted = placed.select("c", "n", quota.alias("quota"))
    if not folds:
        return counted.select("c", F.array("quota").alias("ranks"))
    train = F.col("n") - F.col("quota")
    dealt = with_sum_before(counted, _class_order(), "start", train).withColumn(
        "stop", F.col("start") + train
    )
    # Labels start..stop-1 go to fold (place mod folds).
    upto = [F.col("quota")]
    for i in range(folds - 1):
        block = F.expr(f"(stop - {i} + {folds - 1}) div {folds} - (start - {i} + {folds - 1}) div {folds}")
        upto.append(upto[-1] + block)
    return dealt.select("c", F.array(*upto).alias("ranks"))


def _class_order() -> list[Column]:
    """Classes in ascending order, null last."""
    return [F.col("c").isNull(), F.col("c")]


def bucket_digits(n: int) -> int:
    """Leading hex digits of the hash that make about sqrt(n) even buckets.

    Neither the buckets of a class nor the rows of a bucket then outgrow sqrt(n).
    """
    return min(8, max(1, round(math.log(max(n, 1), 16) / 2)))


def _limits(hashed: DataFrame, ranks: DataFrame, key: str) -> DataFrame:
    """``c`` and ``limits``: the hash at each of a class's ranks, an empty text for rank 0."""
    wanted = materialize(
        ranks.select("c", F.posexplode("ranks").alias("slot", "r")), "wanted_ranks"
    )
    counts = hashed.groupBy("c", "b").agg(F.count(F.lit(1)).alias("n"))
    upto = counts.withColumn("upto", F.sum("n").over(running(["c"], "b")))
    asked = wanted.filter("r > 0").select(F.col("c").alias("c2"), "slot", "r")
    hits = (
        upto.join(
            asked,
            F.col("c").eqNullSafe(F.col("c2"))
            & (F.col("r") <= F.col("upto"))
            & (F.col("r") > F.col("upto") - F.col("n")),
        )
        .withColumn("at", F.col("r") - F.col("upto") + F.col("n"))
        .groupBy("c", "b")
        .agg(F.collect_list(F.struct("at", "slot")).alias("asked"))
    )
    hits = materialize(hits.toDF("c2", "b2", "asked"), "hit_buckets")
    if hits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        hits = F.broadcast(hits)
    order = Window.partitionBy("c", "b").orderBy("h")
    found = (
        hashed.join(hits, F.col("c").eqNullSafe(F.col("c2")) & (F.col("b") == F.col("b2")))
        .withColumns(
            {
                "place": F.row_number().over(order).cast("long"),
                "again": F.coalesce(F.lead("h").over(order) == F.col("h"), F.lit(False)),
            }
        )
        .select("c", "h", "again", F.inline(F.filter("asked", lambda x: x["at"] == F.col("place"))))
    )
    error = F.raise_error(F.lit(f"{key} repeats: a split needs a key that tells rows apart"))
    checked = found.select(
        F.col("c").alias("c2"),
        F.col("slot").alias("slot2"),
        F.when(F.col("again"), error.cast("string")).otherwise(F.col("h")).alias("h"),
    )
    same = F.col("c").eqNullSafe(F.col("c2")) & (F.col("slot") == F.col("slot2"))
    entry = F.struct("slot", F.coalesce("h", F.lit("")).alias("h"))
    each = wanted.join(checked, same, "left").groupBy("c").agg(
        F.sort_array(F.collect_list(entry)).alias("slots")
    )
    return each.select("c", F.col("slots.h").alias("limits"))


def stratified_split(
    df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``part``; the same seed and keys give the same parts in every stage."""
    return fit_split(df, label, key, test_size, 0, seed).apply(df)


def stratified_folds(
    df: DataFrame,
    label: str,
    key: str,
    k: int = 5,
    test_size: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add ``part`` and, in the training part, ``fold`` 0..k-1."""
    return fit_split(df, label, key, test_size, k, seed).apply(df)


def train_test(df: DataFrame, part: str = "part") -> Sequence[DataFrame]:
    """The two parts as tables of their own."""
    return [df.filter(F.col(part) == p).drop(part) for p in ("train", "test")]
