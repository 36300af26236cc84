"""Rank sums for exact ROC-AUC in every group of every dimension at once.

AUC is the share of (positive, negative) pairs ranked rightly, ties counting
half. Equal rows are first combined map-side. Score ranges then cut the table
into buckets of about equal size, whatever the sizes of the groups, and each
bucket is sorted once per dimension without further shuffles. Pairs inside a
bucket come from running counts. Pairs across buckets come from the buckets'
totals, of which there is one row per group and bucket. A score so frequent that
it would fill buckets gets one of its own: all its pairs are ties, so nothing has
to be sorted and its rows are spread by group instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabaudit.functions.rates import is_one
from tabaudit.functions.values import present
from tabaudit.operators.cleaning import quoted, running

# Buckets per shuffle partition, which evens out partitions, and their limits.
BUCKETS_PER_TASK = 8
MIN_BUCKETS, MAX_BUCKETS = 16, 20_000
# Sampled scores per bucket that place its edges.
SAMPLE_PER_BUCKET = 100


def score_value(df: DataFrame, score: str) -> Column:
    return present(quoted(score), df.schema[score].dataType).cast("double")


def score_edges(df: DataFrame, score: str, buckets: int | None = None) -> list[float]:
    """Inner edges of ranges with about equally many scores; frequent scores repeat.

    Any edges give the same AUC, they only decide how evenly the work is spread,
    so a sample of the scores places them. Its size follows from the number of
    buckets, not from the table.
    """
    if buckets is None:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, BUCKETS_PER_TASK * tasks))
    scores = df.select(score_value(df, score).alias("v"))
    fraction = min(1.0, buckets * SAMPLE_PER_BUCKET / max(1, scores.count()))
    probs = [i / buckets for i in range(1, buckets)]
    found = scores.sample(fraction, seed=17).agg(F.percentile_approx("v", probs, 4 * buckets))
    # Infinite scores belong to the outermost ranges.
    return sorted(e for e in found.first()[0] or [] if math.isfinite(e))


def rank_sums(
    df: DataFrame,
    dimensions: dict[str, Column],
    y_true: str,
    score: str,
    sums: dict[str, Column] | None = None,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """(dimension, group, u, pos, neg, and ``sums``), one row per group that is not null.

    ``u`` is the rank sum of the scored rows, of which ``pos`` and ``neg`` count
    the classes. ``sums`` are integer expressions added up over all rows: those
    without a score take part in them but not in the ranking.
    """
    names, sums = list(dimensions), sums or {}
    if edges is None:
        edges = score_edges(df, score)
    value = score_value(df, score)
    scored, counts = value.isNotNull(), ["pos", "neg", *sums]
    groups = [f"_g{i}" for i in range(len(names))]
    positive = is_one(quoted(y_true), "truth")
    cells = (
        df.select(
            *[dimensions[n].alias(g) for n, g in zip(names, groups)],
            # -0.0 and 0.0 are one score.
            F.when(value == 0, 0.0).otherwise(value).alias("_s"),
            (scored & positive).cast("long").alias("pos"),
            (scored & ~positive).cast("long").alias("neg"),
            *[expr.cast("long").alias(name) for name, expr in sums.items()],
        )
        .groupBy(*groups, "_s")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    cells, bucket = _with_bucket(cells, edges, groups)
    # Hashing on the bucket alone serves the windows of all dimensions and the sums.
    cells = cells.repartition(*bucket)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    for g in groups:
        # The frame includes rows with an equal score.
        upto = Window.partitionBy(*bucket, g).orderBy("_s").rangeBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        surplus = pos * F.sum("neg").over(upto) - neg * F.sum("pos").over(upto)
        if "_spread" in bucket:
            # Ties cancel out.
            surplus = F.when(F.col("_spread") < 0, surplus).otherwise(0.0)
        cells = cells.withColumn(f"{g}_surplus", surplus)
    members = F.array(
        *[
            F.struct(F.lit(i).alias("_d"), F.col(g).alias("group"), F.col(f"{g}_surplus").alias("_x"))
            for i, g in enumerate(groups)
        ]
    )
    # Pairs with the positive not below the negative, less those with it not above,
    # and all pairs: half of that sum counts right pairs once and ties half.
    in_bucket = (
        cells.select("_b", *counts, F.inline(members))
        .filter("`group` IS NOT NULL")
        .groupBy("_b", "_d", "group")
        .agg(F.sum("_x").alias("_x"), *[F.sum(c).alias(c) for c in counts])
        .withColumn("u", (F.col("_x") + pos * neg) / 2)
    )
    before = F.sum("neg").over(running(["_d", "group"], "_b")) - F.col("neg")
    return (
        in_bucket.withColumn("_before", before)
        .groupBy("_d", "group")
        .agg(
            F.sum(F.col("u") + pos * F.col("_before")).alias("u"),
            *[F.sum(c).alias(c) for c in counts],
        )
        .select(
            F.get(F.array(*map(F.lit, names)), F.col("_d")).alias("dimension"),
            "group",
            "u",
            *counts,
        )
    )


def overall_sums(
    df: DataFrame,
    y_true: str,
    score: str,
    sums: dict[str, Column] | None = None,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """``rank_sums`` of the whole table: (u, pos, neg, and ``sums``), no row for no rows."""
    whole = rank_sums(df, {"all": F.lit("all")}, y_true, score, sums, edges)
    return whole.drop("dimension", "group")


def _with_bucket(
    cells: DataFrame, edges: Sequence[float], groups: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Add the integer bucket of the score, and how rows are to be placed.

    A missing score has a bucket of its own. An edge that repeats is a frequent
    score: its bucket ends right above it, and ``_spread`` deals out its rows by
    group. Elsewhere ``_spread`` is -1.
    """
    if not edges:
        return cells.withColumn("_b", F.lit(0)), ["_b"]
    frequent = sorted({a for a, b in zip(edges, edges[1:]) if a == b})
    splits = sorted({*edges, *(math.nextafter(v, math.inf) for v in frequent)})
    bucketizer = Bucketizer(
        splits=[-math.inf, *splits, math.inf],
        inputCol="_s",
        outputCol="_b",
        handleInvalid="keep",
    )
    cells = bucketizer.transform(cells).withColumn("_b", F.col("_b").cast("int"))
    if not frequent:
        return cells, ["_b"]
    tied = F.col("_b").isin([splits.index(v) + 1 for v in frequent])
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.pmod(F.xxhash64(*groups), F.lit(tasks)).cast("int")
    return cells.withColumn("_spread", F.when(tied, place).otherwise(-1)), ["_b", "_spread"]


def auc_from_sums() -> Column:
    """AUC from ``u``, ``pos`` and ``neg``; null unless both classes occur."""
    return F.try_divide(F.col("u"), F.col("pos").cast("double") * F.col("neg"))
