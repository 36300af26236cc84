"""Table profiling: nulls, types, duplicates, numeric summaries, top values, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabaudit.functions.values import present, row_digest
from tabaudit.operators.cleaning import numeric_columns, quoted, string_columns
from tabaudit.operators.quantiles import quantiles, value_column
from tabaudit.session import materialize

QUARTILES = (0.25, 0.5, 0.75)

# Average characters above which a text column is counted by digest.
LONG_TEXT = 64
# Equally frequent values, beyond the wanted ones, whose texts may be fetched.
TIE_LIMIT = 10_000
# Characters that bound the search among more of them.
_HEAD_CHARS = 16
# Distinct values, as estimated, above which a column's values are counted in hash slots
# first, and the number of slots.
SLOTS = 4096


def inline_rows(df: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """Turn one wide aggregated row into one row per struct in ``entries``."""
    return df.select(F.inline(F.array(*entries)))


def is_missing(df: DataFrame, name: str) -> Column:
    return present(quoted(name), df.schema[name].dataType).isNull()


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count), all columns in one pass; NaN counts as null."""
    names = list(columns or df.columns)
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(names)])
    return inline_rows(
        row,
        [
            F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("null_count"))
            for i, c in enumerate(names)
        ],
    )


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count, null_pct) of columns with nulls, most nulls first."""
    names = list(columns or df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(names)],
    )
    rows = inline_rows(
        row,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"n{i}").alias("null_count"),
                F.round(F.try_divide(100.0 * F.col(f"n{i}"), F.col("n")), 2).alias("null_pct"),
            )
            for i, c in enumerate(names)
        ],
    )
    return rows.filter("null_count > 0").orderBy(F.desc("null_count"), "column")


def table_shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )


def column_dtypes(df: DataFrame) -> DataFrame:
    """(column, dtype, n_rows)."""
    row = df.agg(F.count(F.lit(1)).alias("n"))
    return inline_rows(
        row,
        [
            F.struct(
                F.lit(name).alias("column"), F.lit(dtype).alias("dtype"), F.col("n").alias("n_rows")
            )
            for name, dtype in df.dtypes
        ],
    )


def table_info(df: DataFrame) -> DataFrame:
    """(position, column, non_null, dtype)."""
    row = df.agg(
        *[F.count_if(~is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    )
    return inline_rows(
        row,
        [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column"),
                F.col(f"n{i}").alias("non_null"),
                F.lit(dtype).alias("dtype"),
            )
            for i, (name, dtype) in enumerate(df.dtypes)
        ],
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(n_rows, n_duplicates, has_duplicates); a row counts beyond its first copy.

    Copies are combined map-side per 256-bit digest, so neither wide rows nor a
    row copied a billion times weighs on the shuffle.
    """
    digest = row_digest(df.schema, list(columns or df.columns))
    copies = df.select(digest.alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    summed = copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )
    return summed.withColumn("has_duplicates", F.col("n_duplicates") > 0)


def basic_aggregates(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The part of ``numeric_summary`` that one pass can take, to be fused with other aggregates."""
    aggs = []
    for i, c in enumerate(columns):
        v = value_column(df, c)
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"m{i}"),
            F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"l{i}"),
            F.max(v).alias(f"h{i}"),
        ]
    return aggs


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    basics: Row | None = None,
    **limits: int,
) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per numeric column; nulls skipped.

    One pass takes everything but the quartiles; ``basics`` is its row if another
    pass took it along. Its counts decide how the quartiles are found, and
    ``limits`` go to ``quantiles``.
    """
    names = list(columns if columns is not None else numeric_columns(df))
    spark = df.sparkSession
    schema = (
        "column string, count long, mean double, std double, min double, "
        "q25 double, q50 double, q75 double, max double"
    )
    if not names:
        return spark.createDataFrame([], schema)
    row = basics if basics is not None else df.agg(*basic_aggregates(df, names)).first()
    bounds = {c: (row[f"n{i}"], row[f"l{i}"], row[f"h{i}"]) for i, c in enumerate(names)}
    # One row per column: bounded by the width of the table.
    basics = spark.createDataFrame(
        [(c, *(row[f"{k}{i}"] for k in "nmslh")) for i, c in enumerate(names)],
        "column string, count long, mean double, std double, min double, max double",
    )
    q = quantiles(df, names, QUARTILES, bounds, **limits)
    wide = q.groupBy("column").agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q{round(100 * p)}")
            for p in QUARTILES
        ]
    )
    return wide.join(F.broadcast(basics), "column").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def top_values(
    df: DataFrame,
    k: int = 10,
    columns: Sequence[str] | None = None,
    long_text: float = LONG_TEXT,
    tie_limit: int = TIE_LIMIT,
    slots: int = SLOTS,
) -> DataFrame:
    """The ``k`` most frequent values per string column; null is a value like any other.

    Ties go to the smaller value, null last. Counts are combined map-side and each
    task keeps only ``k`` rows per column before the final ranking. A column of long
    texts is counted by digest, and only the texts that may win are shuffled: those
    that are frequent enough, and of very many equally frequent ones the first. Of a
    column with more than ``slots`` values, those whose slot rules them out are not
    shuffled (``slot_survivors``). The rows are the same on every path.
    """
    names = list(columns or string_columns(df))
    if not names:
        schema = "column string, value string, n long, rank int"
        return df.sparkSession.createDataFrame([], schema)
    sizes = df.agg(
        *[F.avg(F.length(quoted(c))).alias(f"l{i}") for i, c in enumerate(names)],
        *[F.approx_count_distinct(quoted(c)).alias(f"d{i}") for i, c in enumerate(names)],
    ).first()
    long = [c for i, c in enumerate(names) if (sizes[f"l{i}"] or 0) > long_text]
    many = [c for i, c in enumerate(names) if c not in long and sizes[f"d{i}"] > slots]
    few = [c for c in names if c not in long and c not in many]
    counted = [t for c in long for t in _frequent_texts(df, c, k, tie_limit)]
    if few:
        counted.append(_value_counts(_column_values(df, few)))
    if many:
        counted.append(_value_counts(slot_survivors(df, many, k, slots)))
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    ranked = reduce(DataFrame.unionByName, counted).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)


def _column_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value), one row per row and column."""
    pairs = [F.struct(F.lit(c).alias("column"), quoted(c).alias("value")) for c in names]
    return df.select(F.inline(F.array(*pairs)))


def _value_counts(values: DataFrame) -> DataFrame:
    return values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def slot_survivors(df: DataFrame, names: Sequence[str], k: int, slots: int = SLOTS) -> DataFrame:
    """(column, value) rows of the values that may be among the ``k`` most frequent of their column.

    Values are hashed into slots, and a slot's rows bound the count of each value in
    it. Exact counts of the values in the fullest slots give a count that ``k`` values
    reach; slots with fewer rows than that hold no winner, and their values are left
    out. Frequent values thus cost a few slots instead of a shuffle of all values.
    Where no value stands out, most slots stay, up to all of them: of a column
    of unique values, none can be ruled out by counting.
    """
    slot = F.pmod(F.xxhash64("value"), F.lit(slots)).cast("int").alias("slot")
    placed = _column_values(df, names).select("column", "value", slot)
    # At most ``slots`` rows per column, here and in what is joined below.
    load = materialize(
        placed.groupBy("column", "slot").agg(F.count(F.lit(1)).alias("n_slot")), "slots"
    )
    by_load = Window.partitionBy("column").orderBy(F.desc("n_slot"), "slot")
    fullest = load.withColumn("place", F.row_number().over(by_load)).filter(F.col("place") <= 4 * k)
    known = _value_counts(_semi_join(placed, fullest))
    by_count = Window.partitionBy("column").orderBy(F.desc("n"))
    reached = (
        known.withColumn("place", F.row_number().over(by_count))
        .filter(F.col("place") == k)
        .select("column", F.col("n").alias("least"))
    )
    # Without k values in the fullest slots, any count may do.
    least = F.coalesce("least", F.lit(1))
    open_slots = load.join(F.broadcast(reached), "column", "left").filter(F.col("n_slot") >= least)
    return _semi_join(placed, materialize(open_slots, "open-slots")).select("column", "value")


def _semi_join(placed: DataFrame, slots: DataFrame) -> DataFrame:
    """Rows of ``placed`` in the given slots, found without a shuffle."""
    return placed.join(F.broadcast(slots.select("column", "slot")), ["column", "slot"], "left_semi")


def _digest_counts(df: DataFrame, name: str) -> DataFrame:
    digest = row_digest(df.schema, [name]).alias("d")
    return df.select(digest).groupBy("d").agg(F.count(F.lit(1)).alias("n"))


def _frequent_texts(df: DataFrame, name: str, k: int, tie_limit: int) -> list[DataFrame]:
    """Tables of the values that may be among the first ``k``."""
    sizes = _digest_counts(df, name).groupBy("n").agg(F.count(F.lit(1)).alias("values"))
    taken, least = 0, 1
    # Each size holds at least one value, so the k largest sizes are enough.
    for row in sizes.orderBy(F.desc("n")).limit(k).collect():
        above, least = taken, row["n"]
        taken += row["values"]
        if taken >= k:
            break
    if taken <= k + tie_limit:
        return [_count_texts(df, name, least)]
    return [_count_texts(df, name, least + 1), _first_tied(df, name, least, k - above)]


def _first_tied(df: DataFrame, name: str, n: int, wanted: int) -> DataFrame:
    """(column, value, n) of values that occur ``n`` times, the first ``wanted`` in order among them.

    The beginnings of the first ones bound what has to be looked at; whole texts
    decide. Nulls come last and are not among them, as many more values are tied.
    """
    text, head = quoted(name), F.left(quoted(name), F.lit(_HEAD_CHARS))
    digest = row_digest(df.schema, [name])
    tied = (
        df.filter(text.isNotNull())
        .groupBy(digest.alias("d"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(head).alias("head"))
        .filter(F.col("n") == n)
    )
    last = tied.select("head").orderBy("head").limit(wanted).agg(F.max("head")).first()[0]
    # Rows with one text have one beginning, so they are counted completely.
    return (
        df.filter(head <= F.lit(last))
        .groupBy(digest.alias("d"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(text).alias("value"))
        .filter(F.col("n") == n)
        .select(F.lit(name).alias("column"), "value", "n")
    )


def _count_texts(df: DataFrame, name: str, least: int) -> DataFrame:
    """(column, value, n) of the values that occur ``least`` times or more."""
    digest = row_digest(df.schema, [name]).alias("d")
    # At most k + TIE_LIMIT digests, as counted before.
    frequent = F.broadcast(_digest_counts(df, name).filter(F.col("n") >= least))
    texts = df.select(digest, quoted(name).alias("value")).join(frequent, "d")
    return (
        texts.groupBy("d", "n")
        .agg(F.min("value").alias("value"))
        .select(F.lit(name).alias("column"), "value", "n")
    )


# Up to so many columns, one aggregate per pair; beyond, matrix products.
PAIR_COLUMNS = 12
# Columns of a block: products of two blocks at a time stay small in every task.
BLOCK_COLUMNS = 256
# A variance of standardised values below this share of their mean square is rounding.
_CONSTANT = 1e-12


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] | None = None, pair_columns: int = PAIR_COLUMNS
) -> DataFrame:
    """(col_a, col_b, r): Pearson r of every ordered pair.

    Only rows where both values are present count. A constant column has no r. A few
    columns take one aggregate per pair. Beyond ``pair_columns``, what is needed of every pair
    comes from products of three matrices: presence, standardised values (0 where missing)
    and their squares. They are added up per task and merged in a tree, block by block of
    columns, so plan and task do not grow with the number of pairs.
    """
    names = list(columns or numeric_columns(df))
    if not names:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, r double")
    values = [value_column(df, c) for c in names]
    if len(names) > pair_columns:
        return _gram_correlation(df, names, values)

    def deviation(own: int, partner: int) -> Column:
        return F.stddev_pop(F.when(values[partner].isNotNull(), values[own]))

    aggs = []
    for i, j in combinations_with_replacement(range(len(names)), 2):
        spread = deviation(i, j) * deviation(j, i)
        aggs.append(F.try_divide(F.covar_pop(values[i], values[j]), spread).alias(f"r{i}_{j}"))
    row = df.agg(*aggs)
    return inline_rows(
        row,
        [
            F.struct(
                F.lit(names[i]).alias("col_a"),
                F.lit(names[j]).alias("col_b"),
                F.col(f"r{min(i, j)}_{max(i, j)}").alias("r"),
            )
            for i in range(len(names))
            for j in range(len(names))
        ],
    )


def _gram_correlation(
    df: DataFrame, names: list[str], values: list[Column]
) -> DataFrame:
    """Pairwise-complete correlations from Gram matrices of pairs of column blocks."""
    row = df.agg(
        *[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)],
        *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(values)],
    ).first()
    varied = [i for i in range(len(names)) if row[f"s{i}"]]
    blocks = [varied[k : k + BLOCK_COLUMNS] for k in range(0, len(varied), BLOCK_COLUMNS)]
    # One number per pair of columns.
    r = np.full((len(names), len(names)), np.nan)
    for a, b in combinations_with_replacement(range(len(blocks)), 2):
        chosen = sorted({*blocks[a], *blocks[b]})
        r[np.ix_(chosen, chosen)] = _pairwise(df, [values[i] for i in chosen], [(row[f"m{i}"], row[f"s{i}"]) for i in chosen])
    rows = [
        (a, b, None if np.isnan(r[i, j]) else float(r[i, j]))
        for i, a in enumerate(names)
        for j, b in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def _pairwise(df: DataFrame, values: list[Column], scales: list[tuple[float, float]]) -> np.ndarray:
    """r of every pair of ``values``; NaN where one of both is constant among the rows that have both."""
    k, zero = len(values), F.lit(0.0)
    standard = [(v - F.lit(m)) / F.lit(s) for v, (m, s) in zip(values, scales)]
    z = [F.coalesce(x, zero).alias(f"z{i}") for i, x in enumerate(standard)]
    here = [v.isNotNull().cast("double").alias(f"h{i}") for i, v in enumerate(values)]
    rows = df.select(*here, *z).select("*", *[(F.col(f"z{i}") * F.col(f"z{i}")).alias(f"q{i}") for i in range(k)])
    parts = [f"{kind}{i}" for kind in "hzq" for i in range(k)]
    vectors = VectorAssembler(inputCols=parts, outputCol="v").transform(rows).select("v")
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v")).computeGramianMatrix().toArray()
    # Sums over the rows that have both: their number, z and z squared of the first, and the product.
    n, s, q, p = gram[:k, :k], gram[k : 2 * k, :k], gram[2 * k :, :k], gram[k : 2 * k, k : 2 * k]
    with np.errstate(divide="ignore", invalid="ignore"):
        mean, square = s / n, q / n
        variance = square - mean * mean
        variance = np.where(variance > _CONSTANT * square, variance, np.nan)
        return (p / n - mean * mean.T) / np.sqrt(variance * variance.T)


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """(label, n, pct): rows per class and share of all rows in percent."""
    counted = df.groupBy(quoted(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    rows = df.agg(F.count(F.lit(1))).scalar()
    return counted.withColumn("pct", F.round(100.0 * F.col("n") / rows, 2))
