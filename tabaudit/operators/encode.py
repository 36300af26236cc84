"""Standard scaling and ordinal encoding with fitted state held as tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabaudit.operators.cleaning import clean_features, infer_column_roles, quoted
from tabaudit.operators.positions import with_sum_before
from tabaudit.operators.profile import inline_rows
from tabaudit.operators.quantiles import value_column
from tabaudit.session import materialize

# Fixed value: the code of a category that was not seen when fitting.
UNSEEN = -1.0

# Categories of one column up to which codes are looked up in an inlined list.
INLINE_LIMIT = 64
# Characters of category text, over all columns, up to which code tables may be broadcast.
BROADCAST_CHARS = 32_000_000
# Distinct values of one column that a single task may sort.
SORT_LIMIT = 1_000_000

CODES_SCHEMA = "column string, value string, code double"
SCALER_SCHEMA = "column string, mean double, scale double"


def _scaler_aggregates(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    aggs = []
    for i, c in enumerate(columns):
        v, sd = value_column(df, c), F.stddev_pop(value_column(df, c))
        aggs += [F.avg(v).alias(f"m{i}"), F.when(sd == 0, 1.0).otherwise(sd).alias(f"s{i}")]
    return aggs


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, scale): mean and population deviation; a zero deviation scales by 1."""
    if not columns:
        return df.sparkSession.createDataFrame([], SCALER_SCHEMA)
    return inline_rows(
        df.agg(*_scaler_aggregates(df, columns)),
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"m{i}").alias("mean"),
                F.col(f"s{i}").alias("scale"),
            )
            for i, c in enumerate(columns)
        ],
    )


def _sketched_sizes(columns: Sequence[str]) -> list[Column]:
    return [F.approx_count_distinct(quoted(c)).alias(f"n{i}") for i, c in enumerate(columns)]


def fit_ordinal(
    df: DataFrame,
    columns: Sequence[str],
    sort_limit: int = SORT_LIMIT,
    sizes: dict[str, int] | None = None,
) -> DataFrame:
    """(column, value, code): categories of each column in code-point order from 0.

    Distinct values are found by a map-side combined aggregation. Columns with few
    of them are numbered by one sort each; a column with more is cut into ranges of
    values that are sorted apart and numbered from the sizes of the ranges before.
    Sketched ``sizes`` only choose the way of numbering, never the numbers.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], CODES_SCHEMA)
    if sizes is None:
        row = df.agg(*_sketched_sizes(columns)).first()
        sizes = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    large = [c for c in columns if sizes[c] > sort_limit]
    small = [c for c in columns if c not in large]
    parts = []
    if small:
        order = Window.partitionBy("column").orderBy("value")
        code = (F.row_number().over(order) - 1).cast("double")
        parts.append(_distinct_values(df, small).withColumn("code", code))
    for name in large:
        parts.append(_number_in_ranges(_distinct_values(df, [name])))
    return reduce(DataFrame.unionByName, parts)


def _distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return df.select(F.inline(pairs)).filter("value IS NOT NULL").distinct()


def _number_in_ranges(values: DataFrame) -> DataFrame:
    """Number the distinct values of one column by ranges of the values themselves."""
    placed = with_sum_before(values, [F.col("value")], "place")
    return placed.select("column", "value", F.col("place").cast("double").alias("code"))


@dataclass
class Preprocessor:
    """Fitted scaler and encoder: numeric block first, then categorical block.

    ``scaler`` is one (mean, scale) per numeric column. Short category lists are
    held in ``inline``; the rest stay in the ``codes`` table and are joined.
    """

    num_cols: list[str]
    cat_cols: list[str]
    scaler: dict[str, tuple[float | None, float | None]]
    codes: DataFrame
    inline: dict[str, list[str]] = field(default_factory=dict)
    broadcast: set[str] = field(default_factory=set)
    missing_as_unknown: bool = False

    @property
    def feature_cols(self) -> list[str]:
        return [*self.num_cols, *self.cat_cols]

    def scaled(self, df: DataFrame, name: str) -> Column:
        mean, scale = self.scaler[name]
        return (value_column(df, name) - F.lit(mean)) / F.lit(scale)

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns, then the encoded features; every other column is dropped.

        The table must be clean. Inlined and scaled columns need no shuffle at all.
        """
        kept = [quoted(c).alias(f"_keep_{i}") for i, c in enumerate(keep)]
        out = df.select(
            *kept,
            *[self.scaled(df, c).alias(f"_num_{i}") for i, c in enumerate(self.num_cols)],
            *[quoted(c).cast("string").alias(f"_cat_{i}") for i, c in enumerate(self.cat_cols)],
        )
        encoded = []
        spread = F.concat(F.lit("\0"), F.xxhash64(*out.columns).cast("string"))
        for i, c in enumerate(self.cat_cols):
            raw = F.col(f"_cat_{i}")
            if c in self.inline:
                known = F.array(*[F.lit(v) for v in self.inline[c]]).cast("array<string>")
                code = F.array_position(known, raw).cast("double") - 1
            else:
                table = self.codes.filter(F.col("column") == c).select(
                    F.col("value").alias(f"_cat_{i}"), F.col("code").alias(f"_code_{i}")
                )
                if c in self.broadcast:
                    table = F.broadcast(table)
                # Rows without a value need no lookup; spread out, they meet in no task.
                known = table.withColumnRenamed(f"_cat_{i}", f"_known_{i}")
                lookup = raw if c in self.broadcast else F.coalesce(raw, spread)
                out = out.join(known, lookup == F.col(f"_known_{i}"), "left").drop(f"_known_{i}")
                code = F.when(raw.isNotNull(), F.col(f"_code_{i}"))
            encoded.append(F.coalesce(code, F.lit(UNSEEN)).alias(c))
        return out.select(
            *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
            *[F.col(f"_num_{i}").alias(c) for i, c in enumerate(self.num_cols)],
            *encoded,
        )

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Clean, then apply."""
        return self.apply(clean_features(df, self.cat_cols, self.missing_as_unknown), keep)


def build_preprocessor(
    num_cols: Sequence[str],
    cat_cols: Sequence[str],
    scaler: dict[str, tuple[float | None, float | None]],
    codes: DataFrame,
    missing_as_unknown: bool = False,
    inline_limit: int = INLINE_LIMIT,
    broadcast_chars: int = BROADCAST_CHARS,
) -> Preprocessor:
    """Size each column's category list and choose how it will be looked up."""
    if not cat_cols:
        return Preprocessor(list(num_cols), [], scaler, codes)
    # Per column its size and at most ``inline_limit`` values.
    first = F.when(F.col("code") < inline_limit, F.struct("code", "value"))
    lists = (
        codes.groupBy("column")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.length("value") + 16).alias("chars"),
            F.collect_list(first).alias("head"),
        )
        .collect()
    )
    inline: dict[str, list[str]] = {c: [] for c in cat_cols}
    medium = set()
    budget = broadcast_chars
    for r in sorted(lists, key=lambda r: (r["chars"], r["column"])):
        if r["n"] <= inline_limit:
            inline[r["column"]] = [entry["value"] for entry in sorted(r["head"])]
        else:
            del inline[r["column"]]
            if r["chars"] <= budget:
                budget -= r["chars"]
                medium.add(r["column"])
    return Preprocessor(
        list(num_cols), list(cat_cols), scaler, codes, inline, medium, missing_as_unknown
    )


def fit_preprocessor(
    df: DataFrame,
    num_cols: Sequence[str] | None = None,
    cat_cols: Sequence[str] | None = None,
    text_cols: Sequence[str] | None = None,
    missing_as_unknown: bool = False,
) -> Preprocessor:
    """Clean, infer roles where not given, fit scaler and encoder.

    Two passes: one for the scaler and the sizes of the vocabularies, one for the
    vocabularies. ``text_cols`` are cleaned; by default the categorical columns.
    """
    nums, cats = infer_column_roles(df, num_cols, cat_cols)
    cleaned = clean_features(df, text_cols if text_cols is not None else cats, missing_as_unknown)
    aggs = [*_scaler_aggregates(cleaned, nums), *_sketched_sizes(cats)]
    row = cleaned.agg(*aggs).first() if aggs else None
    scaler = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(nums)}
    sizes = {c: row[f"n{i}"] for i, c in enumerate(cats)}
    codes = fit_ordinal(cleaned, cats, sizes=sizes)
    if cats:
        codes = materialize(codes, "category_codes")
    return build_preprocessor(nums, cats, scaler, codes, missing_as_unknown)
