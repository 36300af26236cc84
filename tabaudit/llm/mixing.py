"""Mixing sources to target weights by iterative proportional fitting.

The token counts of all combinations of categories (cells) are raked to target
shares of each dimension in turn, sweep by sweep. The ratio of a cell's raked to
its actual share, scaled to the wanted number of tokens and capped at 1, is the
probability of its documents; a hash of the document id decides.

Only categories named in the targets have cells of their own, all others (and null)
share the category ``*``. So there are at most as many cells as the product of the
numbers of targets, whatever the data; they are raked inside one row by SQL
functions on arrays.

Defined results: a document without tokens adds nothing to a cell, but is sampled
like the others of its cell; a cell without any tokens has probability ``share``.
Targets of categories without tokens are dealt out to the others in proportion; a
present category without a target has target 0. Repeated rows with one id are kept
or dropped together; a null id counts as the empty text. An empty table stays empty.
Very long documents weigh all their tokens.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tabaudit.llm import frames

REST = "*"
SWEEPS = 50
# The share of all tokens that is wanted.
SHARE = 0.9

# Kinds of text, told by markers anywhere in the text; the first that fits counts.
TOPICS = {"licence": "[Ll]icen[sc]e|Copyright", "table": r" \| ", "figures": "[0-9]"}
NO_TOPIC = "prose"


def n_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(frames.WORD)).cast("long")


def topic_of(text: Column) -> Column:
    topic = F.lit(NO_TOPIC)
    for name, pattern in reversed(TOPICS.items()):
        topic = F.when(F.coalesce(text, F.lit("")).rlike(pattern), F.lit(name)).otherwise(topic)
    return topic


def category(value: Column, targets: Mapping[str, float]) -> Column:
    named = F.array(*[F.lit(k) for k in targets])
    return F.when(F.array_contains(named, value.cast("string")), value.cast("string")).otherwise(REST)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _raked(cells: Column, dimension: str, targets: Mapping[str, float]) -> Column:
    """``cells`` with their weights scaled so that the dimension's margins meet its targets."""
    names = list(dict.fromkeys([*targets, REST]))
    wanted = [float(targets.get(n, 0.0)) for n in names]
    place = F.array(*[F.lit(n) for n in names])

    def margin(name: str) -> Column:
        return _sum(
            F.transform(cells, lambda c: F.when(c[dimension] == name, c["weight"]).otherwise(0.0))
        )

    def factors(margins: Column) -> Column:
        # Targets of categories without weight are dealt out to the others.
        shares = [F.when(margins[k] > 0, F.lit(w)).otherwise(0.0) for k, w in enumerate(wanted)]
        return _let(
            _sum(F.array(*shares)),
            lambda present: F.array(
                *[F.when(s > 0, s / present / margins[k]).otherwise(0.0) for k, s in enumerate(shares)]
            ),
        )

    def scaled(scale: Column) -> Column:
        def cell(c):
            factor = F.element_at(scale, F.array_position(place, c[dimension]).cast("int"))
            return c.withField("weight", c["weight"] * factor)

        return F.transform(cells, cell)

    return _let(F.array(*[margin(n) for n in names]), lambda margins: _let(factors(margins), scaled))


def cell_probabilities(
    cells: DataFrame,
    targets: Mapping[str, Mapping[str, float]],
    share: float = SHARE,
    sweeps: int = SWEEPS,
) -> DataFrame:
    """One row per cell: the dimensions, its tokens and the probability of its documents.

    ``cells`` has the dimensions and ``tokens``.
    """
    dims = list(targets)
    one = cells.agg(
        F.sort_array(F.collect_list(F.struct(*dims, F.col("tokens").cast("double").alias("tokens"))))
        .alias("cells")
    )
    total = _sum(F.transform("cells", lambda c: c["tokens"]))
    start = F.transform(
        "cells",
        lambda c: c.withField(
            "weight", F.when(F.col("total") > 0, c["tokens"] / F.col("total")).otherwise(0.0)
        ),
    )

    # One step rakes one dimension; the steps are taken one after the other by a fold.
    def step(state, i):
        out = _raked(state, dims[-1], targets[dims[-1]])
        for k, d in reversed(list(enumerate(dims[:-1]))):
            out = F.when(i % len(dims) == k, _raked(state, d, targets[d])).otherwise(out)
        return out

    steps = F.sequence(F.lit(0), F.lit(sweeps * len(dims) - 1))
    raked = (
        one.withColumn("total", total)
        .withColumn("state", start)
        .select("total", F.aggregate(steps, F.col("state"), step).alias("state"))
    )
    ratio = F.transform(
        "state",
        lambda c: c.withField(
            "ratio",
            F.when(c["tokens"] > 0, c["weight"] / (c["tokens"] / F.col("total"))).otherwise(1.0),
        ),
    )
    rated = raked.select("total", ratio.alias("state"))

    # Capped cells give all they have; the others share what is still wanted.
    def lift(level, _):
        capped = _sum(
            F.transform(
                "state", lambda c: F.when(level * c["ratio"] >= 1, c["tokens"]).otherwise(0.0)
            )
        )
        open_ = _sum(
            F.transform(
                "state",
                lambda c: F.when(level * c["ratio"] < 1, c["tokens"] * c["ratio"]).otherwise(0.0),
            )
        )
        return F.when(open_ > 0, (F.lit(share) * F.col("total") - capped) / open_).otherwise(level)

    level = F.aggregate(F.sequence(F.lit(1), F.size("state") + 1), F.lit(float(share)), lift)
    levelled = rated.select("state", level.alias("level"))
    cell = levelled.select(F.explode("state").alias("c"), "level")
    chance = F.when(F.col("c.tokens") > 0, F.least(F.lit(1.0), F.col("level") * F.col("c.ratio")))
    return cell.select(
        *[F.col(f"c.{d}").alias(d) for d in dims],
        F.col("c.tokens").cast("long").alias("tokens"),
        chance.otherwise(F.lit(float(share))).alias("probability"),
    )


def uniform(id_: Column) -> Column:
    """A number in [0, 1) from the MD5 of the id."""
    digest = F.md5(F.coalesce(id_.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def decisions(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]],
    values: Mapping[str, Column],
    tokens: Column,
    id_: Column,
    share: float = SHARE,
    sweeps: int = SWEEPS,
) -> DataFrame:
    """``docs`` packed in ``_row``, with ``_cell`` (the dimensions), ``_tokens``, ``_probability``, ``_kept``.

    ``values`` gives each dimension of ``targets`` as an expression over ``_row``, as
    do ``tokens`` and ``id_`` (see ``frames.field``).
    """
    cell = F.struct(*[category(values[d], targets[d]).alias(d) for d in targets])
    rows = frames.packed(docs).select("_row", cell.alias("_cell"), tokens.alias("_tokens"))
    sums = rows.groupBy(*[F.col(f"_cell.{d}").alias(d) for d in targets]).agg(
        F.sum("_tokens").alias("tokens")
    )
    chances = cell_probabilities(sums, targets, share, sweeps).select(
        F.struct(*targets).alias("_of"), F.col("probability").alias("_probability")
    )
    # At most as many rows as combinations of targets.
    joined = rows.join(F.broadcast(chances), F.col("_cell") == F.col("_of"))
    return joined.select(
        "_row", "_cell", "_tokens", "_probability", (uniform(id_) < F.col("_probability")).alias("_kept")
    )
