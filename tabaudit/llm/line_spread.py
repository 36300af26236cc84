"""Line dedup by site spread: lines that occur on many sites are boilerplate.

A line's sites are counted by HyperLogLog sketches, merged by aggregation. Lines
whose estimate lies near the threshold are counted exactly. Lines found on
``min_sites`` sites or more are removed from every document, unless they make up
more than ``max_share`` of a document's characters: such a document is a copy of
others, not a page with boilerplate, and stays whole for near-duplicate removal.

Lines are what ``\\n`` separates, compared without white space at their ends; lines
without a word are never counted or removed.

Defined results: a null text stays null and an empty one empty; a null site is one
more site; repeated rows are counted as one site and cleaned alike. An empty table has
no spread lines and stays empty; texts and lines of any length are read whole. All
columns pass through; only the text changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabaudit.llm import frames
from tabaudit.session import materialize

MIN_SITES = 10
MAX_SHARE = 0.5
# 2**LG_K registers per sketch: a relative standard error of about 1.6 %.
LG_K = 12
# Estimates within this share of the threshold, over six standard errors, are counted exactly.
NEAR_SHARE = 0.1

_KEYS = ["_key1", "_key2"]


def _line_keys(line: Column) -> list[Column]:
    """128 bits of hash of a trimmed line."""
    trimmed = F.btrim(line, F.lit(frames.BLANKS))
    return [F.xxhash64(trimmed).alias(_KEYS[0]), F.xxhash64(F.lit(1), trimmed).alias(_KEYS[1])]


def _lines(docs: DataFrame, columns: list[Column], text: Column) -> DataFrame:
    """``columns``, position and keys of all lines with a word."""
    exploded = docs.select(*columns, F.posexplode(F.split(text, "\n", -1)).alias("_pos", "_line"))
    full = exploded.filter(F.length(F.btrim("_line", F.lit(frames.BLANKS))) > 0)
    return full.select(*[c for c in full.columns if c != "_line"], *_line_keys(F.col("_line")))


def spread_lines(
    docs: DataFrame,
    site_col: str = "source",
    text_col: str = "text",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """Keys of the lines found on ``min_sites`` sites or more, one row per line."""
    site = F.coalesce(frames.field(site_col).cast("string"), F.lit("")).alias("_site")
    lines = _lines(frames.packed(docs), [site], frames.field(text_col)).drop("_pos")
    sketched = lines.groupBy(*_KEYS).agg(F.hll_sketch_agg("_site", LG_K).alias("_sketch"))
    estimate = F.hll_sketch_estimate("_sketch")
    near, sure = min_sites * (1 - NEAR_SHARE), min_sites * (1 + NEAR_SHARE)
    likely = materialize(
        sketched.filter(estimate >= int(near)).select(*_KEYS, estimate.alias("_sites")), "spread"
    )
    doubtful = frames.broadcast_if_few(likely.filter(F.col("_sites") <= sure).select(*_KEYS))
    exact = (
        lines.join(doubtful, _KEYS, "left_semi")
        .groupBy(*_KEYS, "_site")
        .agg(F.lit(1).alias("_one"))
        .groupBy(*_KEYS)
        .agg(F.count("_one").alias("_sites"))
        .filter(F.col("_sites") >= min_sites)
    )
    certain = likely.filter(F.col("_sites") > sure)
    return materialize(certain.select(*_KEYS).unionByName(exact.select(*_KEYS)), "spread-lines")


def remove_lines(
    docs: DataFrame,
    spread: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_share: float = MAX_SHARE,
    removed_col: str | None = None,
) -> DataFrame:
    """``docs`` without the lines in ``spread``; ``removed_col`` adds how many were removed."""
    rows = frames.packed(docs)
    text = frames.field(text_col)
    # Rows that agree in id and text agree in their lines, so repeated rows need no key of their own.
    key = [frames.field(id_col).alias("_id"), F.xxhash64(text).alias("_text")]
    hits = (
        _lines(rows, key, text)
        .join(frames.broadcast_if_few(spread), _KEYS, "left_semi")
        .groupBy("_id", "_text")
        .agg(F.collect_set("_pos").alias("_hits"))
        .withColumnsRenamed({"_id": "_hit_id", "_text": "_hit_text"})
    )
    # Few documents have such lines, as a rule: their positions go to the texts, not the texts to them.
    hits = materialize(hits, "hits")
    size = hits.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("_hits")).alias("lines")).first()
    if size["rows"] <= frames.BROADCAST_ROWS and (size["lines"] or 0) <= 4 * frames.BROADCAST_ROWS:
        hits = F.broadcast(hits)
    same = (F.col("_id").eqNullSafe(F.col("_hit_id"))) & (F.col("_text") == F.col("_hit_text"))
    joined = rows.select("_row", *key).join(hits, same, "left")
    kept = F.array_join(
        F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains("_hits", i)), "\n"
    )
    cleaned = joined.select(
        "_row", F.size("_hits").alias("_n"), F.when(F.col("_hits").isNotNull(), kept).alias("_kept")
    )
    # Line breaks that go with a line count as removed.
    takes_effect = F.col("_kept").isNotNull() & (
        F.length("_kept") >= F.length(text) * F.lit(1 - max_share)
    )
    n_removed = F.when(takes_effect, F.col("_n")).otherwise(0).cast("long")
    new_text = F.when(takes_effect, F.col("_kept")).otherwise(text)
    columns = [new_text.alias(c) if c == text_col else frames.field(c).alias(c) for c in docs.columns]
    return cleaned.select(*columns, *([n_removed.alias(removed_col)] if removed_col else []))
