"""Document fingerprints: MinHash signatures, bands joined in Spark, Jaccard verified.

A text's fingerprint is its signature of ``N_HASHES`` universal hash functions over
its five-word shingles, as hex text. The share of equal values in two fingerprints
estimates the Jaccard similarity of the shingle sets. Equal texts have equal
fingerprints.

``near_duplicates`` joins texts on bands of their signatures and verifies each class of
candidates exactly (see ``jaccard_join``, whose grouping and verification it shares).

``edited`` pairs each text with the next one in the order of ids. Rows are dealt out by
ranges of ids; the first row of each range goes to the range before it as well, so each
task meets the successor of its last row, and the first row of all follows the last.

Defined results: null counts as the empty text; texts without words have the fingerprint
of the empty set and likeness 1 to each other, 0 to all others. Rows with a null id come
first, rows with equal ids are ordered by text; a single row follows itself.
An empty table gives no rows; very long texts are read whole, one range at a time in
batches. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tabaudit.llm import jaccard_join, text as words_of

N_HASHES = 128
# Rows of one range of ids, and ranges dealt to one task.
RANGE_ROWS = 2_000
RANGES_PER_TASK = 4
# Ranges at most; they grow beyond RANGE_ROWS then, and are streamed all the same.
MAX_RANGES = 10_000

_LOWEST = -(1 << 63)

EDIT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def signatures(texts: pa.Array, hasher: words_of.MinHasher) -> np.ndarray:
    return hasher.signatures(*words_of.shingles(texts))


def as_hex(signatures_: np.ndarray) -> list[str]:
    return [row.astype(">u4").tobytes().hex() for row in signatures_]


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The share of equal values, row by row; 0 between an empty and another set."""
    same = (left == right).mean(axis=1)
    empty = np.uint32(0xFFFFFFFF)
    return np.where((left == empty).all(axis=1) != (right == empty).all(axis=1), 0.0, same)


def fingerprint(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_hashes: int = N_HASHES
) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every row, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = words_of.MinHasher(n_hashes)
        for batch in batches:
            for part in words_of.slices(batch):
                prints = as_hex(signatures(part.column("text"), hasher))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(prints, pa.string())],
                    names=["doc_id", "fingerprint"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def _edited(own: str, following: str) -> str:
    """``own`` with its last half replaced by as many first characters of ``following``."""
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


def _edit_rows(
    ids: list, own: list[str], following: list[str], hasher: words_of.MinHasher
) -> pa.RecordBatch:
    edits = [_edited(a, b) for a, b in zip(own, following)]
    mine = signatures(pa.array(own, pa.large_string()), hasher)
    # The next text of each row is the row after it, except for the last.
    last = signatures(pa.array(following[-1:], pa.large_string()), hasher)
    changed = signatures(pa.array(edits, pa.large_string()), hasher)
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edits], pa.string()),
        pa.array(as_hex(mine), pa.string()),
        pa.array(as_hex(changed), pa.string()),
        pa.array(likeness(mine, changed)),
        pa.array(likeness(mine, np.concatenate([mine[1:], last]))),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in EDIT_SCHEMA.split(", ")])


def _edit(batches: Iterator[pa.RecordBatch], n_hashes: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted; rows marked ``extra`` only serve as the next text of the row before."""
    hasher = words_of.MinHasher(n_hashes)
    held: tuple | None = None  # the last row, until its successor is met
    for batch in batches:
        for part in words_of.slices(batch):
            ids = part.column("doc_id").to_pylist()
            texts = pc.fill_null(part.column("text"), "").to_pylist()
            extra = part.column("extra").to_pylist()
            if held:
                ids, texts, extra = [held[0], *ids], [held[1], *texts], [held[2], *extra]
            # Runs of rows up to and with the extra row that ends a range.
            start = 0
            for stop in [k for k, e in enumerate(extra) if e] + [len(ids) - 1]:
                if stop > start:
                    yield _edit_rows(ids[start:stop], texts[start:stop], texts[start + 1 : stop + 1], hasher)
                start = max(start, stop + 1 if extra[stop] else stop)
            held = None if extra[-1] else (ids[-1], texts[-1], extra[-1])


def edited(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_hashes: int = N_HASHES,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``EDIT_SCHEMA`` for every row: its fingerprint, and that of its edited text.

    Only the ranges' edges and first ids, at most ``MAX_RANGES`` numbers, reach the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("place"),
    )
    n_ranges = min(MAX_RANGES, max(1, math.ceil(rows.count() / range_rows)))
    shares = [k / n_ranges for k in range(1, n_ranges)]
    edges = np.zeros(0, np.int64)
    if shares:
        at = F.percentile_approx("place", shares, 10 * n_ranges)
        edges = np.unique(np.array(rows.agg(at).first()[0], np.int64))
    if not len(edges):
        placed = rows.withColumn("range", F.lit(0).cast("long"))
    else:
        # A range reaches from one edge, exclusive, to the next, inclusive.
        range_of = F.pandas_udf(lambda place: pd.Series(np.searchsorted(edges, place)), "long")
        placed = rows.withColumn("range", range_of("place"))
    heads = sorted(placed.groupBy("range").agg(F.min("place").alias("head")).collect())
    if not heads:
        return spark.createDataFrame([], EDIT_SCHEMA)
    # The first row of a range also ends the range before it; the first of all ends the last.
    before = [heads[k - 1]["range"] for k in range(len(heads))]
    ends = spark.createDataFrame(
        [(h["head"], r) for h, r in zip(heads, before)], "place long, range long"
    )
    firsts = (
        rows.join(F.broadcast(ends), "place")
        .groupBy("place", "range")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
        .select(F.lit(None).cast("long").alias("doc_id"), "text", "place", "range")
    )
    everything = placed.withColumn("extra", F.lit(False)).unionByName(
        firsts.withColumn("extra", F.lit(True))
    )
    dealt = everything.repartition(math.ceil(len(heads) / RANGES_PER_TASK), "range").sortWithinPartitions(
        "range", "extra", "place", F.coalesce("text", F.lit(""))
    )
    return dealt.select("doc_id", "text", "extra").mapInArrow(
        lambda batches: _edit(batches, n_hashes), EDIT_SCHEMA
    )


def near_duplicates(
    docs: DataFrame, threshold: float = jaccard_join.THRESHOLD, rows: int = jaccard_join.BAND_ROWS
) -> DataFrame:
    """Near duplicates by the bands of this operator's signatures, all candidates verified.

    See ``jaccard_join.join`` for the result; no candidate is pruned by its signature.
    """
    settings = jaccard_join.Settings(
        threshold=threshold, n_hashes=N_HASHES, band_rows=rows, tolerance=0.0
    )
    return jaccard_join.join(docs, settings)
