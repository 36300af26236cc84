"""Conflict-constrained best-fit packing of documents into bins of fixed capacity.

Documents longer than a bin fill whole bins; what is left of them is packed. Pieces
are placed in order of falling length, each into the tightest bin that it fits and
that it does not conflict with: a bin holds at most ``max_per_source`` pieces of one
source, and one piece of each duplicate cluster. Bins are kept sorted by residual
capacity and carry bitmaps of sources (one bit per piece of a source allowed) and of
clusters; the search starts at the smallest residual that fits and goes on to the
next bin until no bit is taken. Only if no bin is left a new one is opened.

Documents are dealt out by hash into groups of about ``bins_per_group`` bins' worth
of tokens; groups are packed apart, so no task grows with the corpus, whatever
source or cluster dominates it.

Defined results: a document without tokens gets one row without a bin. A null source
is a source of its own; a null cluster conflicts with nothing. Repeated rows are
packed each for itself; a null id is packed like others. An empty table gives no rows.
A very long document is as many full bins and one piece. Extra columns are not read.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tabaudit.session import materialize

CAPACITY = 4096
MAX_PER_SOURCE = 4
BINS_PER_GROUP = 512

SCHEMA = (
    "bin_group long, bin long, slot int, doc_id long, source string, "
    "start_token long, n_tokens long"
)


def pack_group(
    lengths: list[int], sources: list[int], clusters: list[int], capacity: int, max_per_source: int
) -> list[tuple[int, int]]:
    """The bin and the slot of each piece, in the given order; pieces fit into a bin.

    ``sources`` are codes from 0. ``clusters`` are codes from 0, or -1 without
    conflicts. Bins are numbered in the order of their opening.
    """
    placed: list[tuple[int, int]] = []
    by_residual: list[tuple[int, int]] = []
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    n_in_bin: list[int] = []
    quota = (1 << max_per_source) - 1
    for length, source, cluster in zip(lengths, sources, clusters):
        shift = source * max_per_source
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        at = bisect.bisect_left(by_residual, (length, -1))
        while at < len(by_residual):
            bin_ = by_residual[at][1]
            full = (source_bits[bin_] >> shift) & quota == quota
            if not full and not cluster_bits[bin_] & cluster_bit:
                break
            at += 1
        if at < len(by_residual):
            residual, bin_ = by_residual.pop(at)
        else:
            residual, bin_ = capacity, len(n_in_bin)
            source_bits.append(0)
            cluster_bits.append(0)
            n_in_bin.append(0)
        used = (source_bits[bin_] >> shift) & quota
        source_bits[bin_] |= (used + 1) << shift  # bits of a source are taken from the lowest up
        cluster_bits[bin_] |= cluster_bit
        placed.append((bin_, n_in_bin[bin_]))
        n_in_bin[bin_] += 1
        bisect.insort(by_residual, (residual - length, bin_))
    return placed


def _group_rows(group: int, pdf: pd.DataFrame, capacity: int, max_per_source: int) -> pd.DataFrame:
    pdf = pdf.assign(rest=pdf["n"] % capacity, full=pdf["n"] // capacity)
    pieces = pdf[pdf["rest"] > 0].sort_values(
        ["rest", "id", "source", "cluster"], ascending=[False, True, True, True], kind="stable"
    )
    clusters, repeats = pieces["cluster"], pieces["cluster"].duplicated(keep=False)
    codes = np.full(len(pieces), -1)
    shared = (repeats & clusters.notna()).to_numpy()
    codes[shared] = pd.factorize(clusters[shared])[0]
    sources = pd.factorize(pieces["source"], use_na_sentinel=False)[0]
    placed = pack_group(
        pieces["rest"].tolist(), sources.tolist(), codes.tolist(), capacity, max_per_source
    )
    bins, slots = np.array(placed, dtype=np.int64).reshape(-1, 2).T
    out = [
        pd.DataFrame(
            {
                "bin": bins, "slot": slots, "doc_id": pieces["id"], "source": pieces["source"],
                "start_token": pieces["full"] * capacity, "n_tokens": pieces["rest"],
            }
        )
    ]
    n_bins = int(bins.max()) + 1 if len(bins) else 0
    long = pdf[pdf["full"] > 0].sort_values(["id", "source", "n"], kind="stable")
    whole = long.loc[long.index.repeat(long["full"])]
    start = whole.groupby(level=0).cumcount() * capacity
    out.append(
        pd.DataFrame(
            {
                "bin": n_bins + np.arange(len(whole)), "slot": 0, "doc_id": whole["id"],
                "source": whole["source"], "start_token": start, "n_tokens": capacity,
            }
        )
    )
    empty = pdf[pdf["n"] == 0]
    out.append(
        pd.DataFrame(
            {"doc_id": empty["id"], "source": empty["source"], "start_token": 0, "n_tokens": 0}
        )
    )
    rows = pd.concat([o for o in out if len(o)], ignore_index=True)
    for name in ("bin", "slot", "doc_id"):
        rows[name] = rows[name].astype("Int64") if name in rows else pd.array([pd.NA] * len(rows), "Int64")
    rows["bin_group"] = group
    return rows[[f.split()[0] for f in SCHEMA.split(", ")]]


def pack(
    docs: DataFrame,
    n_tokens: Column,
    id_: Column,
    source: Column,
    cluster: Column,
    capacity: int = CAPACITY,
    max_per_source: int = MAX_PER_SOURCE,
    bins_per_group: int = BINS_PER_GROUP,
    row: Column | None = None,
) -> DataFrame:
    """One row per piece: its bin (``bin_group``, ``bin``), slot, document and token span.

    ``cluster`` is a long that duplicates share, ``row`` a number that spreads rows that repeat
    (by default, that of the row in ``docs``; the measured rows are then written first).
    """
    rows = docs.select(
        id_.cast("long").alias("id"),
        source.cast("string").alias("source"),
        cluster.cast("long").alias("cluster"),
        F.coalesce(n_tokens.cast("long"), F.lit(0)).alias("n"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
    )
    if row is None:
        # Numbered once: a task that is run again must not deal rows out otherwise. Texts are read once too.
        rows = materialize(rows, "measured")
    total = rows.agg(F.sum("n")).first()[0] or 0
    groups = max(1, math.ceil(total / (capacity * bins_per_group)))
    # The row's own number spreads rows that repeat.
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("id", "row"), F.lit(groups))).drop("row")

    def run(key, pdf):
        pdf = pdf.astype({"id": "Int64", "cluster": "Int64"})
        return _group_rows(int(key[0]), pdf, capacity, max_per_source)

    return dealt.groupBy("group").applyInPandas(run, SCHEMA)
