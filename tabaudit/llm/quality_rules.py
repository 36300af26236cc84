"""Quality rules: base rules, then hashed n-gram log-likelihood ratios against trusted text.

Words and pairs of neighbouring words are hashed into a fixed number of buckets.
Two multinomials over these buckets are counted: one from trusted documents, one
from the whole corpus. A document's score is the mean over its n-grams of
``ln(p_trusted / p_corpus)``. It is kept if it passes the base rules and scores at
least the threshold: a low quantile of the scores of trusted documents that were
held out of the trusted counts, less a margin.

Bucket weights are rounded to integers, so that sums do not depend on the order in
which n-grams or partitions are added up.

Defined results: a null text counts as empty; a text without words fails the base
rules. Without trusted documents all weights are 0 and only the base rules decide.
Repeated rows are judged alike, each for itself. An empty table gives no rows. Very
long texts are counted and scored whole, one at a time. Columns other than the id and the text pass through ``keep`` and are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tabaudit.llm import frames, text as words_of
from tabaudit.session import materialize

N_BUCKETS = 1 << 16
# Words are hashed to the first 32 bits of their MD5; a pair is combined modulo a prime.
PAIR_FACTOR = 1_000_003
PAIR_PRIME = 2_147_483_647
# Added to every bucket's count.
SMOOTHING = 1.0
# Weights are integers in units of 1 / WEIGHT_UNIT.
WEIGHT_UNIT = 1 << 20
# Trusted documents whose MD5 of the id starts with a smaller hex digit place the threshold.
HELD_OUT_BELOW = "4"
# The share of held-out documents that may score below the quantile, and the margin below it:
# the quantile of few held-out documents lies above that of all trusted ones about as often as below.
TRUSTED_SHARE = 0.005
MARGIN = 0.05
# Scores are counted in bins of this width to find the quantile.
SCORE_BIN = 0.001
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
_SYMBOLS = "[#*$%&|<>]"

SCORE_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, n_grams long, weight_sum long"
)


def _buckets(texts: pa.Array, n_buckets: int):
    """Word codes and starts of the texts; buckets of words, and of pairs with their text."""
    codes, starts, vocabulary = words_of.coded_words(texts)
    digests = (int(hashlib.md5(w).hexdigest()[:8], 16) for w in vocabulary)
    hashes = np.fromiter(digests, np.int64, len(vocabulary))[codes]
    text_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    joined = np.flatnonzero(text_of[1:] == text_of[:-1])
    pairs = (hashes[joined] * PAIR_FACTOR + hashes[joined + 1]) % PAIR_PRIME % n_buckets
    return codes, starts, text_of, hashes % PAIR_PRIME % n_buckets, pairs, text_of[joined]


def _repeated_words(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per text, the words inside three-word windows that occur twice or more in it."""
    out = np.zeros(len(starts) - 1, np.int64)
    base = int(codes.max()) + 1 if len(codes) else 1
    for i, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        if b - a < 4:
            continue
        own = codes[a:b]
        # Codes stay below 2**21 in a slice of SLICE_BYTES; longer texts are coded anew.
        if base > 1 << 21:
            own = np.unique(own, return_inverse=True)[1]
        keys = (own[:-2] << 42) | (own[1:-1] << 21) | own[2:]
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        repeated = np.zeros(len(keys), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        inside = np.zeros(len(own), bool)
        for shift in range(3):
            inside[shift : len(own) - 2 + shift] |= repeated
        out[i] = inside.sum()
    return out


def _duplicate_lines(texts: pa.Array) -> np.ndarray:
    """Per text, the lines with a word that equal an earlier line of the text."""
    lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    offsets = lines.offsets.to_numpy().astype(np.int64)
    flat = lines.values
    full = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0)
    full = full.to_numpy(zero_copy_only=False)
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[full]
    keys = text_of * (len(flat) + 1) + codes[full]
    first = np.unique(keys, return_index=True)[1]
    count = np.bincount(text_of, minlength=len(texts))
    return count - np.bincount(text_of[first], minlength=len(texts))


def _counts(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket that occurs in the task's documents."""
    corpus, trusted = np.zeros(n_buckets, np.int64), np.zeros(n_buckets, np.int64)
    for batch in batches:
        for part in words_of.slices(batch):
            _, _, text_of, singles, pairs, pair_text = _buckets(part.column("text"), n_buckets)
            good = part.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            for buckets, owner in ((singles, text_of), (pairs, pair_text)):
                corpus += np.bincount(buckets, minlength=n_buckets)
                trusted += np.bincount(buckets[good[owner]], minlength=n_buckets)
    used = np.flatnonzero(corpus)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(corpus[used]), pa.array(trusted[used])],
        names=["bucket", "corpus", "trusted"],
    )


def _judge(part: pa.RecordBatch, weights: np.ndarray, id_col: str | None) -> pa.RecordBatch:
    texts = pc.fill_null(part.column("text"), "")
    codes, starts, text_of, singles, pairs, pair_text = _buckets(texts, len(weights))
    n_words = np.diff(starts)
    flat, _ = words_of.flat_words(texts)
    chars = np.bincount(
        text_of, pc.utf8_length(flat).to_numpy(zero_copy_only=False), len(n_words)
    ).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(weights[singles])])
    weight = sums[starts[1:]] - sums[starts[:-1]]
    pair_starts = np.searchsorted(pair_text, np.arange(len(n_words) + 1))
    sums = np.concatenate([[0], np.cumsum(weights[pairs])])
    weight = weight + sums[pair_starts[1:]] - sums[pair_starts[:-1]]
    repeated = _repeated_words(codes, starts)
    failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n_words)
    symbols = pc.count_substring_regex(texts, _SYMBOLS).to_numpy(zero_copy_only=False)
    ids = part.column(id_col) if id_col else pa.nulls(len(n_words), pa.int64())
    columns = [
        ids.cast(pa.int64()), n_words, chars, symbols.astype(np.int64), _duplicate_lines(texts),
        repeated, failed, np.where(n_words > 0, 2 * n_words - 1, 0), weight,
    ]
    names = [field.split()[0] for field in SCORE_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


@dataclass(frozen=True)
class QualityRules:
    """Bucket weights and the lowest score that is kept."""

    weights: np.ndarray
    threshold: float

    def scores(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``SCORE_SCHEMA`` for every row; the threshold is not applied yet."""
        weights = self.weights

        def run(batches):
            for batch in batches:
                for part in words_of.slices(batch):
                    yield _judge(part, weights, "doc_id")

        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        return rows.mapInArrow(run, SCORE_SCHEMA)

    def verdicts(self, scores: DataFrame) -> DataFrame:
        """Adds ``score`` (null without n-grams) and ``kept`` to rows of ``scores``."""
        score = score_of("weight_sum", "n_grams")
        kept = ~F.col("base_failed") & (F.coalesce(score, F.lit(0.0)) >= F.lit(self.threshold))
        return scores.withColumns({"score": score, "kept": kept})

    def keep(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """The rows of ``docs`` that are kept, with all their columns, in one pass without a join."""
        weights, threshold = self.weights, self.threshold

        def run(batches):
            for batch in batches:
                for part in words_of.slices(batch, text_col):
                    texts = pa.RecordBatch.from_arrays([part.column(text_col)], names=["text"])
                    rows = _judge(texts, weights, None)
                    total, grams, failed = (
                        rows.column(c).to_numpy(zero_copy_only=False)
                        for c in ("weight_sum", "n_grams", "base_failed")
                    )
                    score = total / np.maximum(grams, 1) / WEIGHT_UNIT
                    yield part.filter(pa.array(~failed.astype(bool) & (score >= threshold)))

        return docs.mapInArrow(run, docs.schema)


def score_of(weight_sum: str, n_grams: str):
    return F.when(F.col(n_grams) > 0, F.col(weight_sum) / F.col(n_grams) / F.lit(WEIGHT_UNIT))


def fit(
    docs: DataFrame,
    trusted_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_buckets: int = N_BUCKETS,
) -> tuple[QualityRules, DataFrame]:
    """Count both multinomials over all documents and place the threshold.

    ``trusted_ids`` has one column of document ids. Returns the rules and the
    scores of all documents, which placing the threshold needs anyway. Only the
    ``n_buckets`` counts and the bins of the score histogram reach the driver.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    trusted_ids = trusted_ids.toDF("trusted_id").select(F.col("trusted_id").cast("long"))
    held_out = frames.held_out(F.col("trusted_id"), HELD_OUT_BELOW)
    counted = frames.marked(rows, trusted_ids.filter(~held_out)).select("text", "trusted").mapInArrow(
        lambda batches: _counts(batches, n_buckets), "bucket long, corpus long, trusted long"
    )
    totals = counted.groupBy("bucket").agg(
        F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted")
    )
    corpus, trusted = np.zeros(n_buckets, np.int64), np.zeros(n_buckets, np.int64)
    for row in totals.collect():
        corpus[row.bucket], trusted[row.bucket] = row.corpus, row.trusted
    rules = QualityRules(bucket_weights(corpus, trusted), float("-inf"))
    scores = materialize(rules.scores(rows), "quality-scores")
    return QualityRules(rules.weights, _threshold(scores, trusted_ids.filter(held_out))), scores


def bucket_weights(corpus: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """Integer log ratios of the two smoothed multinomials; 0 where one of them is empty."""
    if not trusted.sum() or not corpus.sum():
        return np.zeros(len(corpus), np.int64)
    extra = SMOOTHING * len(corpus)
    p = (trusted + SMOOTHING) / (trusted.sum() + extra)
    q = (corpus + SMOOTHING) / (corpus.sum() + extra)
    return np.rint(np.log(p / q) * WEIGHT_UNIT).astype(np.int64)


def _threshold(scores: DataFrame, held_out: DataFrame) -> float:
    """The lower edge of the bin that holds the quantile of the held-out scores, less the margin."""
    rows = frames.marked(scores.filter(~F.col("base_failed")), held_out).filter("trusted")
    score = score_of("weight_sum", "n_grams")
    lowest = frames.lower_quantile(rows, score, TRUSTED_SHARE, SCORE_BIN).first()[0]
    return float("-inf") if lowest is None else lowest * SCORE_BIN - MARGIN
