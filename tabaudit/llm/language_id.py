"""Language identification by sparse multinomial logistic regression on character n-grams.

Texts are lower-cased, runs of anything but letters become one blank, and all runs of
one to three characters are hashed into a fixed number of features. A feature's value
is its share of the text's n-grams times its inverse document frequency, which is
counted over all documents that may be learned from. Weights are learned by
follow-the-regularised-leader with elastic-net penalties from about
``SAMPLE_PER_LANG`` documents of each language; a quarter of these is held back to fit
the temperature that calibrates the probabilities.

Since values are linear in the counts, a text's score is the mean over its n-grams of
weight times inverse document frequency, so whole texts of any length are scored in
bounded memory.

Defined results: the language of a null text, or of one without letters, is ``und``
with score 0; so is every language if nothing can be learned. Documents without a
language are not learned from. Equal texts get equal results; of equally likely
languages the alphabetically first wins. An empty table gives no rows; very long texts
are read whole. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tabaudit.llm import frames
from tabaudit.llm.text import CHARACTER_SLICE_BYTES, mixed, odd_multipliers, slices

LONGEST = 3
FEATURE_BITS = 16
# Languages with fewer sampled documents are learned from all of them.
MIN_TO_CALIBRATE = 8
SAMPLE_PER_LANG = 500
EPOCHS = 4
# Follow-the-regularised-leader: step size, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.01
# Feature values are shares of a text; they are scaled up to this total.
SCALE = 20.0
UNKNOWN = "und"

_PLACES = odd_multipliers(LONGEST + 1, seed=21)


def hashed_grams(texts: pa.Array, bits: int = FEATURE_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the features of all n-grams in order and where each text's start."""
    clean = pc.utf8_lower(pc.fill_null(texts, ""))
    clean = pc.utf8_trim(pc.replace_substring_regex(clean, r"\P{L}+", " "), " ")
    sizes = pc.utf8_length(clean).to_numpy(zero_copy_only=False).astype(np.int64)
    # One blank on either side; texts share the blank between them.
    padded = np.where(sizes > 0, sizes + 1, 0)
    joined = " " + "".join(t + " " for t in clean.to_pylist() if t)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.concatenate([[0], np.cumsum(padded)])
    for n in range(1, LONGEST + 1):
        width = max(0, len(points) - n + 1)
        keys = np.repeat(_PLACES[LONGEST:] * np.uint64(n), width)
        for k in range(n):
            keys += points[k : width + k] * _PLACES[k]
        features = (mixed(keys) >> np.uint64(64 - bits)).astype(np.int64)
        # Single characters of the text itself; longer n-grams reach over the blanks around it.
        counts = np.where(sizes > 0, sizes + (0 if n == 1 else 3 - n), 0)
        first = starts[:-1] + (1 if n == 1 else 0)
        ends = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(ends[-1]) + np.repeat(first - ends[:-1], counts)
        yield features[at], ends


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # features times inverse document frequency, by language
    bias: np.ndarray
    temperature: float

    def logits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Uncalibrated scores by text and language, and whether the text has letters."""
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts), np.int64)
        bits = int(math.log2(len(self.weights)))
        for features, starts in hashed_grams(texts, bits):
            some = np.flatnonzero(np.diff(starts))
            if len(some):
                for k in range(len(self.languages)):
                    values = self.weights[:, k][features]
                    total[some, k] += np.add.reduceat(values, starts[:-1][some])
            count += np.diff(starts)
        return SCALE * total / np.maximum(count, 1)[:, None] + self.bias, count > 0

    def predict(
        self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
    ) -> DataFrame:
        """``doc_id``, ``lang_pred`` and ``score`` of every row, from its text alone."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, size=CHARACTER_SLICE_BYTES):
                    names, scores = self._best(part.column("text"))
                    columns = [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")

    def _best(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        logits, known = self.logits(texts)
        shares = _softmax(logits / self.temperature)
        best = shares.argmax(axis=1)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, shares[np.arange(len(best)), best], 0.0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _document_frequencies(docs: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """In how many of all documents each feature occurs, and the number of documents with letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros((1 << bits) + 1, np.int64), 0
        for batch in batches:
            for part in slices(batch, size=CHARACTER_SLICE_BYTES):
                grams = list(hashed_grams(part.column("text"), bits))
                for i in range(part.num_rows):
                    seen = np.zeros(1 << bits, bool)
                    for features, starts in grams:
                        seen[features[starts[i] : starts[i + 1]]] = True
                    counts[:-1] += seen
                    n += bool(seen.any())
        counts[-1] = n
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["feature", "n"])

    rows = docs.select("text").mapInArrow(run, "feature long, n long")
    out = np.zeros((1 << bits) + 1, np.int64)
    for row in rows.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        out[row.feature] = row.n
    return out[:-1], int(out[-1])


def _sampled(docs: DataFrame, per_lang: int) -> DataFrame:
    """About ``per_lang`` documents of each language, chosen by a hash of id and text."""
    sizes = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    share = F.lit(float(per_lang)) / F.col("size")
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return docs.join(frames.broadcast_if_few(sizes), "lang").filter(place < share).select("lang", "text", "doc_id")


def _vectors(sample: DataFrame, bits: int) -> list[tuple[str, bool, np.ndarray, np.ndarray]]:
    """Language, whether for calibration, features and shares of the sampled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size=CHARACTER_SLICE_BYTES):
                grams = list(hashed_grams(part.column("text"), bits))
                features, shares = [], []
                for i in range(part.num_rows):
                    own = np.concatenate([f[s[i] : s[i + 1]] for f, s in grams])
                    found, n = np.unique(own, return_counts=True)
                    features.append(found.astype(np.int32))
                    shares.append((n / max(1, len(own))).astype(np.float32))
                columns = [
                    part.column("lang"), part.column("calibrates"), part.column("place"),
                    pa.array(features, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32())),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["lang", "calibrates", "place", "features", "shares"]
                )

    place = F.xxhash64("text", "doc_id")
    rows = sample.select("lang", "text", (F.pmod(place, F.lit(4)) == 0).alias("calibrates"), place.alias("place"))
    vectors = rows.mapInArrow(
        run, "lang string, calibrates boolean, place long, features array<int>, shares array<float>"
    )
    table = vectors.toArrow().sort_by([("place", "ascending"), ("lang", "ascending")])
    columns = [table.column(c).to_pylist() for c in ("lang", "calibrates")]
    for name, kind in (("features", np.int64), ("shares", np.float64)):
        columns.append([x.values.to_numpy().astype(kind) for x in table.column(name)])
    return [row for row in zip(*columns) if len(row[2])]


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], n_features: int, n_classes: int) -> np.ndarray:
    """Weights after ``EPOCHS`` rounds over ``(class, features, values)``, updated example by example."""
    z, n = np.zeros((n_features, n_classes)), np.zeros((n_features, n_classes))

    def weights(zi, ni):
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(ni)) / ALPHA + L2)

    for _ in range(EPOCHS):
        for label, features, values in rows:
            zi, ni = z[features], n[features]
            w = weights(zi, ni)
            error = _softmax(values @ w)
            error[label] -= 1.0
            g = values[:, None] * error
            z[features] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[features] = ni + g * g
    return weights(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the smallest log loss, by golden-section search.

    Labels count for ``(n + 1) / (n + 2)`` of a document, so that perfectly separated
    documents do not drive the temperature to 0.
    """
    if not len(labels) or logits.shape[1] < 2:
        return 1.0
    sure = (len(labels) + 1) / (len(labels) + 2)

    def loss(log_t: float) -> float:
        shares = _softmax(logits / math.exp(log_t))[np.arange(len(labels)), labels]
        other = (1 - shares) / (logits.shape[1] - 1)
        return -(sure * np.log(shares + 1e-300) + (1 - sure) * np.log(other + 1e-300)).mean()

    low, high, ratio = -3.0, 3.0, (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_lang: int = SAMPLE_PER_LANG,
    bits: int = FEATURE_BITS,
) -> LanguageModel:
    """Learn from ``docs``: document frequencies from all of them, weights from a bounded sample.

    The driver receives the frequencies and the sample's features, about ``per_lang``
    documents of each language.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(lang_col).alias("lang"),
    ).filter("lang is not null and text is not null")
    counts, n = _document_frequencies(rows, bits)
    idf = np.log((1.0 + n) / (1.0 + counts)) + 1.0
    vectors = _vectors(_sampled(rows, per_lang), bits)
    languages = sorted({v[0] for v in vectors})
    if not languages:
        return LanguageModel([], np.zeros((1 << bits, 0)), np.zeros(0), 1.0)
    code = {lang: k for k, lang in enumerate(languages)}
    sampled = Counter(v[0] for v in vectors)
    learned = Counter(v[0] for v in vectors if not v[1])
    # Every language keeps documents to learn from; small ones give none to calibration.
    calibrates = {x for x in languages if sampled[x] >= MIN_TO_CALIBRATE and learned[x]}
    # The last feature, present in every text, is the bias.
    examples = [
        (code[lang], held and lang in calibrates, np.append(f, 1 << bits), np.append(SCALE * s * idf[f], 1.0))
        for lang, held, f, s in vectors
    ]
    weights = ftrl([(c, f, x) for c, held, f, x in examples if not held], (1 << bits) + 1, len(languages))
    held = [(c, x @ weights[f]) for c, h, f, x in examples if h]
    t = temperature(np.array([h[1] for h in held]), np.array([h[0] for h in held], np.int64))
    return LanguageModel(languages, weights[:-1] * idf[:, None], weights[-1], t)


def held_out(doc_id: Column) -> Column:
    """Whether a document must not be learned from: CRC-32 of its id as text, modulo 4, is 2."""
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % 4 == 2
