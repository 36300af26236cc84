"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's n-grams are runs of ``ORDER`` characters of trusted documents, the
characters of a text being preceded by start marks. Orders below the highest count in
how many different contexts an n-gram occurs; three discounts per order, estimated from
the counts of counts, are interpolated down to a uniform distribution over the
characters seen and one unseen character.

All counts are tables, sharded by n-gram. Documents are gathered into blocks of about
``BLOCK_BYTES``; each block asks for its distinct n-grams once, the questions are joined
with the counts by shuffle, and the answers meet the block again. What moves is
proportional to the corpus, and no task holds more than a block and its answers, or its
share of the model.

A document is kept if its perplexity is not above that of its language's threshold: a
high quantile of the log-perplexities of trusted documents that were held out of the
model, to the upper edge of its bin of ``LOSS_BIN``. Languages without such documents use the quantile of all.

Defined results: a null or empty text has no perplexity and is not kept; without trusted
documents, or without any held out, every text that has a perplexity is kept. A null
language is a language of its own. Repeated rows are judged alike, each for itself. An
empty table gives no rows; very long texts are counted and judged whole, in parcels.
Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tabaudit.llm import frames
from tabaudit.llm.text import CHARACTER_SLICE_BYTES, slices
from tabaudit.session import materialize

ORDER = 4
START = "\x02"
BLOCK_BYTES = 1 << 23
HELD_OUT_BELOW = "4"
QUANTILE = 0.98
LOSS_BIN = 0.001

def _grams(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """The n-gram that ends at each character: codes, the n-grams they stand for, and starts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    if not starts[-1]:
        return np.zeros(0, np.int64), [], starts
    pad = START * (ORDER - 1)
    joined = "".join(pad + t for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    present = np.zeros(0x110000, bool)
    present[points] = True
    alphabet = np.flatnonzero(present)
    code_of = np.zeros(0x110000, np.int64)
    code_of[alphabet] = np.arange(len(alphabet))
    codes = code_of[points]
    width = len(codes) - ORDER + 1
    keys = codes[:width]
    for k in range(1, ORDER):
        keys = keys * len(alphabet) + codes[k : width + k]
        if len(alphabet) ** ORDER > 1 << 62:  # very many characters: keep the numbers small
            keys = pd.factorize(keys)[0]
    # Each text has its own marks before it, so those n-grams that end in a mark are skipped.
    at = np.arange(starts[-1]) + (ORDER - 1) * np.repeat(np.arange(len(texts)), sizes)
    found, distinct = pd.factorize(keys[at])
    first = np.zeros(len(distinct), np.int64)
    first[found[::-1]] = at[::-1]
    letters = points[first[:, None] + np.arange(ORDER)]
    flat = letters.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return found, [flat[i : i + ORDER] for i in range(0, len(flat), ORDER)], starts


def _texts(part: pa.RecordBatch) -> list[str]:
    return [t or "" for t in part.column("text").to_pylist()]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the n-grams of about ``BLOCK_BYTES`` of text at a time."""
    counts, size = Counter(), 0
    for batch in batches:
        for part in slices(batch, size=CHARACTER_SLICE_BYTES):
            found, grams, _ = _grams(_texts(part))
            counts.update(dict(zip(grams, np.bincount(found, minlength=len(grams)).tolist())))
            size += part.nbytes
            if size >= BLOCK_BYTES:
                yield _counted(counts)
                counts, size = Counter(), 0
    yield _counted(counts)


def _counted(counts: Counter) -> pa.RecordBatch:
    columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["gram", "n"])


def _written(table: pa.Table, compression: str | None = None) -> pa.Buffer:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=compression)
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Consecutive rows of about ``BLOCK_BYTES``, named by a hash of their content."""

    def named(parts):
        table = pa.Table.from_batches(parts)
        return xxhash.xxh3_64_intdigest(_written(table)) - (1 << 63), table

    held, size = [], 0
    for batch in batches:
        for part in slices(batch):
            held.append(part)
            size += part.column("text").nbytes
            if size >= BLOCK_BYTES:
                yield named(held)
                held, size = [], 0
    if held:
        yield named(held)


def _questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of each block."""
    for name, table in _blocks(batches):
        asked: set[str] = set()
        for part in _pieces(table):
            asked.update(_grams(_texts(part))[1])
        if asked:
            columns = [pa.array([name] * len(asked), pa.int64()), pa.array(list(asked), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "gram"])


def _pieces(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in table.to_batches():
        yield from slices(batch, size=CHARACTER_SLICE_BYTES)


def _parcels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block as one compressed value."""
    for name, table in _blocks(batches):
        rows = _written(table, "zstd").to_pybytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([rows], pa.binary())],
            names=["block", "rows"],
        )


_LOSS_SCHEMA = "doc_id long, lang string, n_chars long, loss double"
_LOSSES = pa.schema(
    [("doc_id", pa.int64()), ("lang", pa.string()), ("n_chars", pa.int64()), ("loss", pa.float64())]
)


def _losses(parcels: pa.Table, answers: pa.Table) -> pa.Table:
    """Negative log probabilities of a block's documents, from those of its n-grams."""
    loss_of = dict(zip(answers.column("gram").to_pylist(), answers.column("loss").to_pylist()))
    out = []
    for parcel in parcels.column("rows").to_pylist():
        for part in _pieces(pa.ipc.open_stream(parcel).read_all()):
            found, grams, starts = _grams(_texts(part))
            # A missing answer is an error: the block's rows have changed between two passes.
            values = np.array([loss_of[g] for g in grams], float)
            if np.isnan(values).any():
                raise ValueError("an n-gram has no probability: the model's counts are not complete")
            sums = np.concatenate([[0.0], np.cumsum(values[found])]) if len(found) else np.zeros(1)
            columns = [part.column("doc_id"), part.column("lang"), np.diff(starts)]
            loss = sums[starts[1:]] - sums[starts[:-1]]
            out.append(pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(loss)], schema=_LOSSES))
    return pa.Table.from_batches(out, _LOSSES)


def _tail(gram: Column, length: int) -> Column:
    return F.substring(gram, ORDER - length + 1, length)


# Discounts where the counts of counts allow no estimate between none and the whole count.
DEFAULT_DISCOUNTS = (0.5, 1.0, 1.5)


def _discounts(grams: DataFrame) -> list[float]:
    """The modified Kneser-Ney discounts of n-grams that occur once, twice, and more often.

    Every discount is positive, so each context leaves something to what it was not seen
    with, and smaller than the count, so nothing seen becomes less likely than unseen.
    """
    row = grams.agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in range(1, 5)]).first()
    n1, n2, n3, n4 = (row[f"n{k}"] for k in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [
        1 - 2 * y * n2 / n1 if n1 else 0.0,
        2 - 3 * y * n3 / n2 if n2 else 0.0,
        3 - 4 * y * n4 / n3 if n3 else 0.0,
    ]
    return [
        d if 0 < d < k else default
        for k, (d, default) in enumerate(zip(raw, DEFAULT_DISCOUNTS), 1)
    ]


class KneserNey:
    """Tables of n-gram counts and of context sums for every order."""

    def __init__(self, counts: DataFrame):
        """``counts`` has ``gram`` (of ``ORDER`` characters) and ``n``."""
        self.grams: dict[int, DataFrame] = {}
        self.contexts: dict[int, DataFrame] = {}
        self.discounts: dict[int, list[float]] = {}
        grams = materialize(counts, f"grams-{ORDER}")
        for order in range(ORDER, 0, -1):
            if order < ORDER:
                # Each n-gram counts once for every character found before it.
                shorter = self.grams[order + 1].groupBy(F.expr("substring(gram, 2)").alias("gram"))
                grams = materialize(shorter.agg(F.count(F.lit(1)).alias("n")), f"grams-{order}")
            self.grams[order] = grams
            d1, d2, d3 = self.discounts[order] = _discounts(grams)
            context = grams.groupBy(F.expr(f"substring(gram, 1, {order - 1})").alias("context"))
            self.contexts[order] = materialize(
                context.agg(
                    F.sum("n").alias("total"),
                    (
                        d1 * F.count_if(F.col("n") == 1)
                        + d2 * F.count_if(F.col("n") == 2)
                        + d3 * F.count_if(F.col("n") > 2)
                    ).alias("left"),
                ),
                f"contexts-{order}",
            )
        self.n_letters = self.grams[1].count()

    def losses(self, questions: DataFrame) -> DataFrame:
        """``gram`` and ``loss``, the negative log probability of its last character after the others."""
        unseen = F.lit(1.0 / (self.n_letters + 1))
        known = questions.select("gram").distinct().withColumn("p", unseen)
        for order in range(1, ORDER + 1):
            d1, d2, d3 = self.discounts[order]
            grams = self.grams[order].select(F.col("gram").alias(f"g{order}"), F.col("n").alias(f"n{order}"))
            sums = self.contexts[order].select(
                F.col("context").alias(f"c{order}"),
                F.col("total").alias(f"t{order}"),
                F.col("left").alias(f"l{order}"),
            )
            known = known.join(grams, _tail(F.col("gram"), order) == F.col(f"g{order}"), "left")
            context = F.substring(F.col("gram"), ORDER - order + 1, order - 1)
            known = known.join(sums, context == F.col(f"c{order}"), "left")
            n, total = F.coalesce(f"n{order}", F.lit(0)), F.col(f"t{order}")
            discount = F.when(n == 0, 0.0).when(n == 1, d1).when(n == 2, d2).otherwise(d3)
            seen = (n - discount + F.col(f"l{order}") * F.col("p")) / total
            known = known.select("gram", F.when(total.isNull(), F.col("p")).otherwise(seen).alias("p"))
        return known.select("gram", (-F.log("p")).alias("loss"))


def perplexities(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """``_LOSS_SCHEMA`` of every row of ``docs`` (``doc_id``, ``text``, ``lang``)."""
    ids = trusted_ids.toDF("id").select(F.col("id").cast("long"))
    learned = ids.filter(~frames.held_out(F.col("id"), HELD_OUT_BELOW))
    text = frames.marked(docs.select("doc_id", "text"), learned).filter("trusted").select("text")
    counted = text.mapInArrow(_count_grams, "gram string, n long")
    model = KneserNey(counted.groupBy("gram").agg(F.sum("n").alias("n")))
    questions = docs.mapInArrow(_questions, "block long, gram string")
    questions = materialize(questions, "questions")
    answers = questions.join(model.losses(questions), "gram").select("block", "gram", "loss")
    parcels = docs.mapInArrow(_parcels, "block long, rows binary")
    return parcels.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_losses, _LOSS_SCHEMA)


def judge(
    docs: DataFrame,
    trusted_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``doc_id``, ``lang``, ``n_chars``, ``perplexity`` per character, ``threshold`` and ``kept``."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    losses = materialize(perplexities(rows, trusted_ids), "losses")
    mean = F.when(F.col("n_chars") > 0, F.col("loss") / F.col("n_chars"))
    ids = trusted_ids.toDF("id").select(F.col("id").cast("long"))
    held = ids.filter(frames.held_out(F.col("id"), HELD_OUT_BELOW))
    probe = materialize(frames.marked(losses.filter("n_chars > 0"), held).filter("trusted"), "held-out")
    # The upper edge of the bin with the quantile.
    edge = (F.col("bin") + 1) * F.lit(LOSS_BIN)
    each = frames.lower_quantile(probe, mean, QUANTILE, LOSS_BIN, ["lang"]).select(
        F.col("lang").alias("of_lang"), edge.alias("limit")
    )
    overall = frames.lower_quantile(probe, mean, QUANTILE, LOSS_BIN).select(edge.alias("limit")).first()
    other = F.lit(overall["limit"] if overall and overall["limit"] is not None else math.inf)
    joined = losses.join(
        frames.broadcast_if_few(each), F.col("lang").eqNullSafe(F.col("of_lang")), "left"
    )
    limit = F.coalesce("limit", other)
    return joined.select(
        "doc_id",
        "lang",
        "n_chars",
        F.exp(mean).alias("perplexity"),
        F.exp(limit).alias("threshold"),
        F.coalesce(mean <= limit, F.lit(False)).alias("kept"),
    )
