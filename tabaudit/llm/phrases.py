"""Phrase collocations by SON partitioning: frequent phrases of each shard, then exact counts.

Documents are dealt into ``SHARDS`` shards by hash; a shard and a language make a cell. A
phrase found ``min_count`` times in a language reaches, in one cell at least, the share of
that count that goes with the cell's share of the words, rounded down, plus one: lower
counts in all cells cannot add up. So every shard is mined completely at this lowered
support, level by level: words, then pairs of frequent words, then runs of three and four
whose pairs are all frequent. What cannot reach ``min_count`` even if it fell short of the
support by just one in all other cells goes at once. Both the counting and the joining of a shard are Spark's, so
a shard may be as large as it likes; the number of shards is fixed, since with more of them
than ``min_count`` the lowered support would be one.

The union of what is frequent somewhere is then counted over all documents, by the phrases
themselves. Frequent phrases of one step reach the next one as a bitmap of hashes, of at
most ``MAX_BITS`` bits. A bitmap may let too much through, never too little: where the
corpus outgrows it, more phrases are counted, and the results stay the same.

Words are what blanks separate within pieces, which end at punctuation and line breaks;
A-Z are lower-cased. All is done per language.

Defined results: a null or empty text has no words; a null language is ``und``; repeated rows count
as often as they occur; texts of any length count whole; a lone word is no phrase. An
empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabaudit.llm import frames
from tabaudit.llm import text as words_of
from tabaudit.session import materialize

MIN_COUNT = 30
MAX_WORDS = 4
SHARDS = 8
TOP = 2_000
# A phrase is part of a longer one found in so many hundredths of its occurrences.
INSIDE_PERCENT = 80
# Fixed value: the scale of scores.
SCALE = 2_000_000

# A bitmap has 16 bits per member, within these bounds (32 MiB at most).
MIN_BITS, MAX_BITS = 16, 28

# Bytes of text whose runs are counted at a time: by hash, and by their words.
GRAM_BYTES, PHRASE_BYTES = 1 << 20, 1 << 20

_U64 = np.uint64
_STEP = words_of.odd_multipliers(1, seed=13)[0]

# Bytes that end pieces, and blanks between words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_IS_END, _IS_BLANK = np.zeros(256, bool), np.zeros(256, bool)
_IS_END[list(ENDS)] = True
_IS_BLANK[list(BLANKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_COUNTS = "cell long, gram long, n long"
_PHRASES = "lang string, phrase string, n_words int, n long"


@functools.lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``size`` powers of an odd number, and of its inverse, among 64-bit integers."""
    step = int(_STEP)
    both = [np.full(size, x, _U64) for x in (step, pow(step, -1, 1 << 64))]
    for powers in both:
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
    return both[0], both[1]


def _hashes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words between ``bounds``: polynomials of their bytes, from running sums."""
    powers, inverse = _powers(1 << max(len(data), 1).bit_length())
    sums = np.zeros(len(data) + 1, _U64)
    np.cumsum((data + _U64(1)) * powers[: len(data)], out=sums[1:])
    own = (sums[bounds[1:]] - sums[bounds[:-1]]) * inverse[bounds[:-1]]
    return words_of.mixed(own + np.diff(bounds).astype(_U64))


class Words:
    """The words of a slice of documents: bytes, bounds, hashes, piece and document of each."""

    def __init__(self, part: pa.RecordBatch):
        raw = pc.fill_null(part.column("text"), "").cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        ends = _IS_END[data]
        inside = ~(ends | _IS_BLANK[data])
        goes_on = np.zeros(len(data), bool)
        goes_on[1:] = inside[:-1]
        goes_on[offsets[:-1][offsets[:-1] < len(data)]] = False
        starts = np.flatnonzero(inside & ~goes_on)
        # Bytes of words alone, and where each word begins among them.
        self.data = _LOWER[data[inside]]
        self.bounds = np.append(np.cumsum(inside, dtype=np.int64)[starts] - 1, len(self.data))
        self.doc = np.searchsorted(offsets, starts, "right") - 1
        # Both terms only grow, so a piece differs from all others.
        self.piece = np.cumsum(ends, dtype=np.int64)[starts] + self.doc
        lang = part.column("lang_hash").to_numpy().view(_U64)
        self.hashes = words_of.mixed(_hashes(self.data, self.bounds) + lang[self.doc])

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """A code per word, and the distinct words that the codes stand for."""
        buffers = [None, pa.py_buffer(self.bounds), pa.py_buffer(self.data)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(self.bounds) - 1, buffers).dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, hashes of the runs that begin at each word, and whether they lie in one piece."""
        out = self.hashes
        yield 1, out, np.ones(len(out), bool)
        for width in range(2, MAX_WORDS + 1):
            reach = max(len(self.hashes) - width + 1, 0)
            out = words_of.mixed(out[:reach] * _STEP + self.hashes[width - 1 :][:reach])
            yield width, out, self.piece[:reach] == self.piece[width - 1 :][:reach]


class Members:
    """A set of 64-bit hashes as a bitmap that tells members and a few others apart from the rest."""

    def __init__(self, bits: np.ndarray, log_size: int):
        self._bits, self._shift = bits, _U64(64 - log_size)

    def __contains__(self, key: int) -> bool:
        return bool(self.has(np.array([key], np.int64).view(_U64))[0])

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self._shift
        return ((self._bits[at >> _U64(6)] >> (at & _U64(63))) & _U64(1)).astype(bool)


def members(keys: DataFrame, key: Column) -> Members:
    """The bitmap of the hashes ``key`` in ``keys``, a written table."""
    log_size = min(max(MIN_BITS, (16 * keys.count()).bit_length()), MAX_BITS)
    at = F.shiftrightunsigned(key, 64 - log_size)
    bit = F.expr("shiftleft(1L, int(at & 63))")
    slots = keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("slot")).agg(F.bit_or(bit).alias("bits"))
    found = slots.toArrow()
    bits = np.zeros(1 << (log_size - 6), np.int64)
    bits[found.column("slot").to_numpy()] = found.column("bits").to_numpy()
    return Members(bits.view(_U64), log_size)


def _sub_runs(found: np.ndarray, reach: int, width: int) -> np.ndarray:
    """Whether ``width`` neighbours in a row are found, from each of the first ``reach`` places."""
    out = found[:reach].copy()
    for k in range(1, width):
        out &= found[k : k + reach]
    return out


def _mine(docs: DataFrame, widths: tuple[int, ...], known=None) -> DataFrame:
    """Counts per cell of all runs of ``widths`` words whose parts of one word less than the least
    width are in ``known`` (a broadcast; None: of all), as ``_COUNTS``."""
    least = widths[0] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words_of.slices(batch, size=GRAM_BYTES):
                words = Words(part)
                cell_of = part.column("cell").to_numpy()
                cells = cell_of[words.doc].view(_U64)
                found = None
                for width, grams, whole in words.grams():
                    if width == least:
                        found = whole & known.value.has(grams ^ cells[: len(grams)])
                    elif width in widths:
                        if found is not None:
                            whole = whole & _sub_runs(found, len(grams), width - least + 1)
                        yield from _counted(grams, cells[: len(grams)], np.flatnonzero(whole))

    counts = docs.mapInArrow(run, _COUNTS)
    return counts.groupBy("cell", "gram").agg(F.sum("n").alias("n"))


def _counted(grams: np.ndarray, cells: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
    for cell in np.unique(cells[at]):
        distinct, n = np.unique(grams[at[cells[at] == cell]], return_counts=True)
        columns = [np.full(len(n), cell).view(np.int64), distinct.view(np.int64), n]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "gram", "n"])


def _count_phrases(docs: DataFrame, candidates) -> DataFrame:
    """Exact counts of all words and phrases whose hashes, and those of their parts, are candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words_of.slices(batch, size=PHRASE_BYTES):
                yield from _phrases(Words(part), part.column("lang"), candidates.value)

    return docs.mapInArrow(run, _PHRASES).groupBy("lang", "phrase").agg(
        F.max("n_words").alias("n_words"), F.sum("n").alias("n")
    )


def _phrases(words: Words, langs: pa.Array, candidates: Members) -> Iterator[pa.RecordBatch]:
    coded = langs.dictionary_encode()
    lang = coded.indices.to_numpy().astype(np.int64)[words.doc]
    codes, vocabulary = words.coded()
    # Runs of one word less, by number: equal numbers are equal words of equal languages.
    number, found = lang, None
    for width, grams, whole in words.grams():
        whole = whole & candidates.has(grams)
        if found is not None:
            whole &= _sub_runs(found, len(grams), 2)
        at, found = np.flatnonzero(whole), whole
        keys = number[at] * len(vocabulary) + codes[at + width - 1]
        _, first, inverse, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        number = np.zeros(len(grams), np.int64)
        number[at] = inverse
        first = at[first]
        texts = [vocabulary.take(pa.array(codes[first + k])) for k in range(width)]
        phrase = texts[0] if width == 1 else pc.binary_join_element_wise(*texts, pa.scalar(b" ", pa.large_binary()))
        yield pa.RecordBatch.from_arrays(
            [
                coded.dictionary.take(pa.array(lang[first])).cast(pa.string()),
                phrase.cast(pa.string()),
                pa.array(np.full(len(n), width, np.int32)),
                pa.array(n),
            ],
            names=["lang", "phrase", "n_words", "n"],
        )


def _frequent(counts: DataFrame, supports: DataFrame) -> DataFrame:
    """What reaches its cell's support, where all cells together can still make up the count.

    In a cell where a phrase falls short it has one occurrence less than the support at
    most, so what it has beyond that in the others must fill the rest.
    """
    found = counts.join(supports, "cell").filter("n >= support")
    beyond = F.sum(F.col("n") - F.col("support") + 1).over(Window.partitionBy("gram"))
    return found.withColumn("beyond", beyond).filter("beyond >= missing").select("cell", "gram")


def frequent_phrases(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    shards: int = SHARDS,
) -> tuple[DataFrame, DataFrame]:
    """All words and phrases found ``min_count`` times (``lang``, ``phrase``, ``n_words``, ``n``), and
    the words of every language (``lang``, ``n``)."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    rows = docs.select(
        F.col(text_col).alias("text"),
        lang.alias("lang"),
        F.xxhash64(lang).alias("lang_hash"),
        F.xxhash64(lang, F.pmod(F.xxhash64(id_col), F.lit(shards))).alias("cell"),
    )
    words = materialize(_mine(rows, (1,)), "shard-words")
    names = rows.groupBy("cell").agg(F.max("lang").alias("lang"))
    sizes = words.groupBy("cell").agg(F.sum("n").alias("words")).join(names, "cell")
    sizes = materialize(sizes, "cells")
    totals = sizes.groupBy("lang").agg(F.sum("words").alias("n"))
    share = F.expr(f"(cast({min_count - 1} as decimal(10, 0)) * words) div n")
    shares = sizes.join(totals, "lang").select("cell", "lang", share.alias("share"))
    most = shares.groupBy("lang").agg((min_count - F.sum("share")).alias("missing"))
    supports = shares.join(most, "lang").select("cell", (F.col("share") + 1).alias("support"), "missing")
    supports = frames.broadcast_if_few(materialize(supports, "supports"))

    in_cell = F.col("gram").bitwiseXOR(F.col("cell"))
    frequent = [materialize(_frequent(words, supports), "frequent-words")]
    for widths in ((2,), (3, 4)):
        known = spark.sparkContext.broadcast(members(frequent[-1], in_cell))
        counts = _mine(rows, widths, known)
        frequent.append(materialize(_frequent(counts, supports), f"frequent-{widths[0]}"))
    union = frequent[0]
    for more in frequent[1:]:
        union = union.unionByName(more)
    union = materialize(union.select("gram").distinct(), "candidates")
    candidates = spark.sparkContext.broadcast(members(union, F.col("gram")))
    counted = _count_phrases(rows, candidates).filter(F.col("n") >= min_count)
    return materialize(counted, "phrases"), totals


def _exact(count: str) -> Column:
    """A count as a number whose products stay exact."""
    return F.col(count).cast("decimal(19, 0)")


def scored(phrases: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``score`` at the cut that gives each phrase its lowest score."""
    words = F.split("phrase", " ")
    parts = phrases.filter("n_words > 1").select(
        "lang", "phrase", F.col("n").alias("a"), words.alias("words"),
        F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"),
    )
    first = F.array_join(F.slice("words", 1, F.col("k")), " ")
    rest = F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ")
    parts = parts.select("lang", "phrase", "a", "k", first.alias("first"), rest.alias("rest"))
    for part, count in (("first", "l"), ("rest", "r")):
        counts = phrases.select("lang", F.col("phrase").alias(part), F.col("n").alias(count))
        parts = parts.join(counts, ["lang", part])
    parts = parts.withColumns({"x": _exact("a") * F.lit(SCALE).cast("decimal(7, 0)"), "y": _exact("l") + _exact("r")})
    cut = F.min(F.struct(F.expr("x div y").alias("score"), "k", "l", "r")).alias("cut")
    best = parts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), cut)
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def inside_longer(phrases: DataFrame, percent: int = INSIDE_PERCENT) -> DataFrame:
    """``lang`` and ``phrase`` of those that lie in a longer one with ``percent`` of their count."""
    starts = F.transform(
        F.sequence(F.lit(2), F.col("n_words") - 1),
        lambda size: F.transform(
            F.sequence(F.lit(1), F.col("n_words") - size + 1),
            lambda start: F.array_join(F.slice(F.split("phrase", " "), start, size), " "),
        ),
    )
    parts = phrases.filter("n_words > 2").select("lang", "n", F.explode(F.flatten(starts)).alias("phrase"))
    longest = parts.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    held = longest.join(phrases.select("lang", "phrase", "n"), ["lang", "phrase"])
    return held.filter(_exact("longer") * 100 >= _exact("n") * percent).select("lang", "phrase")


def _first(rows: DataFrame, order: list[Column], top: int) -> DataFrame:
    """The first ``top`` rows of each language with their rank: first of each part of it, then of all."""
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    for window in (Window.partitionBy("lang", part), Window.partitionBy("lang")):
        rows = rows.withColumn("rank", F.row_number().over(window.orderBy(*order)).cast("long"))
        rows = rows.filter(F.col("rank") <= top)
    return rows


def collocations(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of the best phrases of each
    language that are not part of longer ones; ``options`` are those of ``frequent_phrases``."""
    phrases, totals = frequent_phrases(docs, **options)
    best = scored(phrases).join(inside_longer(phrases), ["lang", "phrase"], "left_anti")
    ranked = _first(best, [F.desc("score"), F.desc("a"), F.col("phrase")], top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
