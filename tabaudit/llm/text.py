"""Words, shingles and MinHash values of whole texts, vectorised over Arrow batches.

A word is a longest run of characters other than space and the control characters
9 to 13. All functions take texts as an Arrow array in which null counts as empty,
and describe ragged results by ``starts``: the values of text ``i`` are those from
``starts[i]`` to ``starts[i + 1]``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Texts are worked on in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 21
# Work on single characters needs many bytes for each, so slices are smaller there.
CHARACTER_SLICE_BYTES = 1 << 19

SHINGLE_WORDS = 5

_U64 = np.uint64


def slices(
    batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch``, each holding about ``size`` bytes of text."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // size
    cuts = np.flatnonzero(np.diff(part)) + 1
    for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(start, stop - start)


def flat_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words in order, and where each text's words start."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values
    full = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)])
    return words.filter(full), before[offsets]


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word codes, starts, and the distinct words the codes refer to."""
    words, starts = flat_words(texts)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    return codes, starts, coded.dictionary.cast(pa.binary()).to_pylist()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=_U64) * _U64(0x9E3779B97F4A7C15) + _U64(seed)) | _U64(1)


_WORD_PLACES = odd_multipliers(SHINGLE_WORDS, seed=11)


def shingles(texts: pa.Array, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of ``width`` words, with repeats, and starts.

    A text with fewer words has one shingle, made of all its words; a text
    without words has none.
    """
    codes, starts, vocabulary = coded_words(texts)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), _U64, len(vocabulary))[codes]
    n_words = np.diff(starts)
    places = _WORD_PLACES if width == SHINGLE_WORDS else odd_multipliers(width, seed=11)
    if len(hashes) >= width:
        windows = hashes[: len(hashes) - width + 1] * places[0]
        for k in range(1, width):
            windows = windows + hashes[k : len(hashes) - width + 1 + k] * places[k]
    else:
        windows = np.zeros(0, _U64)
    counts = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    ends = np.concatenate([[0], np.cumsum(counts)])
    first = np.repeat(starts[:-1] - ends[:-1], counts) + np.arange(ends[-1])
    out = np.zeros(ends[-1], _U64)
    inside = np.repeat(n_words >= width, counts)
    out[inside] = windows[first[inside]]
    for i in np.flatnonzero((n_words > 0) & (n_words < width)):
        short = hashes[starts[i] : starts[i + 1]]
        out[ends[i]] = (short * places[: len(short)]).sum(dtype=_U64) + _U64(len(short))
    return mixed(out), ends


def shingle_sets(texts: pa.Array, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    values, starts = shingles(texts, width)
    return [np.unique(values[a:b]) for a, b in zip(starts[:-1], starts[1:])]


class MinHasher:
    """Signatures of ``n`` universal hash functions ``(a * x + b) mod 2**64`` with odd ``a``.

    Each function permutes the 64-bit integers; the smallest image of a set's
    members, cut to its upper 32 bits, is one value of the signature.
    """

    def __init__(self, n: int, seed: int = 1):
        self.n = n
        self.factors = odd_multipliers(n, seed=2 * seed + 1)
        self.shifts = odd_multipliers(n, seed=1000 + seed)

    def signatures(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row of ``n`` 32-bit values per set; an empty set has the largest value throughout."""
        out = np.full((len(starts) - 1, self.n), 0xFFFFFFFF, np.uint32)
        full = np.flatnonzero(np.diff(starts))
        if len(full):
            heads = starts[:-1][full]
            for k in range(self.n):
                images = values * self.factors[k]
                images += self.shifts[k]
                out[full, k] = np.minimum.reduceat(images, heads) >> _U64(32)
        return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each run of ``rows`` signature values, other keys in each band."""
    n, width = signatures.shape
    bands = width // rows
    grouped = signatures[:, : bands * rows].reshape(n, bands, rows).astype(_U64)
    keys = (grouped * odd_multipliers(rows, seed=5)).sum(axis=2, dtype=_U64)
    return mixed(keys + odd_multipliers(bands, seed=6)).view(np.int64)
