"""Token ids as Arrow files of equal-length sequences with masks, open to random access.

``write`` encodes every text, ends it with ``end_id`` and lays the ids of all documents,
in ascending order of their ids, one after the other into shard files in Arrow's IPC
file format. A shard is a range of document ids. Its record batches hold two
fixed-size lists per row, ``ids`` (the smallest unsigned type that fits the vocabulary)
and ``mask`` (false on padding), all uncompressed and, but for the last, of the same
number of rows: sequence ``i`` lies in batch ``i // SEQUENCES_PER_BATCH`` and is read from
a memory map without copying. Only the last sequence of a shard is padded. A second
file per shard lists its documents with start and number of ids.

Rows are sorted by range, so no task holds more than a batch of texts. Files are written
under a passing name and moved into place, so a repeated task replaces its own file by an
equal one. The folder has to be on storage that all tasks reach through Arrow's file
systems (a mounted folder, HDFS, S3 and the like).

A byte-level tokenizer never joins characters across the border of a word and a space, mark
or line break. For those, texts are cut there and each distinct piece is encoded once,
which gives the same ids; texts are encoded whole for all others.

Defined results: a null or empty text has the end id alone. Null ids come first; rows
with one id are ordered by a hash of their text; repeated rows are all written. An
empty table gives no files and no rows. A very long text is encoded whole and spans as many sequences as it
needs. Extra columns are not read. ``docs`` should be a stored table: rows equal in id and text are told apart by position.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabaudit.llm import text as words_of
from tabaudit.session import materialize

SEQ_LEN = 2048
SEQUENCES_PER_BATCH = 512
# Pieces whose ids a worker remembers; beyond these it starts anew and forgets those before, one generation late.
REMEMBERED = 150_000
# Bytes of text that are encoded at a time.
SLICE_BYTES = 1 << 20
# About so many ids leave a reading task at a time.
READ_IDS = 1 << 20

MANIFEST_SCHEMA = "shard long, n_docs long, n_ids long"
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64())])


class Encoder:
    """Ids of whole texts by a tokenizer of the ``tokenizers`` library.

    Where texts may be cut at spaces, each distinct piece is encoded once: new pieces are
    joined again, many at a time, and as every id stands for a known number of bytes, the
    ids of each are told apart by those.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        from tokenizers import Tokenizer  # where the tasks run

        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        self.dtype = np.uint16 if self._tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._cuts = _splits_at_spaces(self._tokenizer)
        self._added = [t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._n_bytes = _bytes_of_ids(self._tokenizer) if self._cuts else None
        self._known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids start."""
        raw = pc.fill_null(texts, "").cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        is_cut = np.zeros(len(data) + 1, bool)
        is_cut[offsets] = True
        if self._cuts:
            raw_text = data.tobytes()
            _mark_cuts(data, is_cut, marks=not any(name in raw_text for name in self._added))
        cuts = np.flatnonzero(is_cut)
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]
        ).dictionary_encode()
        ids = self._ids_of(pieces.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype().itemsize
        flat, ends = np.frombuffer(b"".join(ids), self.dtype), np.cumsum(sizes)
        codes = pieces.indices.to_numpy()
        lengths = sizes[codes]
        before = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(before[-1])
        at += np.repeat((ends - sizes)[codes] - before[:-1], lengths)
        return flat[at], before[np.searchsorted(cuts, offsets)]

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        if not self._cuts:
            return self._each(pieces)
        if len(self._known) > REMEMBERED:
            self._older, self._known = self._known, {}
        known, older = self._known, self._older
        ids = list(map(known.get, pieces))
        missing = [i for i, found in enumerate(ids) if found is None]
        known.update((pieces[i], older[pieces[i]]) for i in missing if pieces[i] in older)
        new = [pieces[i] for i in missing if pieces[i] not in known]
        joined = [p for p in new if p[:1] == b" "]
        for at in range(0, len(joined), _JOINED):
            part = joined[at : at + _JOINED]
            known.update(zip(part, self._together(part)))
        first = [p for p in new if p[:1] != b" "]
        known.update(zip(first, self._each(first)))
        for i in missing:
            ids[i] = known[pieces[i]]
        return ids

    def _each(self, pieces: list[bytes]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(
            [p.decode("utf-8", "replace") for p in pieces], add_special_tokens=False
        )
        return [np.array(e.ids, self.dtype).tobytes() for e in encoded]

    def _together(self, pieces: list[bytes]) -> list[bytes]:
        text = b"".join(pieces)
        [encoded] = self._tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)
        ids = np.array(encoded.ids, self.dtype)
        upto = np.cumsum(self._n_bytes[ids])
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        last = np.searchsorted(upto, ends)
        if len(upto) != last[-1] + 1 or (upto[last] != ends).any():
            return self._each(pieces)  # bytes that are no text: replaced, they have another length
        width, raw = self.dtype().itemsize, ids.tobytes()
        stops = ((last + 1) * width).tolist()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]


# New pieces that are encoded together.
_JOINED = 20_000


@functools.lru_cache(maxsize=2)
def encoder_of(tokenizer_file: str) -> Encoder:
    """One encoder per worker process, so that its pieces are known to the next task too."""
    return Encoder(tokenizer_file)


def _splits_at_spaces(tokenizer) -> bool:
    """Whether no token can reach across a space that a word's first character follows."""
    before, added = tokenizer.pre_tokenizer, tokenizer.get_added_tokens_decoder().values()
    return (
        type(before).__name__ == "ByteLevel"
        and before.use_regex
        and not before.add_prefix_space
        and tokenizer.normalizer is None
        and not any(t.content.split() != [t.content] or t.lstrip or t.rstrip or t.single_word for t in added)
    )


def _bytes_of_ids(tokenizer) -> np.ndarray:
    """Bytes that each id of a byte-level vocabulary stands for: one per character of its name."""
    out = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for name, i in tokenizer.get_vocab(with_added_tokens=False).items():
        out[i] = len(name)
    for i, token in tokenizer.get_added_tokens_decoder().items():
        out[i] = len(token.content.encode())
    return out


def _bytes(*ranges: str) -> np.ndarray:
    """Which bytes lie in one of the ranges, each given by its two ends."""
    out = np.zeros(256, bool)
    for first, last in ranges:
        out[ord(first) : ord(last) + 1] = True
    return out


_WORD = _bytes("09", "AZ", "az")
_VISIBLE = _bytes("!~")
# Marks that end a run of letters or digits; an apostrophe may belong to the word.
_MARK = _VISIBLE & ~_WORD & ~_bytes("''")
# Surely no white space: neither that of ASCII nor the first byte of any other.
_NO_SPACE = ~_bytes("\0 ", "\xc2\xc2", "\xe1\xe3")


def _mark_cuts(data: np.ndarray, is_cut: np.ndarray, marks: bool) -> None:
    """Mark positions that no piece of a byte-level tokenizer's pattern reaches across.

    These are some of its borders, found byte by byte: the space before a word and, unless
    a special token is near, which may hold marks, a mark after a word, a line break after
    something visible, and what follows such a break.
    """
    before, here = data[:-1], data[1:]
    is_cut[:-2] |= (before == 0x20) & _NO_SPACE[here]
    if not marks:
        return
    ends_line = (here == 0x0A) & _VISIBLE[before]
    is_cut[1:-1] |= (_MARK[here] & _WORD[before]) | ends_line
    is_cut[2:-1] |= ends_line[:-1] & _NO_SPACE[data[2:]]


@dataclass(frozen=True)
class Folder:
    """Where the shards lie, and how they are laid out."""

    uri: str
    seq_len: int = SEQ_LEN

    def _at(self, name: str) -> tuple[arrow_fs.FileSystem, str]:
        path = f"{self.uri.rstrip('/')}/{name}"
        if path.startswith("file:"):
            path = "/" + path[5:].lstrip("/")
        return arrow_fs.FileSystem.from_uri(path)

    def open(self, name: str) -> pa.NativeFile:
        """A memory map where the storage allows one."""
        store, path = self._at(name)
        local = isinstance(store, arrow_fs.LocalFileSystem)
        return pa.memory_map(path) if local else store.open_input_file(path)

    def create(self) -> None:
        store, path = self._at("")
        store.create_dir(path.rstrip("/"), recursive=True)

    def passing(self, name: str) -> tuple[arrow_fs.FileSystem, str, str]:
        """Storage, a passing name of one attempt, and the final name."""
        store, path = self._at(name)
        head, _, tail = path.rpartition("/")
        return store, f"{head}/.{tail}.{uuid.uuid4().hex}", path


def _names(shard: int) -> tuple[str, str]:
    return f"{shard:08d}.arrow", f"{shard:08d}.docs.arrow"


class _ArrowFile:
    """An IPC file that takes its name when it is complete."""

    def __init__(self, folder: Folder, name: str, schema: pa.Schema):
        self._store, self._passing, self._final = folder.passing(name)
        self._sink = self._store.open_output_stream(self._passing)
        self._writer = pa.ipc.new_file(self._sink, schema)
        self.write = self._writer.write_batch

    def close(self, complete: bool) -> None:
        self._writer.close()
        self._sink.close()
        if complete:
            self._store.move(self._passing, self._final)
        else:
            self._store.delete_file(self._passing)


class ShardWriter:
    """Lays ids of documents into the two files of one shard, a batch at a time."""

    def __init__(self, folder: Folder, shard: int, dtype: type):
        self.n_docs = self.n_ids = 0
        self._width, self._held, self._size = folder.seq_len, [], 0
        ids = pa.list_(pa.from_numpy_dtype(dtype), self._width)
        mask = pa.list_(pa.bool_(), self._width)
        self._schema = pa.schema([("ids", ids), ("mask", mask)])
        sequences, documents = _names(shard)
        self._sequences = _ArrowFile(folder, sequences, self._schema)
        self._documents = _ArrowFile(folder, documents, _INDEX)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, starts: np.ndarray) -> None:
        columns = [doc_ids, pa.array(starts[:-1] + self.n_ids), pa.array(np.diff(starts))]
        self._documents.write(pa.RecordBatch.from_arrays(columns, schema=_INDEX))
        self.n_docs += len(doc_ids)
        self.n_ids += len(ids)
        self._held.append(ids)
        self._size += len(ids)
        full = self._width * SEQUENCES_PER_BATCH
        if self._size >= full:
            joined = np.concatenate(self._held)
            whole = len(joined) // full * full
            for at in range(0, whole, full):
                self._write(joined[at : at + full], full)
            self._held, self._size = [joined[whole:]], len(joined) - whole

    def _write(self, ids: np.ndarray, n_real: int) -> None:
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), type=field.type)
            for values, field in zip((ids, np.arange(len(ids)) < n_real), self._schema)
        ]
        self._sequences.write(pa.RecordBatch.from_arrays(columns, schema=self._schema))

    def close(self, complete: bool) -> None:
        if complete and self._size:
            rest = np.concatenate(self._held)
            self._write(np.pad(rest, (0, -len(rest) % self._width)), len(rest))
        for file in (self._sequences, self._documents):
            file.close(complete)


class Shard:
    """One shard's sequences and documents, read without copying where the storage is mapped."""

    def __init__(self, folder: Folder, shard: int):
        sequences, documents = _names(shard)
        self._reader = pa.ipc.open_file(folder.open(sequences))
        self._index = pa.ipc.open_file(folder.open(documents))
        self.width = folder.seq_len
        last = self._reader.num_record_batches - 1
        self._rows = self._reader.get_batch(0).num_rows
        self.n_sequences = last * self._rows + self._reader.get_batch(last).num_rows

    def __len__(self) -> int:
        return self.n_sequences

    def _flat(self, batch: int) -> np.ndarray:
        return self._reader.get_batch(batch).column("ids").values.to_numpy(zero_copy_only=True)

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of a sequence, as views of the file."""
        if not 0 <= i < self.n_sequences:
            raise IndexError(i)
        at = i % self._rows * self.width
        mask = self._reader.get_batch(i // self._rows).column("mask").values
        return self._flat(i // self._rows)[at : at + self.width], mask.slice(at, self.width)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from one position of the shard to another."""
        size = self._rows * self.width
        parts = [
            self._flat(b)[max(start - b * size, 0) : stop - b * size]
            for b in range(start // size, -(-stop // size))
        ]
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint16)])

    def documents(self) -> Iterator[pa.RecordBatch]:
        """``doc_id``, ``start`` and ``n_ids``, in order."""
        for b in range(self._index.num_record_batches):
            yield self._index.get_batch(b)


@dataclass(frozen=True)
class TokenFiles:
    """A written folder and its manifest: one row of shard, documents and ids per file."""

    folder: Folder
    manifest: DataFrame

    def documents(self) -> DataFrame:
        """``doc_id``, ``start`` (ids of all documents before it) and ``ids`` (little-endian,
        four bytes each), read back from the files."""
        # One row per file.
        earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        base = F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("base")
        placed = materialize(self.manifest.select("shard", base), "shards")
        folder = self.folder

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, before in zip(*(c.to_pylist() for c in batch.columns)):
                    yield from _read(Shard(folder, shard), before)

        spread = placed.repartition(max(1, placed.count()))
        return spread.mapInArrow(run, "doc_id long, start long, ids binary")


def _read(shard: Shard, base: int) -> Iterator[pa.RecordBatch]:
    for batch in shard.documents():
        starts = batch.column("start").to_numpy()
        ends = starts + batch.column("n_ids").to_numpy()
        at = 0
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + READ_IDS, "right")))
            ids = shard.ids(int(starts[at]), int(ends[stop - 1])).astype("<u4")
            bounds = np.append(starts[at:stop], ends[stop - 1]) - starts[at]
            values = pa.Array.from_buffers(
                pa.large_binary(), stop - at, [None, pa.py_buffer(bounds * 4), pa.py_buffer(ids)]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(at, stop - at), pa.array(starts[at:stop] + base), values.cast(pa.binary())],
                names=["doc_id", "start", "ids"],
            )
            at = stop


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that the cluster's default file system adds to it."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def write(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int = 0,
    seq_len: int = SEQ_LEN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> TokenFiles:
    """Encode ``docs`` into files below ``path``."""
    folder = Folder(qualified(docs.sparkSession, path), seq_len)
    folder.create()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = None, None
        try:
            for batch in batches:
                for part in words_of.slices(batch, size=SLICE_BYTES):
                    encoder = encoder or encoder_of(tokenizer_file)
                    shard = TaskContext.get().partitionId()
                    writer = writer or ShardWriter(folder, shard, encoder.dtype)
                    writer.add(part.column("doc_id"), *_ended(*encoder(part.column("text")), end_id))
        except BaseException:
            if writer:
                writer.close(complete=False)
            raise
        if writer:
            writer.close(complete=True)
            row = [[shard], [writer.n_docs], [writer.n_ids]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int64()) for v in row], names=["shard", "n_docs", "n_ids"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = ["doc_id", "_text", "_row"]
    rows = rows.withColumns(
        {"_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()}
    )
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return TokenFiles(folder, materialize(ranged.mapInArrow(run, MANIFEST_SCHEMA), "manifest"))


def _ended(ids: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    return np.insert(ids, starts[1:], end_id), starts + np.arange(len(starts))
