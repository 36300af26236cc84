"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles. Documents with equal sets are one text;
what follows works on one document of each text.

1. Texts that agree in a band of their MinHash signatures are candidates. The
   connected components of these agreements are the groups inside which pairs are
   looked for, so each pair is compared once, in however many bands it agrees.
2. Inside a group, signatures are compared a few values at a time. After ``n`` values,
   ``m`` of them equal, the similarity has the posterior Beta(m + 1, n - m + 1); pairs
   whose probability of reaching the threshold is below the tolerance are dropped.
3. The pairs that are left are verified exactly on their shingles.

Groups beyond ``BLOCK`` texts are cut into blocks, and pairs of blocks are compared by
tasks of their own. Tasks on bands first see signatures only, and the shingles of texts
that have a likely partner there. Tasks do not give out pairs but, for each text, its number of links
and a link towards the smallest text it is connected with, from which classes follow.

Defined results: a text with fewer than five words has one shingle, made of all its
words; texts without words have no links and are classes of their own. Null counts as
empty. Repeated rows are copies of one text. A null id sorts before all others. An empty
table gives no rows. Very long texts are sketched and compared by all their shingles.
Extra columns are not read by ``join`` and pass through ``keep_one``. Texts are told
apart by 64-bit hashes of their sets: among a billion texts, the chance that any two
share one is about 3 %.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabaudit.llm import frames, text as words_of
from tabaudit.llm.components import components
from tabaudit.session import materialize

THRESHOLD = 0.8
# 32 bands of 5 values: a pair with similarity 0.8 agrees in none of them with probability 3e-6.
N_HASHES = 160
BAND_ROWS = 5
# Pairs that reach the threshold with less than this probability are dropped.
TOLERANCE = 1e-6
# Signature values compared between two looks at the posterior.
STEP = 16
# Texts in a block of a large group, and about as many in a task of small groups.
BLOCK = 256
PACK = 2048
# Pairs compared at once.
PAIRS = 1 << 19

_LOWEST = -(1 << 63)


@dataclass(frozen=True)
class Settings:
    threshold: float = THRESHOLD
    n_hashes: int = N_HASHES
    band_rows: int = BAND_ROWS
    tolerance: float = TOLERANCE


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """The fewest equal values among ``n`` with which a pair is not dropped.

    With a uniform prior, the posterior probability that the similarity reaches
    the threshold is that of at most ``m`` successes in ``n + 1`` trials of
    probability ``threshold``.
    """
    chance, total = (1 - threshold) ** (n + 1), 0.0
    for m in range(n + 1):
        total += chance
        if total >= tolerance:
            return m
        chance *= (n + 1 - m) / (m + 1) * threshold / (1 - threshold)
    return n + 1


def _set_key(values: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(values.tobytes())).view(np.int64))


def _keyed(docs: DataFrame, id_col: str, text_col: str, carried: list[Column] = ()) -> DataFrame:
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST))
    rest = [F.struct(*carried).alias("carried")] if carried else []
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"), F.col(text_col).alias("text"), *rest)


def _sketch(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """Id, key, set, band keys and what is carried of each row; the set of a text without words is null."""
    hasher = words_of.MinHasher(settings.n_hashes)
    for batch in batches:
        for part in words_of.slices(batch):
            values, starts = words_of.shingles(part.column("text"))
            bands = words_of.band_keys(hasher.signatures(values, starts), settings.band_rows)
            sets = [
                _set_key(np.unique(values[a:b])) if b > a else None
                for a, b in zip(starts[:-1], starts[1:])
            ]
            rest = [c for c in part.schema.names if c == "carried"]
            flat = pa.array(bands.ravel())
            offsets = pa.array(np.arange(len(bands) + 1, dtype=np.int32) * bands.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("key"), pa.array(sets, pa.int64()),
                    pa.ListArray.from_arrays(offsets, flat), *[part.column(c) for c in rest],
                ],
                names=["doc_id", "key", "set", "bands", *rest],
            )


def _shingled(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """Set, signature and sorted shingles of each row with words."""
    hasher = words_of.MinHasher(settings.n_hashes)
    for batch in batches:
        for part in words_of.slices(batch):
            values, starts = words_of.shingles(part.column("text"))
            signatures = hasher.signatures(values, starts)
            rows = [
                (_set_key(own), signatures[i].tobytes(), own.tobytes())
                for i, (a, b) in enumerate(zip(starts[:-1], starts[1:]))
                if b > a
                for own in [np.unique(values[a:b])]
            ]
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = [pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["set", "signature", "shingles"]
            )


def _pairs(
    groups: np.ndarray, blocks: np.ndarray, low: int, high: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs inside groups, or between two blocks of a group, in portions."""
    if low < high:  # one of the two may be empty
        left, right = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
        for portion in np.array_split(left, max(1, len(left) * len(right) // PAIRS)):
            yield np.repeat(portion, len(right)), np.tile(right, len(portion))
        return
    order = np.argsort(groups, kind="stable")
    ends = np.searchsorted(groups[order], groups[order], side="right")
    later = ends - np.arange(len(order)) - 1
    cuts = np.flatnonzero(np.diff(np.cumsum(later) // PAIRS)) + 1
    for part in np.split(np.arange(len(order)), cuts):
        n = later[part]
        first = np.repeat(part, n)
        second = first + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield order[first], order[second]


def _pruned(
    left: np.ndarray, right: np.ndarray, signatures: np.ndarray, settings: Settings
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no look at the posterior drops."""
    equal = np.zeros(len(left), np.int64)
    for start in range(0, signatures.shape[1] if settings.tolerance else 0, STEP):
        stop = min(start + STEP, signatures.shape[1])
        equal += (signatures[left, start:stop] == signatures[right, start:stop]).sum(axis=1)
        likely = equal >= least_matches(stop, settings.threshold, settings.tolerance)
        left, right, equal = left[likely], right[likely], equal[likely]
    return left, right


def _verified(
    left: np.ndarray, right: np.ndarray, codes: list[np.ndarray], n_codes: int, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose exact Jaccard similarity reaches the threshold."""
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    sizes = np.array([len(c) for c in codes])
    member = np.zeros(n_codes, bool)
    common = np.zeros(len(left), np.int64)
    heads = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]])) if len(left) else []
    for start, stop in zip(heads, [*heads[1:], len(left)]):
        own, others = codes[left[start]], [codes[j] for j in right[start:stop]]
        member[own] = True
        ends = np.cumsum([len(o) for o in others])
        common[start:stop] = np.add.reduceat(member[np.concatenate(others)], [0, *ends[:-1]], dtype=np.int64)
        member[own] = False
    union = sizes[left] + sizes[right] - common
    near = common >= threshold * union - 1e-9
    return left[near], right[near]


def _first_here(
    left: np.ndarray, right: np.ndarray, signatures: np.ndarray, places: np.ndarray, rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that agree in no band before their task's own; outside of bands, place is 0."""
    for band in range(places.max(initial=0)):
        values = signatures[:, band * rows : (band + 1) * rows]
        met = (places[left] > band) & (values[left] == values[right]).all(axis=1)
        left, right = left[~met], right[~met]
    return left, right


def _likely_pairs(table: pa.Table, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of a task that have to be verified."""
    groups, blocks, places = (table.column(c).to_numpy() for c in ("group", "block", "place"))
    signatures = np.frombuffer(
        b"".join(table.column("signature").to_pylist()), np.uint32
    ).reshape(len(table), settings.n_hashes)
    low, high = (table.column(c)[0].as_py() for c in ("low", "high"))
    for left, right in _pairs(groups, blocks, low, high):
        left, right = _pruned(left, right, signatures, settings)
        yield _first_here(left, right, signatures, places, settings.band_rows)


def _likely(table: pa.Table, settings: Settings) -> pa.Table:
    """The rows of a task that have a likely partner in it, without their signatures."""
    found = np.zeros(len(table), bool)
    for pair in _likely_pairs(table, settings):
        for side in pair:
            found[side] = True
    return table.filter(pa.array(found)).drop_columns(["signature"])


def _links(table: pa.Table, settings: Settings) -> pa.Table:
    """For each text of the task with a link: its number of linked documents, and a root."""
    sets, copies = (table.column(c).to_numpy() for c in ("set", "copies"))
    shingles = [np.frombuffer(b, np.uint64) for b in table.column("shingles").to_pylist()]
    distinct, flat = np.unique(np.concatenate(shingles), return_inverse=True)
    codes = np.split(flat, np.cumsum([len(s) for s in shingles])[:-1])
    links, texts = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
    root = np.arange(len(sets))
    for left, right in _likely_pairs(table, settings):
        left, right = _verified(left, right, codes, len(distinct), settings.threshold)
        for a, b in ((left, right), (right, left)):
            np.add.at(links, a, copies[b])
            np.add.at(texts, a, 1)
        while len(left):  # hang larger roots under smaller ones until linked texts share one
            low, high = np.minimum(root[left], root[right]), np.maximum(root[left], root[right])
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
            open_ = root[left] != root[right]
            left, right = left[open_], right[open_]
    linked = np.flatnonzero(texts)
    return pa.table(
        {"set": sets[linked], "root": sets[root[linked]], "links": links[linked], "texts": texts[linked]}
    )


def _candidates(sets: DataFrame) -> DataFrame:
    """``set`` and ``component`` of the texts that agree with another one in a band."""
    bands = sets.select("set", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("set").alias("least"))
    shared = shared.filter("n > 1").select("band", "least")
    edges = bands.join(shared, "band").filter("`set` <> least").select("set", "least")
    return components(edges).withColumnRenamed("node", "set")


def _rows_of_blocks(size: str) -> Column:
    """The rows that a group of so many texts puts before its tasks."""
    return F.col(size) * F.ceil(F.col(size) / BLOCK)


def _sized(candidates: DataFrame) -> DataFrame:
    sizes = candidates.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return candidates.join(sizes, "component")


def _shared_bands(members: DataFrame, sets: DataFrame) -> DataFrame:
    """One row per member of these components and band it shares, where bands take fewer rows than blocks."""
    bands = members.join(sets.select("set", "bands"), "set").select(
        "component", F.col("size").alias("whole"), "set", "key", "copies",
        F.posexplode("bands").alias("place", "group"),
    )
    # Texts that agree in a band are in one component.
    shared = bands.groupBy("group").agg(
        F.count(F.lit(1)).alias("size"), F.min("component").alias("component"), F.min("whole").alias("whole")
    )
    shared = materialize(shared.filter("size > 1"), "shared-bands")
    costs = shared.groupBy("component").agg(
        F.sum(_rows_of_blocks("size")).alias("rows"), F.min("whole").alias("whole")
    )
    by_band = costs.filter(F.col("rows") < _rows_of_blocks("whole")).select("component")
    chosen = shared.join(by_band, "component", "left_semi").select("group", "size")
    return bands.join(chosen, "group")


def _tasks(members: DataFrame) -> DataFrame:
    """Deal members of groups out to tasks: packs of small groups, pairs of blocks of large ones."""
    n = members.count()
    blocks = members.select("set", "copies", "group", "place", F.ceil(F.col("size") / BLOCK).alias("n_blocks"))
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("set"), F.col("n_blocks")))
    small = blocks.filter("n_blocks = 1").select(
        "*",
        F.lit("pack").alias("kind"),
        F.pmod(F.xxhash64("group"), F.lit(n // PACK + 1)).alias("unit"),
        F.lit(0).cast("long").alias("low"),
        F.lit(0).cast("long").alias("high"),
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("other")
    large = blocks.filter("n_blocks > 1").select("*", other).select(
        *blocks.columns,
        F.lit("blocks").alias("kind"),
        F.col("group").alias("unit"),
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    )
    return small.unionByName(large)


def _shingles_of(docs: DataFrame, members: DataFrame, settings: Settings) -> DataFrame:
    """Signature and shingles of the members' sets.

    A key can stand for several texts; those that are no members drop out by their set.
    """
    keys = frames.broadcast_if_few(members.select("key").distinct())
    return (
        docs.join(keys, "key", "left_semi")
        .select("text")
        .mapInArrow(
            lambda batches: _shingled(batches, settings), "set long, signature binary, shingles binary"
        )
        .dropDuplicates(["set"])
    )


def _linked(tasks: DataFrame, settings: Settings) -> DataFrame:
    return tasks.groupBy("kind", "unit", "low", "high").applyInArrow(
        lambda table: _links(table, settings), "set long, root long, links long, texts long"
    )


def _all_links(docs: DataFrame, candidates: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links of the candidates' texts, each pair of texts looked at in one task."""
    n_bands = settings.n_hashes // settings.band_rows
    whole = _sized(candidates).withColumn("group", F.col("component")).withColumn("place", F.lit(0))
    chained = whole.filter(F.col("size") > n_bands * BLOCK)
    if chained.isEmpty():
        return _linked(_tasks(whole).join(_shingles_of(docs, whole, settings), "set"), settings)
    bands = materialize(_shared_bands(chained.drop("group", "place"), sets), "bands")
    # A component goes by bands with all of its members.
    by_band = bands.select("component").distinct()
    whole = whole.join(by_band, "component", "left_anti")
    shingled = materialize(_shingles_of(docs, bands, settings), "shingles")
    tasks = _tasks(bands)
    likely = tasks.join(shingled.select("set", "signature"), "set").groupBy(
        "kind", "unit", "low", "high"
    ).applyInArrow(lambda table: _likely(table, settings), tasks.select("set", *tasks.drop("set").columns).schema)
    links = _linked(_tasks(whole).join(_shingles_of(docs, whole, settings), "set"), settings)
    return links.unionByName(_linked(likely.join(shingled, "set"), settings))


def _texts(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """All rows with their sets; and one row per text with an id, its copies, class and links."""
    columns = T.StructType.fromDDL("doc_id long, key long, set long, bands array<long>")
    columns = T.StructType([*columns.fields, *[f for f in docs.schema.fields if f.name == "carried"]])
    sketch = docs.mapInArrow(lambda batches: _sketch(batches, settings), columns)
    sketch = materialize(sketch, "sketch")
    sets = sketch.filter("`set` is not null").groupBy("set").agg(
        F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")
    )
    sets = materialize(sets, "sets")
    candidates = materialize(
        _candidates(sets).join(sets.select("set", "key", "copies"), "set"), "candidates"
    )
    links = _all_links(docs, candidates, sets, settings)
    links = materialize(links, "links")
    found = components(links.select("set", "root")).withColumnRenamed("node", "set")
    counts = links.groupBy("set").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    linked = found.join(counts, "set").join(sets.select("set", "key"), "set")
    classes = linked.groupBy("component").agg(F.min(F.struct("key", "set")).alias("first"))
    linked = linked.join(classes, "component").select("set", "first", "links", "texts")
    texts = sets.select("set", "key", "copies").join(linked, "set", "left").select(
        "set", "key", "copies",
        F.coalesce("first", F.struct("key", "set")).alias("first"),
        F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("texts", F.lit(0)).alias("texts"),
    )
    return sketch, materialize(texts, "texts")


def _id(key: str):
    return F.when(F.col(key) != _LOWEST, F.col(key))


def join(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document.

    ``class_id`` is the smallest id among the documents connected with it by links,
    ``text_id`` the smallest among those with the same shingles, ``n_links`` the
    number of other documents at or above the threshold (copies counted one by
    one), ``n_texts`` the number of other texts.
    """
    sketch, texts = _texts(_keyed(docs, id_col, text_col), settings)
    known = texts.withColumnRenamed("key", "text_key").withColumn("class_key", F.col("first.key"))
    joined = sketch.select("doc_id", "set").join(frames.broadcast_if_few(known), "set", "left")
    alone = F.col("set").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(_id("class_key")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(_id("text_key")).alias("text_id"),
        F.when(alone, 0).otherwise(F.col("copies") - 1 + F.col("links")).alias("n_links"),
        F.when(alone, 0).otherwise(F.col("texts")).alias("n_texts"),
    )


def classed(
    docs: DataFrame,
    carried: list[Column],
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, the columns ``carried`` and ``cluster`` of every row, repeated ones too.

    ``cluster`` is equal for the documents of one class, null for those without words.
    """
    sketch, texts = _texts(_keyed(docs, id_col, text_col, carried), settings)
    known = texts.select("set", F.col("first.set").alias("cluster"))
    joined = sketch.select("doc_id", "set", "carried").join(frames.broadcast_if_few(known), "set", "left")
    return joined.select("doc_id", "carried.*", "cluster")


def keep_one(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each class: that with the smallest id.

    Documents without words all stay.
    """
    sketch, texts = _texts(_keyed(docs, id_col, text_col), settings)
    # A text's rows go if it is not the first of its class, or their id is not the text's first.
    first = texts.select(
        F.col("set").alias("_set"), "key", (F.col("first.set") == F.col("set")).alias("leads")
    )
    rows = sketch.filter("`set` is not null").join(
        frames.broadcast_if_few(first), F.col("set") == F.col("_set")
    ).select("set", sketch["key"].alias("_key"), (F.col("leads") & (sketch["key"] == first["key"])).alias("stays"))
    gone = rows.filter("not stays").select("set", "_key").distinct()
    again = rows.filter("stays").groupBy("set", "_key").count().filter("count > 1").select("set", "_key")
    mark, other_set, other_key = (
        frames.unused(name, docs.columns) for name in ("_near_set", "_other_set", "_other_key")
    )

    def with_sets(batches):
        for batch in batches:
            for part in words_of.slices(batch, text_col):
                values, starts = words_of.shingles(part.column(text_col))
                sets = [
                    _set_key(np.unique(values[a:b])) if b > a else None
                    for a, b in zip(starts[:-1], starts[1:])
                ]
                arrays = [*part.columns, pa.array(sets, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, mark])

    schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.LongType())])
    marked = docs.mapInArrow(with_sets, schema)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST))
    same = (F.col(mark) == F.col(other_set)) & (key == F.col(other_key))
    left = marked.join(frames.broadcast_if_few(gone.toDF(other_set, other_key)), same, "left_anti")
    if again.isEmpty():
        return left.drop(mark)
    again = materialize(again.toDF(other_set, other_key), "again")
    once = left.join(again, same, "left_semi").dropDuplicates([id_col, mark])
    rest = left.join(again, same, "left_anti")
    return rest.unionByName(once).drop(mark)
