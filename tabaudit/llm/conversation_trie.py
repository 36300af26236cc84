"""Prefix trie of conversations, its subtree totals summed by time-forward processing.

A node of depth ``d`` is a distinct sequence of the first ``d`` turns. Sequences are told
apart by 128 bits: the exclusive-or of hashes of position, role and text. They are
running values over the turns in order of conversation and position, which are dealt out
by ranges, so that a conversation with a third of all turns is spread like any other.

The smallest member of a node and its depth name it, so the nodes with one smallest
member form a path, and paths form a tree. Subtree totals pass up that tree:

* Nodes with more than ``SHARD_CONVS`` members (or the square root of all conversations,
  if that is more) are the top. The subtrees that hang below the top are the shards; each
  has at most so many members, thus so many paths.
* Within a shard the paths are sorted by reverse level (deepest first) outside of memory;
  each passes its total to its parent through a priority queue that spills to disk.
* The totals of the shards' roots are added up per place in the top, whose paths, fewer
  than conversations divided by that bound, are processed in the same way.
* Within each path, totals are running sums from its deepest node upwards, dealt out by
  ranges again.

``Fork`` says which conversations begin with turns of another one.

Defined results: turns are ordered by number, null first, then by hashes of role and text;
null role and text are empty; repeated rows are repeated turns. Rows without a
conversation id belong to no conversation and are left out. An empty table has no nodes,
not even a root. Texts of any length count as one hash and a number of words. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabaudit.llm import frames, mixing
from tabaudit.session import materialize

SHARD_CONVS = 1_000
# Messages that a queue holds in memory before it writes them out.
QUEUE_MESSAGES = 500_000
_CHUNK = 10_000


@dataclass(frozen=True)
class Fork:
    """Conversation ``c`` begins with the first ``n_shared(c)`` turns of ``base(c)``, in place of its own.

    A base is its own base, and ``n_shared`` is at most ``most``.
    """

    base: Callable[[Column], Column]
    n_shared: Callable[[Column], Column]
    most: int


def fork_by_blocks(block: int = 20, kinds: int = 4) -> Fork:
    """Blocks of ids share their first one's beginning, of a length that a checksum of the id sets."""
    return Fork(
        base=lambda c: c - c % block,
        n_shared=lambda c: F.crc32(c.cast("string").cast("binary")) % kinds,
        most=kinds - 1,
    )


class SpillingQueue:
    """Smallest item first; sorted runs go to files of the task when memory is full."""

    def __init__(self, limit: int = QUEUE_MESSAGES):
        self._limit, self._heap, self._runs, self.n_spilled = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self._heap, item)
        if len(self._heap) > self._limit:
            self._heap.sort()
            run = self._written(self._heap)
            heapq.heappush(self._runs, (next(run), self.n_spilled, run))
            self.n_spilled += 1
            self._heap = []

    @staticmethod
    def _written(items: list) -> Iterator[tuple]:
        file = tempfile.TemporaryFile()  # gone with the task
        for at in range(0, len(items), _CHUNK):
            pickle.dump(items[at : at + _CHUNK], file)
        file.seek(0)

        def read():
            with file:
                for _ in range(0, len(items), _CHUNK):
                    yield from pickle.load(file)

        return read()

    def peek(self) -> tuple | None:
        heads = [*self._heap[:1], *(r[0] for r in self._runs[:1])]
        return min(heads) if heads else None

    def pop(self) -> tuple:
        if not self._runs or (self._heap and self._heap[0] <= self._runs[0][0]):
            return heapq.heappop(self._heap)
        head, number, run = self._runs[0]
        following = next(run, None)
        if following is None:
            heapq.heappop(self._runs)
        else:
            heapq.heapreplace(self._runs, (following, number, run))
        return head


_PATHS = "shard1 long, shard2 long, top long, conv long, parent_top long, parent long, leaves long, saved long"
_TOTALS = "conv long, leaves long, saved long"


def time_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of paths (``_PATHS``) that come by shard and reverse level.

    ``parent_top`` and ``parent`` are null for a path whose parent is in no path of the
    shard; every other parent is processed later, so its messages wait in the queue.
    """
    queue, shard = SpillingQueue(), None
    for batch in batches:
        out = []
        for s1, s2, top, conv, parent_top, parent, leaves, saved in zip(*(c.to_pylist() for c in batch.columns)):
            if (s1, s2) != shard:
                queue, shard = SpillingQueue(), (s1, s2)
            while (head := queue.peek()) is not None and head[:2] == (-top, -conv):
                _, _, more_leaves, more_saved = queue.pop()
                leaves, saved = leaves + more_leaves, saved + more_saved
            if parent_top is not None:
                queue.push((-parent_top, -parent, leaves, saved))
            out.append((conv, leaves, saved))
        columns = [pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 3
        yield pa.RecordBatch.from_arrays(columns, names=["conv", "leaves", "saved"])


def _summed(paths: DataFrame) -> DataFrame:
    """Totals of ``paths``; a shard never leaves its task."""
    names = [f.split()[0] for f in _PATHS.split(", ")]
    dealt = paths.select(*names).repartition("shard1", "shard2")
    ordered = dealt.sortWithinPartitions("shard1", "shard2", F.desc("top"), F.desc("conv"))
    return ordered.mapInArrow(time_forward, _TOTALS)


def _ranged(rows: DataFrame, order: list, name: str) -> DataFrame:
    return materialize(
        rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name
    )


def _before(ranged: DataFrame, sums: dict[str, Column], over: Callable[[str], Column]) -> DataFrame:
    """For a conversation that goes on from earlier ranges, ``sums`` over its part in those.

    Ranges are sorted by conversation, so this is at most one row per range.
    """
    parts = ranged.groupBy("conv", "_range").agg(*[s.alias(n) for n, s in sums.items()])
    earlier = Window.partitionBy("conv").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = [over(n).over(earlier).alias(f"_before_{n}") for n in sums]
    rows = parts.select("conv", "_range", *carried).filter(F.col(f"_before_{next(iter(sums))}").isNotNull())
    return F.broadcast(rows)


def _part(order: list[Column]) -> Window:
    """The rows of a conversation within a range, up to the current one."""
    return (
        Window.partitionBy("conv", "_range").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _sum_so_far(name: str, value: Column, window: Window) -> Column:
    """``value`` added up from the conversation's first row, with what earlier ranges bring."""
    return F.coalesce(f"_before_{name}", F.lit(0)) + F.sum(value).over(window)


def _turns(convs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Narrow rows of all turns: hashes instead of texts. Their position ``row`` is fixed by writing them."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = convs.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(1), text, role).alias("h2"),
        mixing.n_tokens(text).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )
    return materialize(rows.filter("conv is not null"), "turns")


def _rebuilt(turns: DataFrame, convs: DataFrame, fork: Fork | None) -> DataFrame:
    """``conv``, ``pos``, ``e1``, ``e2``, ``words`` and ``_range`` of all turns of the rebuilt conversations."""
    nothing = F.lit(None)
    own = turns.withColumns({"own": F.lit(1).cast("long"), "rank": nothing.cast("int")})
    skipped = F.lit(0).cast("long")
    if fork is not None:
        skipped = fork.n_shared(F.col("conv")).cast("long")
        order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "h1", "h2", "row")
        firsts = (
            turns.filter(F.col("conv") == fork.base(F.col("conv")))
            .withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= fork.most)
            .select(F.col("conv").alias("base"), "rank", "h1", "h2", "words")
        )
        forks = convs.select("conv", fork.base(F.col("conv")).alias("base"), skipped.alias("n_shared"))
        shared = forks.join(firsts, "base").filter(F.col("rank") <= F.col("n_shared"))
        turn, zero = nothing.cast(turns.schema["turn"].dataType), F.lit(0).cast("long")
        own = own.unionByName(
            shared.select(
                "conv", turn.alias("turn"), "h1", "h2", "words", "rank",
                zero.alias("row"), zero.alias("own"),
            )
        )
    # Shared turns come before the conversation's own ones.
    order = ["conv", "own", "rank", "turn", "h1", "h2", "row"]
    ranged = _ranged(own, [F.asc_nulls_first(c) for c in order], "ordered-turns")
    before = _before(ranged, {"all": F.count(F.lit(1)), "own": F.sum("own")}, F.sum)
    window = _part([F.asc_nulls_first(c) for c in order[1:]])
    placed = ranged.join(before, ["conv", "_range"], "left").select(
        "conv",
        "_range",
        "words",
        "h1",
        "h2",
        F.col("own").alias("is_own"),
        skipped.alias("n_shared"),
        _sum_so_far("all", F.lit(1), window).alias("at"),
        _sum_so_far("own", F.col("own"), window).alias("own_rank"),
    )
    # A conversation's own first turns give way to the shared ones.
    kept = placed.filter((F.col("is_own") == 0) | (F.col("own_rank") > F.col("n_shared")))
    pos = F.when(F.col("is_own") == 0, F.col("at")).otherwise(F.col("at") - F.col("n_shared"))
    out = kept.select("conv", "_range", "words", "h1", "h2", pos.alias("pos"))
    return out.select(
        "conv", "pos", "words", "_range",
        F.xxhash64("pos", "h1").alias("e1"),
        F.xxhash64("h2", "pos").alias("e2"),
    )


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """``conv``, ``depth``, ``g1``, ``g2`` of all prefixes but the empty one, with their parents' ``p1``, ``p2``."""
    rebuilt = materialize(rebuilt, "rebuilt-turns")
    before = _before(rebuilt, {"g1": F.bit_xor("e1"), "g2": F.bit_xor("e2")}, F.bit_xor)
    window = _part([F.col("pos")])
    joined = rebuilt.join(before, ["conv", "_range"], "left")
    for n in ("1", "2"):
        so_far = F.bit_xor(f"e{n}").over(window)
        joined = joined.withColumn(f"g{n}", F.coalesce(f"_before_g{n}", F.lit(0)).bitwiseXOR(so_far))
    return materialize(
        joined.select(
            "conv",
            F.col("pos").alias("depth"),
            "words",
            "g1",
            "g2",
            F.col("g1").bitwiseXOR(F.col("e1")).alias("p1"),
            F.col("g2").bitwiseXOR(F.col("e2")).alias("p2"),
        ),
        "prefixes",
    )


_NODE = ["depth", "g1", "g2"]


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks, which come in order; a node's state is all that is kept."""
    names = [*_NODE, "ends_sha256"]
    key, state = None, None
    for batch in batches:
        out = []
        for depth, g1, g2, chunk in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, g1, g2) != key:
                if state:
                    out.append((*key, state.hexdigest()))
                key, state = (depth, g1, g2), hashlib.sha256(chunk.encode())
            else:
                state.update(b"," + chunk.encode())
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out])
    if state:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, state.hexdigest())))])


def _ends(convs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Per node at which conversations end, the hash of their ids."""
    zero = F.lit(0).cast("long")
    empty = convs.select("conv", zero.alias("depth"), zero.alias("g1"), zero.alias("g2"))
    last = (
        empty.unionByName(prefixes.select("conv", *_NODE))
        .groupBy("conv").agg(F.max(F.struct(*_NODE)).alias("end"))
        .select("end.*", "conv")
    )
    # Chunks of ids by ranges of node and id, then one stream of chunks per node.
    ranged = last.repartitionByRange(*_NODE, "conv").withColumn("_range", F.spark_partition_id())
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    chunks = materialize(ranged, "ends").groupBy(*_NODE, "_range").agg(joined.alias("chunk"))
    ordered = chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "_range").select(*_NODE, "chunk")
    return ordered.mapInArrow(_hash_ends, "depth long, g1 long, g2 long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    fork: Fork | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    shard_convs: int = SHARD_CONVS,
) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    ``saved_tokens`` adds up, over the subtree, the words of each node's last turn for all
    members but one: what a cache of prefixes saves.
    """
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    convs = materialize(turns.select("conv").distinct(), "convs")
    prefixes = _prefixes(_rebuilt(turns, convs, fork))

    nodes = _nodes(convs, prefixes)
    most = max(shard_convs, math.isqrt(convs.count()))
    paths = _paths(nodes, prefixes, most)
    totals = _path_totals(paths)
    return _node_totals(nodes, totals)


def _nodes(convs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """All nodes with their parents' names and sizes, number of children and hashes of ends."""
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    root = root.filter("n_convs > 0").select(
        *[zero.alias(c) for c in _NODE], "conv_id", "n_convs",
        zero.alias("words"), *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")],
    )
    grouped = prefixes.groupBy(*_NODE).agg(
        F.min("conv").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        *[F.max(c).alias(c) for c in ("words", "p1", "p2")],
    )
    bare = materialize(grouped.unionByName(root), "bare-nodes")
    parents = bare.select(
        (F.col("depth") + 1).alias("depth"), F.col("g1").alias("p1"), F.col("g2").alias("p2"),
        F.col("conv_id").alias("parent"), F.col("n_convs").alias("parent_n"),
    )
    named = materialize(bare.join(parents, ["depth", "p1", "p2"], "left").drop("p1", "p2"), "named-nodes")
    children = (
        named.filter("depth > 0")
        .groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    whole = named.join(children, ["conv_id", "depth"], "left").join(_ends(convs, prefixes), _NODE, "left")
    return materialize(
        whole.withColumns(
            {
                "n_children": F.coalesce("n_children", zero),
                "ends_sha256": F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)),
            }
        ),
        "nodes",
    )


def _paths(nodes: DataFrame, prefixes: DataFrame, most: int) -> DataFrame:
    """The paths, cut where they leave the top, each with its shard, parent and own sums."""
    is_top = F.col("n_convs") > most
    one = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    own = (F.col("n_convs") - 1) * F.col("words")
    paths = nodes.groupBy(F.col("conv_id").alias("conv"), is_top.alias("is_top")).agg(
        F.min("depth").alias("top"),
        F.min_by(F.struct("parent", (F.col("parent_n") > most).alias("top")), "depth").alias("above"),
        F.sum(one).alias("leaves"),
        F.sum(own).alias("saved"),
    )
    paths = paths.select(
        "conv", "is_top", "top", "leaves", "saved",
        F.col("above.parent").alias("parent"), F.col("above.top").alias("parent_is_top"),
    )
    paths = materialize(paths, "bare-paths")
    # The first node below the top that a conversation passes is the root of its shard.
    top = frames.broadcast_if_few(nodes.filter(is_top).select(*_NODE))
    above = top.select((F.col("depth") + 1).alias("depth"), F.col("g1").alias("p1"), F.col("g2").alias("p2"))
    roots = (
        prefixes.join(above, ["depth", "p1", "p2"], "left_semi").join(top, _NODE, "left_anti")
        .select("conv", F.col("g1").alias("shard1"), F.col("g2").alias("shard2"))
    )
    tops = paths.select(
        F.col("conv").alias("parent"), F.col("is_top").alias("parent_is_top"), F.col("top").alias("parent_top")
    )
    # Without a top, all paths are one shard.
    return materialize(
        paths.join(tops, ["parent", "parent_is_top"], "left")
        .join(roots, "conv", "left")
        .fillna(0, ["shard1", "shard2"]),
        "paths",
    )


def _path_totals(paths: DataFrame) -> DataFrame:
    """``conv``, ``top``, ``parent`` of every path with the ``leaves`` and ``saved`` of all below its first node."""
    none = F.lit(None).cast("long")
    low = paths.filter("not is_top")
    # Messages to the top leave the shard.
    out_of_shard = low.withColumn("parent_top", F.when(~F.col("parent_is_top"), F.col("parent_top")))
    place = ["conv", "top", "parent", "parent_is_top"]
    low_totals = materialize(
        low.select(*place).join(_summed(out_of_shard), "conv"), "shard-totals"
    )
    sent = low_totals.filter("parent_is_top").groupBy(F.col("parent").alias("conv")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
    )
    high = paths.filter("is_top").join(sent, "conv", "left").withColumns(
        {
            **{c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")},
            "shard1": F.lit(0).cast("long"),
            "shard2": F.lit(0).cast("long"),
            "parent_top": F.coalesce("parent_top", none),
        }
    )
    high_totals = high.select(*place).join(_summed(high), "conv")
    return materialize(low_totals.unionByName(high_totals), "path-totals")


def _node_totals(nodes: DataFrame, totals: DataFrame) -> DataFrame:
    """Running sums along each path from its deepest node, with what hangs at its nodes."""
    hung = (
        totals.filter(F.col("parent") != F.col("conv"))
        .groupBy(F.col("parent").alias("conv"), (F.col("top") - 1).alias("depth"))
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        .withColumn("is_node", F.lit(0))
    )
    own = nodes.select(
        F.col("conv_id").alias("conv"),
        "depth",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        F.lit(1).alias("is_node"),
        "parent", "n_convs", "n_children", "ends_sha256",
    )
    order = [F.desc("depth"), F.col("is_node")]
    ranged = _ranged(own.unionByName(hung, allowMissingColumns=True), [F.col("conv"), *order], "path-order")
    before = _before(ranged, {c: F.sum(c) for c in ("leaves", "saved")}, F.sum)
    window = _part(order)
    summed = ranged.join(before, ["conv", "_range"], "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        *[
            _sum_so_far(c, F.col(c), window).alias(name)
            for c, name in (("leaves", "n_leaves"), ("saved", "saved_tokens"))
        ],
        "ends_sha256",
        "is_node",
    )
    return summed.filter("is_node = 1").drop("is_node")
