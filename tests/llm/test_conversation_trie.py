"""The trie of conversations against nodes listed one by one."""

from __future__ import annotations

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from brute import words
from tabaudit.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, conv string, `_range` int"


def plain(rows, forked=True):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in turns.items()}
    members, ends = {}, {}
    for c, sequence in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if forked else 0
        rebuilt = tuple([*own.get(c - c % 20, [])[:h], *sequence[h:]])
        for d in range(len(rebuilt) + 1):
            members.setdefault(rebuilt[:d], []).append(c)
        ends.setdefault(rebuilt, []).append(c)
    out = set()
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:-1] == n and m for m in members)]
        saved = sum((len(members[n]) - 1) * len(words(n[-1][1] if n else "")) for n in below)
        joined = ",".join(map(str, sorted(ends.get(node, []))))
        out.add((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside),
            len(children), len(leaves), saved, hashlib.sha256(joined.encode()).hexdigest(),
        ))
    return out


def built(spark, rows, fork=True, **options):
    convs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    got = trie.prefix_trie(convs, trie.fork_by_blocks() if fork else None, **options)
    assert got.dtypes == [
        (c, "string" if c == "ends_sha256" else "bigint")
        for c in (
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            "saved_tokens", "ends_sha256",
        )
    ]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found))
    return set(found)


def random_rows(seed, n=90, alphabet="ab"):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(150), n):
        for turn in range(draw.choice([1, 1, 2, 3, 5, 7])):
            rows.append((c, turn, draw.choice(["user", None]), draw.choice([*alphabet, "two words", None])))
    return rows


@pytest.mark.parametrize("shard_convs", [2, 12, 1000])
def test_random_conversations(spark, monkeypatch, shard_convs):
    # Small bounds give a top and many shards; a top of all conversations gives one shard.
    monkeypatch.setattr(trie.math, "isqrt", lambda n: 0)
    rows = random_rows(shard_convs)
    assert built(spark, rows, shard_convs=shard_convs) == plain(rows)


def test_without_forks_and_with_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie.math, "isqrt", lambda n: 0)
    rows = random_rows(7, 40) + [(1000, t, "user", f"turn {t % 3}") for t in range(300)]
    rows += [(1001, t, "user", f"turn {t % 3}") for t in range(150)]
    assert built(spark, rows, fork=False, shard_convs=3) == plain(rows, forked=False)


def test_nulls_ties_and_turnless(spark):
    # 23 and 43 lose all their turns if their checksum skips more than they have.
    rows = [(c, 0, "user", "hello there") for c in range(21, 60)]
    rows += [(5, None, "user", "first"), (5, 3, None, None), (5, 1, "a", ""), (None, 1, "u", "lost")]
    rows += [(6, 1, "u", "same")] * 3 + [(-3, 0, "u", "below zero")]
    expected = plain(rows)
    assert built(spark, rows) == expected
    assert any(n[1] == 0 and n[7] != hashlib.sha256(b"").hexdigest() for n in expected)


def test_empty_table(spark):
    assert built(spark, []) == set()


def test_queue_spills_and_keeps_order(monkeypatch):
    monkeypatch.setattr(trie, "_CHUNK", 3)
    draw, queue, expected = random.Random(1), trie.SpillingQueue(limit=10), []
    out = []
    for n in range(500):
        item = (draw.randrange(50), n, 0, 0)
        queue.push(item)
        expected.append(item)
        if draw.random() < 0.3:
            least = min(expected)
            assert queue.peek() == least and queue.pop() == least
            expected.remove(least)
    while queue.peek() is not None:
        out.append(queue.pop())
    assert queue.n_spilled > 5 and out == sorted(expected)


def test_time_forward_over_batches():
    # A root with two children, one of which has a child, in one shard; another shard after it.
    names = [f.split()[0] for f in trie._PATHS.split(", ")]
    rows = [(0, 0, 3, 9, 2, 8, 1, 5), (0, 0, 2, 8, 0, 1, 0, 1), (0, 0, 1, 7, 0, 1, 1, 1), (0, 0, 0, 1, None, None, 0, 2)]
    rows += [(1, 0, 4, 2, None, None, 1, 0)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r))], schema=pa.schema([(n, pa.int64()) for n in names])) for r in rows]
    got = [tuple(r.values()) for b in trie.time_forward(iter(batches)) for r in b.to_pylist()]
    assert got == [(9, 1, 5), (8, 1, 6), (7, 1, 1), (1, 2, 9), (2, 1, 0)]
