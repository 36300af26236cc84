"""Collocations against counting every run of words."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabaudit.llm import phrases


def plain(rows, min_count, top):
    """``rows`` are (text, lang)."""
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall(r"[^ \t]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                count.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    frequent = {key: n for key, n in count.items() if n >= min_count}
    out = []
    for (lang, p), a in frequent.items():
        if len(p) == 1:
            continue
        cuts = [(2_000_000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        longer = [
            n for (other, q), n in frequent.items()
            if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
        ]
        if not any(100 * n >= 80 * a for n in longer):
            out.append((lang, " ".join(p), a, count[lang, p[:k]], count[lang, p[k:]], total[lang], score))
    ranked = []
    for lang in total:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, n, *r[1:]) for n, r in enumerate(mine[:top], 1)]
    return set(ranked)


def random_rows(seed, n=300):
    draw = random.Random(seed)
    vocabulary = ["der", "Die", "das", "été", "x-y", "\x1c", "ÀB", "new", "york", "city", "a b", "'s"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " ! "]
    rows = []
    for _ in range(n):
        words = "".join(draw.choice(vocabulary) + draw.choice(ends) for _ in range(draw.randrange(60)))
        if draw.random() < 0.3:
            words += "new york city hall\v" * draw.randrange(4)
        rows.append((words, draw.choice(["de", "en", None])))
    return rows + [(None, "de"), ("", None), ("!!", "only ends"), ("  ", "blank")]


def built(spark, rows, **options):
    docs = spark.createDataFrame(
        [(i, *r, 1, "g") for i, r in enumerate(rows)], "doc_id long, text string, lang string, cell int, gram string"
    )
    got = phrases.collocations(docs.repartition(3), **options)
    kinds = {"lang": "string", "phrase": "string"}
    assert got.dtypes == [(c, kinds.get(c, "bigint")) for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")]
    return {tuple(r) for r in got.collect()}


@pytest.mark.parametrize(("min_count", "shards", "top"), [(30, 8, 2000), (5, 8, 7), (2, 3, 2000), (30, 1, 2000)])
def test_random_texts(spark, min_count, shards, top):
    rows = random_rows(min_count)
    assert built(spark, rows, min_count=min_count, shards=shards, top=top) == plain(rows, min_count, top)


def test_hot_copies_and_long_text(spark):
    # One id for all puts them into one shard, which then has the whole support.
    rows = [("one two three four five six. " * 3, "en")] * 40 + [("far away " * 20_000, "en")]
    assert built(spark, rows) == plain(rows, 30, 2000)
    docs = spark.createDataFrame([(None, *r) for r in rows], "doc_id long, text string, lang string")
    assert {tuple(r) for r in phrases.collocations(docs).collect()} == plain(rows, 30, 2000)


def test_full_bitmaps_change_nothing(spark, monkeypatch):
    rows = random_rows(4)
    monkeypatch.setattr(phrases, "MIN_BITS", 6)
    monkeypatch.setattr(phrases, "MAX_BITS", 6)
    assert built(spark, rows) == plain(rows, 30, 2000)


def test_empty_table(spark):
    assert built(spark, []) == set()


def test_lowered_support_is_complete(spark):
    # 30 occurrences dealt out over documents of one word pair each: no shard has many.
    rows = [(f"rare pair {i} filler{i}", "en") for i in range(30)]
    assert {r[2] for r in built(spark, rows)} == {"rare pair"}
    assert not built(spark, rows[1:])


def test_hashes_follow_the_words_alone():
    draw = random.Random(8)
    words = ["".join(draw.choices("abé\x01", k=draw.randrange(1, 9))).encode() for _ in range(20_000)]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    hashes = phrases._hashes(np.frombuffer(b"".join(words), np.uint8), bounds).tolist()
    assert len(set(zip(words, hashes))) == len(set(words)) == len(set(hashes))


def test_members(spark):
    draw = random.Random(5)
    keys = [draw.getrandbits(64) - (1 << 63) for _ in range(500)]
    held = phrases.members(spark.createDataFrame([(k,) for k in keys], "gram long"), F.col("gram"))
    assert all(k in held for k in keys)
    others = np.array([draw.getrandbits(64) for _ in range(5000)], np.uint64)
    assert held.has(others).mean() < 0.2


def test_scores_beyond_64_bits(spark):
    big = 6_000_000_000_000
    counts = [("en", "a", 1, big * 2), ("en", "b", 1, big + 1), ("en", "a b", 2, big)]
    table = spark.createDataFrame(counts, "lang string, phrase string, n_words int, n long")
    [row] = phrases.scored(table).collect()
    assert row.score == 2_000_000 * big // (big * 3 + 1)
