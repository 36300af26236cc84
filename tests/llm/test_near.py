"""Jaccard join, fingerprints and connected components."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from brute import jaccard, near_classes, shingle_set
from tabaudit.llm import fingerprints, jaccard_join
from tabaudit.llm.components import components


def varied(base: list[str], edits: int, seed: int) -> str:
    rng = random.Random(seed)
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"edit{rng.random()}"
    return " ".join(out)


@pytest.fixture(scope="module")
def near_docs(make_docs):
    base = [f"w{i}" for i in range(400)]
    other = [f"v{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \n "), (3, "a b c"), (4, "a b c"), (5, "a b d"), (None, "a b c")]
    rows += [(10 + i, varied(base, i % 12, i)) for i in range(40)]
    rows += [(60 + i, varied(other, 3, 0)) for i in range(5)]
    rows += [(70, varied(other, 3, 0)), (70, varied(other, 3, 0))]
    rows += [(80, " ".join(base * 300))]
    return make_docs(rows)


def plain(docs, missing=-1):
    """Classes and links with every row for itself; repeated ids get keys of their own."""
    rows = [(missing if r.doc_id is None else r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    keyed = {(id_, n): text for n, (id_, text) in enumerate(rows)}
    return sorted((k[0], c[0], n) for k, (c, n) in near_classes(keyed).items())


def joined(docs, settings=jaccard_join.Settings(), missing=-1):
    rows = jaccard_join.join(docs, settings).collect()
    fix = lambda v: missing if v is None else v
    return sorted((fix(r.doc_id), fix(r.class_id), r.n_links) for r in rows)


def test_join_matches_all_pairs(near_docs, documents, monkeypatch):
    assert joined(near_docs) == plain(near_docs)
    assert joined(documents) == plain(documents)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)  # the group of 40 is cut into blocks
    assert joined(near_docs) == plain(near_docs)
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)  # some blocks are empty
    monkeypatch.setattr(jaccard_join, "PAIRS", 16)
    assert joined(near_docs) == plain(near_docs)


def test_chained_components_are_compared_band_by_band(near_docs, make_docs, monkeypatch):
    """Texts that share a template but are not alike make one component, whatever its size."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "PACK", 32)
    template = [f"t{i}" for i in range(60)]
    rows = [
        (1000 + i, " ".join(template + [f"own{i}-{k}" for k in range(40)] + ["end"] * (i % 3 == 0)))
        for i in range(600)
    ]
    rows += [(id_ + 3000, text.replace("own7-39", "other")) for id_, text in rows[:20]]
    docs = make_docs(rows).unionByName(near_docs)
    dealt = []
    tasks = jaccard_join._tasks
    monkeypatch.setattr(jaccard_join, "_tasks", lambda members: dealt.append(tasks(members)) or dealt[-1])
    expected = plain(docs)
    assert joined(docs) == expected
    assert sum(n for _, _, n in expected) > 40
    # Bands first, then what goes by components: fewer rows than blocks of 620 texts would meet.
    assert len(dealt) == 2 and 0 < dealt[0].count() < 620 * 155 / 2
    assert dealt[0].select("place").distinct().count() > 1


def test_keep_one_keeps_the_first_of_each_class(near_docs, documents):
    kept = jaccard_join.keep_one(near_docs)
    assert kept.columns == near_docs.columns
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect())
    # Texts without words stay; of the repeated row 70's class, 60 stays.
    assert ids == sorted({c for _, c, _ in plain(near_docs)})
    twice = near_docs.filter("doc_id = 70")
    assert twice.count() == 2 and jaccard_join.keep_one(twice).count() == 1
    assert jaccard_join.keep_one(near_docs.limit(0)).count() == 0
    assert jaccard_join.join(near_docs.limit(0)).count() == 0


def test_posterior_never_drops_likely_pairs():
    for n in (16, 64, 160):
        m = jaccard_join.least_matches(n, 0.8, 1e-6)
        grid = np.linspace(0, 1, 20001)
        for matches, dropped in ((m - 1, True), (m, False)):
            density = grid**matches * (1 - grid) ** (n - matches)
            share = density[grid >= 0.8].sum() / density.sum()
            assert (share < 1.3e-6) == dropped


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 180)]
    star = [(500, 600 + i) for i in range(50)]
    noise = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    edges = chain + star + noise + [(7, 7), (180, 100)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    frame = spark.createDataFrame(edges, "x long, y long")
    assert {(r.node, r.component) for r in components(frame).collect()} == {(x, root(x)) for x in parent}
    assert components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("range_rows", [7, 10_000])
def test_edited_fingerprints(near_docs, documents, range_rows):
    for docs in (documents, near_docs.filter("doc_id is not null and doc_id <> 70")):
        rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
        texts = [r.text or "" for r in rows]
        out = {r.doc_id: r for r in fingerprints.edited(docs, range_rows=range_rows).collect()}
        assert len(out) == len(rows)
        prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs).collect()}
        for row, own, following in zip(rows, texts, texts[1:] + texts[:1]):
            half = len(own) // 2
            edited = own[: len(own) - half] + following[:half]
            got = out[row.doc_id]
            assert got.n_chars == len(own) and got.fingerprint == prints[row.doc_id]
            assert got.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            for near, text in ((got.near_edited, edited), (got.near_next, following)):
                a, b = shingle_set(own), shingle_set(text)
                assert abs(near - (jaccard(a, b) if a or b else 1.0)) < 0.2
        same = {}
        for row, own in zip(rows, texts):
            same.setdefault(own, set()).add(prints[row.doc_id])
        assert len(same) < len(rows) and all(len(found) == 1 for found in same.values())


def test_edited_handles_repeats_single_rows_and_nothing(near_docs):
    rows = fingerprints.edited(near_docs, range_rows=5)
    assert rows.count() == near_docs.count()
    one = fingerprints.edited(near_docs.filter("doc_id = 10")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints.edited(near_docs.limit(0)).count() == 0


def test_near_duplicates_by_bands(near_docs):
    rows = fingerprints.near_duplicates(near_docs).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_links) for r in rows)
    assert got == [(a, n) for a, _, n in plain(near_docs)]
