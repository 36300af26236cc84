"""Line dedup, mixing and packing."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from brute import near_classes, spread_cleaned, words
from tabaudit.llm import frames, line_spread, mixing, packing, queries


def cleaned(docs, **options):
    spread = line_spread.spread_lines(docs, min_sites=options.get("min_sites", 10))
    out = line_spread.remove_lines(docs, spread, removed_col="_n_removed")
    return sorted((r.doc_id or 0, r.text or "-", r.text is None) for r in out.collect())


def want(docs, **options):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    return sorted((i or 0, t or "-", t is None) for i, t in spread_cleaned(rows, **options))


@pytest.fixture(scope="module")
def line_docs(make_docs):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        lines = [f"own line {i} {k} with some words" for k in range(6)]
        lines.insert(rng.randrange(6), ["  Shared notice.\t", "Shared notice."][i % 2])
        if i < 36:
            lines.append(f"near the threshold {i % 4}")
        if i % 5 == 0:
            lines += ["", "own repeat", "own repeat", " \t"]
        rows.append((i, "\n".join(lines), "en", f"site{i % (9 if i < 36 and i % 4 else 30)}"))
    rows += [(200, "Shared notice.", "en", "site1"), (201, None, "en", "site1"), (202, "", None, None)]
    rows += [(0, rows[0][1], "en", "site0"), (None, "Shared notice.\nlong enough to stay in place", "en", None)]
    return make_docs(rows)


def test_spread_lines_match_exact_counts(line_docs, documents):
    assert cleaned(line_docs) == want(line_docs)
    assert cleaned(documents, min_sites=3) == want(documents, min_sites=3)
    spread = line_spread.spread_lines(line_docs)
    out = line_spread.remove_lines(line_docs, spread)
    assert out.columns == line_docs.columns
    empty = line_docs.limit(0)
    assert line_spread.remove_lines(empty, line_spread.spread_lines(empty)).count() == 0


def test_document_of_copied_lines_stays_whole(line_docs):
    texts = {i: t for i, t, _ in cleaned(line_docs)}
    assert texts[200] == "Shared notice."
    assert "Shared notice." not in texts[3]


def raked(cells, targets, share, sweeps=50):
    """The same fit with plain loops."""
    total = sum(cells.values())
    live = {c: t / total for c, t in cells.items() if t}
    for _ in range(sweeps):
        for d, goal in enumerate(targets):
            margin = Counter()
            for c, w in live.items():
                margin[c[d]] += w
            present = sum(goal.get(k, 0.0) for k, m in margin.items() if m > 0)
            live = {c: w * goal.get(c[d], 0.0) / present / margin[c[d]] if margin[c[d]] else 0.0 for c, w in live.items()}
    ratio = {c: w / (cells[c] / total) for c, w in live.items()}
    level = share
    for _ in range(len(cells) + 1):
        capped = sum(cells[c] for c, r in ratio.items() if level * r >= 1)
        rest = sum(cells[c] * r for c, r in ratio.items() if level * r < 1)
        level = (share * total - capped) / rest if rest else level
    return {c: min(1.0, level * ratio[c]) if cells[c] else share for c in cells}


def test_cell_probabilities_match_plain_raking(spark):
    rng = random.Random(2)
    targets = {
        "a": {"x": 0.5, "y": 0.3, "gone": 0.1, "*": 0.1},
        "b": {"p": 0.7, "q": 0.3},
        "c": {"u": 0.25, "v": 0.75},
    }
    cells = {(a, b, c): rng.randrange(1, 1000) for a in ("x", "y", "*") for b in "pq" for c in "uv"}
    cells["x", "p", "u"] = 0
    frame = spark.createDataFrame([(*k, n) for k, n in cells.items()], "a string, b string, c string, tokens long")
    for share in (0.3, 0.9):
        rows = mixing.cell_probabilities(frame, targets, share).collect()
        got = {(r.a, r.b, r.c): r.probability for r in rows}
        expected = raked(cells, list(targets.values()), share)
        assert got.keys() == expected.keys()
        assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)
        kept = sum(got[k] * n for k, n in cells.items())
        assert abs(kept - share * sum(cells.values())) < 1e-6 * kept


def test_decisions_on_odd_rows(make_docs):
    docs = make_docs(
        [(i, "some words here " * (i % 7), "en", f"src{i % 3}") for i in range(300)]
        + [(None, None, None, None), (5, "", "xx", "else"), (7, "w " * 50_000, "fr", "src1")]
    )
    targets = {"source": {"src0": 0.2, "src1": 0.7, "*": 0.1}, "lang": {"en": 0.9, "*": 0.1}}

    def run(rows):
        return mixing.decisions(
            rows,
            targets,
            {"source": frames.field("source"), "lang": frames.field("lang")},
            mixing.n_tokens(frames.field("text")),
            frames.field("doc_id"),
        )

    out = run(docs)
    rows = out.select(frames.field("doc_id").alias("id"), frames.field("text").alias("t"), "_tokens", "_probability", "_kept", "_cell.*").collect()
    assert len(rows) == docs.count()
    assert all(r._tokens == len(words(r.t)) for r in rows)
    assert {r.source for r in rows} == {"src0", "src1", "*"} and {r.lang for r in rows} == {"en", "*"}
    assert frames.unpacked(out, docs.columns).columns == docs.columns
    assert run(docs.limit(0)).count() == 0
    by_id = defaultdict(set)
    for r in rows:
        if r.source == "src0" and r.lang == "en":
            by_id[r.id].add(r._kept)
    assert all(len(v) == 1 for v in by_id.values())


def test_topics(spark):
    texts = [None, "", "Released under the MIT License.", "a | b", "see 7", "prose"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(mixing.topic_of(F.col("t"))).collect()]
    assert got == ["prose", "prose", "licence", "table", "figures", "prose"]


def best_fit(lengths, sources, clusters, capacity, quota):
    """Best fit by looking at every bin for every piece."""
    bins, placed = [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        fits = [
            (b["room"], n)
            for n, b in enumerate(bins)
            if b["room"] >= length and b["sources"][source] < quota and (cluster < 0 or cluster not in b["clusters"])
        ]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append({"room": capacity, "sources": Counter(), "clusters": set(), "n": 0})
        b = bins[n]
        placed.append((n, b["n"]))
        b["room"] -= length
        b["sources"][source] += 1
        b["clusters"].add(cluster)
        b["n"] += 1
    return placed


@pytest.mark.parametrize("seed", range(6))
def test_packing_is_best_fit(seed):
    rng = random.Random(seed)
    n = 300
    lengths = sorted((rng.randrange(1, 101) for _ in range(n)), reverse=True)
    sources = [0 if rng.random() < 0.4 else rng.randrange(5) for _ in range(n)]
    clusters = [rng.randrange(20) if rng.random() < 0.5 else -1 for _ in range(n)]
    assert packing.pack_group(lengths, sources, clusters, 100, 3) == best_fit(lengths, sources, clusters, 100, 3)


def test_packed_documents_are_whole_and_without_conflicts(make_docs):
    rng = random.Random(4)
    rows = [(i, f"w{i % 50} " * rng.randrange(0, 120), "en", f"s{i % 3 if i % 2 else 0}") for i in range(500)]
    rows += [(900, "long " * 1234, "en", "s1"), (901, None, None, None), (None, "a b c", "en", None)]
    rows += [(3, "same text here", "en", "s1")] * 3
    docs = make_docs(rows)
    count = mixing.n_tokens(F.col("text"))
    packed = packing.pack(
        docs, count, F.col("doc_id"), F.col("source"), F.xxhash64("text"), capacity=100, bins_per_group=20
    )
    out = packed.collect()
    size = {i: len(words(t)) for i, t, *_ in rows}
    spans = defaultdict(list)
    for r in out:
        spans[r.doc_id].append((r.start_token, r.n_tokens))
    for id_ in set(size) - {3}:
        at = 0
        for start, n in sorted(spans[id_]):
            assert start == at
            at += n
        assert at == size[id_]
    assert len(spans[3]) == 4
    bins = defaultdict(list)
    for r in out:
        if r.bin is not None:
            bins[r.bin_group, r.bin].append(r)
        else:
            assert r.n_tokens == 0
    text = {i: t for i, t, *_ in rows}
    for members in bins.values():
        assert sum(r.n_tokens for r in members) <= 100
        assert max(Counter(r.source for r in members).values()) <= 4
        assert sorted(r.slot for r in members) == list(range(len(members)))
        own = [text[r.doc_id] for r in members]
        assert len(set(own)) == len(own)
    assert packing.pack(docs.limit(0), count, F.col("doc_id"), F.col("source"), F.lit(None)).count() == 0


def test_near_copies_share_no_bin(spark, make_docs, tmp_path):
    rng = random.Random(3)
    first = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(60):
        # Near copies: one changed word, and other white space.
        copy = [*first[:60], f"x{i}", *first[61:]]
        rows.append((i, ("  " if i % 2 else " ").join(copy), "en", f"s{i}"))
        rows.append((100 + i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(30)), "en", f"t{i}"))
    rows += [(300, None, "en", "s0"), (301, "", "en", None), (302, "null source", "en", None), (None, "no id", "en", "s")]
    rows += rows[:2]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.op3_best_fit_packing(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in out) == sorted((r[0] or -1, len(words(r[1]))) for r in rows)
    classes = near_classes({r[0]: r[1] for r in rows if r[0] is not None})
    assert len({classes[i][0] for i in range(60)}) == 1
    bins = [(r.bin_group, r.bin, classes[r.doc_id][0]) for r in out if r.doc_id is not None and r.n_tokens]
    assert len(bins) == len(set(bins))
