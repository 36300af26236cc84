"""The registered corpus queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import check_queries  # noqa: E402
import corpus_pipeline  # noqa: E402
from brute import SF_DIR, near_classes, spread_cleaned, words  # noqa: E402
from tabaudit.llm import oracle, queries  # noqa: E402

ALL = {f"op{n}_" for n in range(1, 14)}


def test_all_operators_and_the_pipeline_are_registered():
    names = set(queries.all_queries())
    assert {n.split("_")[0] + "_" for n in names - {"pipeline"}} == ALL and "pipeline" in names
    assert set(queries.all_sql()) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join",
        "mixing sources to target weights", "best-fit packing",
    ]


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_query_matches_sql(spark, name):
    ok, note, _, rows = check_queries.compare(spark, check_queries.sql_connection(SF_DIR), SF_DIR, name)
    assert ok, note
    assert rows > 0


def test_native_queries_run_no_python(spark):
    for name in ("op4_url_filters", "op9_line_spread", "op10_mixing"):
        plan = queries.all_queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct")), name


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_pipeline_stages(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    docs = documents
    good = stages["quality rules"](spark, docs, SF_DIR)
    assert good.columns == docs.columns
    con = check_queries.sql_connection(SF_DIR)
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({oracle.QUALITY_RULES}) WHERE kept").fetchall()}
    assert rows_of(good) == [r for r in rows_of(docs) if r[0] in kept]

    lines = stages["line dedup"](spark, good, SF_DIR)
    assert lines.columns == docs.columns
    texts = dict(spread_cleaned([(r.doc_id, r.text, r.source) for r in good.collect()]))
    assert {r.doc_id: r.text for r in lines.collect()} == texts
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    near = stages["n-gram Jaccard join"](spark, lines, SF_DIR)
    first = {c for c, _ in near_classes({r.doc_id: r.text for r in lines.collect()}).values()}
    assert rows_of(near) == [r for r in rows_of(lines) if r[0] in first]

    mixed = stages["mixing sources to target weights"](spark, near, SF_DIR)
    assert mixed.columns == docs.columns
    assert set(rows_of(mixed)) <= set(rows_of(near))

    packed = stages["best-fit packing"](spark, mixed, SF_DIR)
    total = {}
    for r in packed.collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    assert total == {r.doc_id: len(words(r.text)) for r in mixed.collect()}


def test_mixing_stage_matches_sql(spark):
    # The stage's step alone, over the documents themselves.
    con = check_queries.sql_connection(SF_DIR)
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({oracle.MIXING}) WHERE kept").fetchall()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, SF_DIR).collect()} == kept


def test_run_is_the_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert rows_of(corpus_pipeline.run(spark, SF_DIR)) == rows_of(docs)
