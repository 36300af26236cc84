from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import base_counts
from tabaudit.llm import quality_rules

GOOD = " ".join(f"word{i % 37} other{i % 41} thing{i}" for i in range(60))


@pytest.fixture(scope="module")
def edge_docs(make_docs):
    texts = [
        None, "", " \n\t ", "one two three", GOOD, GOOD, "spam $$$ " * 200, "a\nb\na\n a\n" * 30,
        "x " * 100_000, "é ü # <b> & | %\x0bend\x1fnot a blank\xa0here",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, GOOD), (None, GOOD)]
    rows += [(100 + i, GOOD + f" tail{i} " * (i % 5)) for i in range(60)]
    return make_docs(rows)


def test_base_counts_match_plain_version(spark, documents, edge_docs):
    for docs in (documents, edge_docs):
        rules = quality_rules.QualityRules(np.zeros(8, np.int64), 0.0)
        rows = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rules.scores(docs).collect()}
        assert rows == {(r.doc_id, *base_counts(r.text)) for r in docs.select("doc_id", "text").collect()}


def test_keep_agrees_with_verdicts_and_keeps_columns(spark, edge_docs):
    trusted = spark.createDataFrame([(i,) for i in [4, *range(100, 160), None]], "id long")
    rules, scores = quality_rules.fit(edge_docs, trusted)
    verdicts = rules.verdicts(scores)
    kept = rules.keep(edge_docs)
    assert kept.columns == edge_docs.columns
    want = sorted(r.doc_id or -1 for r in verdicts.filter("kept").collect())
    assert sorted(r.doc_id or -1 for r in kept.collect()) == want
    assert {4, 5, 100, 159} <= set(want) and not {0, 1, 2, 3, 6, 7, 8, 9} & set(want)
    assert want.count(4) == 2  # both of the repeated rows


def test_without_trusted_or_documents(spark, edge_docs):
    nobody = spark.createDataFrame([], "id long")
    rules, scores = quality_rules.fit(edge_docs, nobody)
    assert rules.verdicts(scores).filter("kept = base_failed").count() == 0
    rules, scores = quality_rules.fit(edge_docs.limit(0), nobody)
    assert scores.count() == 0 and rules.keep(edge_docs.limit(0)).count() == 0


def test_score_separates_junk(spark, make_docs):
    junk = " ".join(f"QQ{i}!!" for i in range(300))
    docs = make_docs([(i, GOOD + f" tail{i}") for i in range(80)] + [(500, junk)])
    trusted = docs.filter("doc_id < 80").select("doc_id")
    rules, scores = quality_rules.fit(docs, trusted)
    out = {r.doc_id: r.kept for r in rules.verdicts(scores).collect()}
    assert not out[500] and all(out[i] for i in range(80))
    again = rules.verdicts(quality_rules.fit(docs.repartition(7), trusted)[1])
    assert {(r.doc_id, r.score) for r in again.collect()} == {
        (r.doc_id, r.score) for r in rules.verdicts(scores).collect()
    }
    assert scores.select(F.max("n_grams")).first()[0] == 2 * max(base_counts(r.text)[0] for r in docs.collect()) - 1
