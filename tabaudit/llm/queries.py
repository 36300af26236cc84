"""The registered queries of this package: thin digests of its operators over whole tables."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
import tabaudit
from tabaudit.llm import (
    conversation_trie,
    fingerprints,
    frames,
    html_template,
    jaccard_join,
    kneser_ney,
    language_id,
    line_spread,
    mixing,
    oracle,
    packing,
    phrases,
    quality_rules,
    settings,
    token_files,
    url_rules,
)
from tabaudit.session import materialize, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good."""
    return table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules, scores = quality_rules.fit(docs, trusted_ids(spark, sf_dir))
    return rules.verdicts(scores).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("score", 9).alias("score"),
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_template.main_text(table(spark, sf_dir, "pages"))
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    measured = [
        mixing.n_tokens(F.col("text")).alias("n"),
        F.col("source"),
        F.monotonically_increasing_id().alias("row"),
    ]
    # Each class of near duplicates is a cluster.
    classed = materialize(jaccard_join.classed(docs, measured), "classed")
    return packing.pack(
        classed,
        n_tokens=F.col("n"),
        id_=F.col("doc_id"),
        source=F.col("source"),
        cluster=F.col("cluster"),
        row=F.col("row"),
    )


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(settings.URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.filter(~held_out))
    return model.predict(docs).withColumn("held_out", held_out)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return kneser_ney.judge(docs, trusted_ids(spark, sf_dir))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


def op9_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cleaned = line_spread.remove_lines(docs, line_spread.spread_lines(docs), removed_col="n_removed")
    return cleaned.select("doc_id", "text", "n_removed")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    measured = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", mixing.topic_of(text).alias("topic"), mixing.n_tokens(text).alias("n")
    )
    # The texts are read once; raking and sampling need only what was measured.
    mixed = mixing.decisions(
        materialize(measured, "measured"),
        settings.MIX_TARGETS,
        values={d: frames.field(d) for d in settings.MIX_TARGETS},
        tokens=frames.field("n"),
        id_=frames.field("doc_id"),
    )
    return mixed.select(
        frames.field("doc_id").alias("doc_id"),
        "_cell.source", "_cell.lang", "_cell.topic",
        F.col("_tokens").alias("n_tokens"),
        F.round("_probability", 9).alias("probability"),
        F.col("_kept").alias("kept"),
    )


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # vocabulary files, found where the library is installed

    files = token_files.write(
        table(spark, sf_dir, "documents"),
        scratch_path(spark, "token-files"),
        public_tokenizers.path("byte_bpe_50k.json"),
    )
    return files.documents().select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(
        table(spark, sf_dir, "conversations"), conversation_trie.fork_by_blocks()
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]):
    """``query``, after sending this library to workers that would not find it."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = str(Path(tabaudit.__file__).resolve().parents[1])
        context = spark.sparkContext
        on_path = root in os.environ.get("PYTHONPATH", "").split(os.pathsep)
        if not on_path and context.applicationId not in _SENT:
            folder = tempfile.mkdtemp(prefix="tabaudit-")  # the driver serves it to the workers
            context.addPyFile(shutil.make_archive(f"{folder}/tabaudit", "zip", root, "tabaudit"))
            _SENT.add(context.applicationId)
        return query(spark, sf_dir)

    return run


_SENT: set[str] = set()


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    queries = {
        "op1_quality_rules": op1_quality_rules,
        "op2_html_extraction": op2_html_extraction,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_url_filters": op4_url_filters,
        "op5_language_id": op5_language_id,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
        "op8_fingerprints": op8_fingerprints,
        "op9_line_spread": op9_line_spread,
        "op10_mixing": op10_mixing,
        "op11_token_files": op11_token_files,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_phrases": op13_phrases,
        "pipeline": corpus_pipeline.run,
    }
    return {name: _shipped(query) for name, query in queries.items()}


def all_sql() -> dict[str, str]:
    sql = {
        "op1_quality_rules": oracle.QUALITY_RULES,
        "op4_url_filters": oracle.URL_FILTERS,
        "op9_line_spread": oracle.LINE_SPREAD,
        "op10_mixing": oracle.MIXING,
        "op12_conversation_trie": oracle.CONVERSATION_TRIE,
        "op13_phrases": oracle.PHRASES,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: text for name, text in sql.items() if text}
