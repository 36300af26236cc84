"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the stage before it kept, as read back from its
table, and all but the last return the columns of ``documents``. Columns beyond these
pass through every stage but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabaudit.llm import frames, jaccard_join, line_spread, mixing, packing, quality_rules, settings
from tabaudit.session import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trusted = labels.filter("quality = 1").select("doc_id")
    rules, _ = quality_rules.fit(docs, trusted)
    return rules.keep(docs)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are spread over many sites; ``n_chars`` follows the text."""
    spread = line_spread.spread_lines(docs)
    cleaned = line_spread.remove_lines(docs, spread, removed_col="_n_removed")
    n_chars = F.when(F.col("_n_removed") > 0, F.char_length("text").cast("long"))
    return cleaned.withColumn("n_chars", n_chars.otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest id."""
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that their tokens meet the target weights."""
    text = frames.field("text")
    mixed = mixing.decisions(
        docs,
        settings.MIX_TARGETS,
        values={
            "source": frames.field("source"),
            "lang": frames.field("lang"),
            "topic": mixing.topic_of(text),
        },
        tokens=mixing.n_tokens(text),
        id_=frames.field("doc_id"),
    )
    return frames.unpacked(mixed.filter("_kept"), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token spans of the documents in bins of fixed capacity."""
    return packing.pack(
        docs,
        n_tokens=mixing.n_tokens(F.col("text")),
        id_=F.col("doc_id"),
        source=F.col("source"),
        cluster=F.xxhash64("text"),
    )


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_boilerplate),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# SQL cannot express best-fit packing; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage before it is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1], 1):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
