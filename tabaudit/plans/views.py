"""Derived views over the test tables: a dirty table, scored tables, and features.

The test tables hold no nulls and no labels. These views derive both with integer
arithmetic that any SQL engine repeats exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with missing-value spellings, nulls, blanks and trailing dots."""
    key = F.col("c_custkey")
    seg = (
        F.when(key % 7 == 0, "?")
        .when(key % 11 == 0, " ?")
        .when(key % 13 != 0, F.concat(F.lit(" "), "c_mktsegment", F.lit("..")))
    )
    label = F.when(
        F.col("c_acctbal") > 5000, F.when(key % 2 == 0, " >50K.").otherwise(">50K")
    ).otherwise(F.when(key % 2 == 0, "<=50K.").otherwise("<=50K"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        seg.alias("seg_raw"),
        label.alias("label_raw"),
        F.when(key % 17 != 0, F.col("c_acctbal")).alias("bal_null"),
        "c_nationkey",
    )


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as lines of CSV without a header; every few of them are broken in one of three ways."""
    key = F.col("c_custkey")
    nation = F.when(key % 17 == 0, "n/a").otherwise(F.col("c_nationkey").cast("string"))
    whole = F.concat_ws(",", key.cast("string"), "c_name", nation)
    short = F.concat_ws(",", key.cast("string"), "c_name")
    line = F.when(key % 19 == 0, F.concat(whole, F.lit(",more"))).when(key % 23 == 0, short).otherwise(whole)
    return table(spark, sf_dir, "customer").select(line.alias("value"))


def _is_costly() -> Column:
    noise = (F.col("o_orderkey") * 31) % 21 - 10
    return (F.col("o_totalprice") / 10000 + noise > 25).cast("int")


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with truth, prediction, score and age; one table, no join."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("sex"),
        (F.col("o_orderkey") % 103).alias("age"),
        _is_costly().alias("y_true"),
        (F.col("o_totalprice") >= 250000).cast("int").alias("y_pred"),
        (F.col("o_totalprice") / 500000).alias("y_proba"),
    )


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their region. Nations and regions are joined as the planner sees fit."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )


def scored_orders_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scored_orders`` with the customer's region as ``race``."""
    regions = customer_regions(spark, sf_dir).select("c_custkey", F.col("r_name").alias("race"))
    return (
        scored_orders(spark, sf_dir)
        .join(regions, F.col("custkey") == F.col("c_custkey"))
        .drop("custkey", "c_custkey")
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents scored by length: many small groups, and tied scores."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.concat("lang", F.lit("/"), "source").alias("origin")
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y_true"))
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"),
        "origin",
        "y_true",
        (F.col("n_chars") >= 1000).cast("int").alias("y_pred"),
        (F.least("n_chars", F.lit(4000)) / 4000).alias("y_proba"),
    )


NUM_FEATURES = ["o_totalprice", "c_acctbal", "n_items", "qty_sum", "disc_avg"]
CAT_FEATURES = ["o_orderstatus", "o_orderpriority", "c_mktsegment", "r_name"]


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: numeric and categorical features and a 0/1 label.

    Line items are aggregated before the join. An order without any has 0 items.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.sum("l_quantity").alias("qty_sum"),
            F.avg("l_discount").alias("disc_avg"),
        )
    )
    customers = customer_regions(spark, sf_dir).select(
        "c_custkey", "c_acctbal", "c_mktsegment", "r_name"
    )
    zero = F.lit(0.0)
    return (
        table(spark, sf_dir, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("row_id"),
            "o_totalprice",
            "c_acctbal",
            F.coalesce("n_items", F.lit(0)).alias("n_items"),
            F.coalesce("qty_sum", zero).alias("qty_sum"),
            F.coalesce("disc_avg", zero).alias("disc_avg"),
            *CAT_FEATURES,
            _is_costly().alias("label"),
        )
    )


BINNED_FEATURES = ["price_bin", "priority", "status", "key_mod"]


def binned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the noisy label and features of few values, so that every cut can be listed."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.floor(F.col("o_totalprice") / 10000).cast("double").alias("price_bin"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
        F.when(status == "F", 0.0).when(status == "O", 1.0).otherwise(2.0).alias("status"),
        (F.col("o_orderkey") % 7).cast("double").alias("key_mod"),
        _is_costly().alias("label"),
    )


def gappy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in 30 numeric columns, each missing in other rows."""
    key = F.col("l_orderkey") + F.col("l_linenumber")
    kinds = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return table(spark, sf_dir, "lineitem").select(
        *[
            F.when(key % (k + 2) != 0, F.col(kinds[k % 5]) * (1 + key % (k // 5 + 1))).alias(f"x{k}")
            for k in range(30)
        ]
    )
