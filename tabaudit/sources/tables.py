"""Table scans by preference, the two-format sink, and ingestion."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tabaudit.functions.values import present, row_digest
from tabaudit.operators.cleaning import quoted, replace_columns
from tabaudit.operators.profile import class_distribution
from tabaudit.session import materialize

log = logging.getLogger(__name__)

ROW_ID = "row_id"

# Both ways: quotes are doubled, blanks at the ends of a field belong to it.
_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    """CSV with a header row; an empty field is null. The schema is never inferred.

    Files are split between tasks unless ``multi_line`` allows line breaks inside
    quoted fields. A record broken by one otherwise raises an error.
    """
    reader = spark.read.schema(schema).options(**_CSV, mode="FAILFAST", multiLine=multi_line)
    return reader.csv(path)


def read_csv_quarantined(
    spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the broken records as (raw, file, reason), from one parse.

    The reason is ``fields`` where a record has another number of fields than the
    schema, else ``value of`` and the first column whose text is not of its type. Records
    are lines: a line break inside a quoted field breaks the record in two.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw, file = _unused("_raw", schema.names), _unused("_file", schema.names)
    options = {**_CSV, "header": header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": raw}
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(raw, T.StringType())]))
    # Both tables are read from what one parse has written.
    parsed = materialize(
        reader.options(**options).csv(path).withColumn(file, F.col("_metadata.file_path")), "csv"
    )
    good = parsed.filter(F.col(raw).isNull()).select(*map(quoted, schema.names))
    names = (c.replace("`", "``") for c in [*schema.names, raw])
    texts = ", ".join(f"`{c}` string" for c in names)
    text_options = {k: str(v) for k, v in options.items() if k != "header"}
    bad = parsed.filter(F.col(raw).isNotNull()).withColumn(
        "texts", F.from_csv(F.col(raw), texts, text_options)
    )
    reason = F.when(F.col("texts").getField(raw).isNotNull(), "fields")
    for name in schema.names:
        unread = quoted(name).isNull() & F.col("texts").getField(name).isNotNull()
        reason = reason.when(unread, F.lit(f"value of {name}"))
    return good, bad.select(
        F.col(raw).alias("raw"), F.col(file).alias("file"), reason.otherwise("record").alias("reason")
    )


def quarantine_counts(
    spark: SparkSession, path: str, good: DataFrame, bad: DataFrame, header: bool = True
) -> DataFrame:
    """(n_read, n_good, n_bad, reconciles); the lines are counted without the parser."""
    lines = spark.read.text(path).filter(F.length("value") > 0)
    heads = F.count_distinct(F.col("_metadata.file_path")) if header else F.lit(0)
    read = lines.agg((F.count(F.lit(1)) - heads).alias("n"))
    parts = (read.select(F.lit("read").alias("part"), "n")).unionByName(
        good.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("good"))
    ).unionByName(bad.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("bad")))
    counts = parts.agg(
        *[F.sum(F.when(F.col("part") == p, F.col("n"))).alias(f"n_{p}") for p in ("read", "good", "bad")]
    )
    return counts.withColumn("reconciles", F.col("n_read") == F.col("n_good") + F.col("n_bad"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes null."""
    floats = [f for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return replace_columns(df, {f.name: present(quoted(f.name), f.dataType) for f in floats})


def read_table(
    spark: SparkSession,
    base: str,
    schema: T.StructType | str | None = None,
    prefer: Sequence[str] = ("parquet", "csv"),
) -> DataFrame:
    """``base.parquet`` or ``base.csv``, whichever comes first in ``prefer`` and exists."""
    for kind in prefer:
        path = f"{base}.{kind}"
        try:
            if kind == "parquet":
                return nan_to_null(read_parquet(spark, path))
            if schema is None:
                raise ValueError(f"reading {path} needs a schema")
            spark.read.text(path)  # resolves the path without reading it
            return nan_to_null(read_csv(spark, path, schema))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no {' or '.join(prefer)} table at {base}")


def _is_file_error(error: BaseException) -> bool:
    """Whether the format or the storage, not the data, made a write fail."""
    if isinstance(error, (OSError, AnalysisException)):
        return True
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        name = cause.getClass().getName()
        if name.startswith(("java.io.", "java.nio.file.", "org.apache.hadoop.")):
            return True
        cause = cause.getCause()
    return False


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def write_table(df: DataFrame, base: str) -> list[str]:
    """Write Parquet, then CSV; the file system may refuse one of the two.

    The CSV is written from the landed Parquet, so ``df`` is computed once. An error
    in computing ``df`` is raised at once: writing CSV would only compute it again.
    """
    parquet, csv = f"{base}.parquet", f"{base}.csv"
    written = []
    try:
        df.write.mode("overwrite").parquet(parquet)
        written.append(parquet)
    except Exception as error:
        if not _is_file_error(error):
            raise
        log.warning("writing %s failed, trying CSV only: %s", parquet, error)
    try:
        source = df.sparkSession.read.schema(df.schema).parquet(parquet) if written else df
        write_csv(source, csv)
        written.append(csv)
    except Exception as error:
        log.error("writing %s failed: %s", csv, error)
        if not written or not _is_file_error(error):
            raise
    return written


def with_row_id(df: DataFrame, key: str | None = None) -> DataFrame:
    """Add ``row_id``: the business key, else one that follows from the row's content alone."""
    if key is not None:
        return df.withColumn(ROW_ID, quoted(key))
    return with_content_id(df, ROW_ID)


def with_content_id(df: DataFrame, out: str) -> DataFrame:
    """Add a text id: the 256-bit digest of the row, and its number among equal rows.

    The same rows get the same ids however they are stored and dealt out; which of
    several equal rows has which number is of no matter. Only rows that occur more than
    once are numbered, each input partition for itself and from where the partitions before
    it end, so that a row that fills a third of the table is numbered by many tasks.
    """
    columns = df.columns
    digest, part, number = (_unused(n, columns) for n in ("_digest", "_part", "_number"))
    placed = materialize(
        df.withColumns(
            {digest: F.lower(F.hex(row_digest(df.schema, columns))), part: F.spark_partition_id()}
        ),
        "digests",
    )
    parts = placed.groupBy(digest, part).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(digest)
    earlier = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col(digest).alias("_d"),
        F.col(part).alias("_p"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("n").over(whole).alias("_all"),
    )
    repeated = materialize(parts.filter("_all > 1"), "repeated-rows").drop("_all")
    joined = placed.join(repeated, (F.col(digest) == F.col("_d")) & (F.col(part) == F.col("_p")), "left")
    joined = joined.withColumn(number, F.col("_before")).drop("_d", "_p", "_before")
    lone = joined.filter(F.col(number).isNull()).withColumn(number, F.lit(0).cast("long"))
    # Any order does: the rows of a window are equal.
    within = Window.partitionBy(digest, part).orderBy(digest)
    copies = joined.filter(F.col(number).isNotNull()).withColumn(
        number, F.col(number) + F.row_number().over(within) - 1
    )
    named = lone.unionByName(copies).select(
        *map(quoted, columns), F.concat(digest, F.lit("-"), F.col(number).cast("string")).alias(out)
    )
    # Feature and target tables are read from one and the same numbering.
    return materialize(named, "content-ids")


def _unused(name: str, columns: Sequence[str]) -> str:
    while name.lower() in {c.lower() for c in columns}:
        name = "_" + name
    return name


def split_source(
    source: DataFrame, features: Sequence[str], target: str, key: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Feature and target tables that share ``row_id``; missing columns are an error."""
    missing = [c for c in [*features, target] if c not in source.columns]
    if missing:
        raise ValueError(f"source has no column {', '.join(missing)}")
    keyed = with_row_id(source, key)
    return (
        keyed.select(ROW_ID, *map(quoted, features)),
        keyed.select(ROW_ID, quoted(target)),
    )


def ingest_summary(source: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(label, n, pct, n_features): rows per class, their share, and the table's width."""
    return class_distribution(source, target).withColumn("n_features", F.lit(len(features)))


def ingest(
    source: DataFrame, out_dir: str, features: Sequence[str], target: str, key: str | None = None
) -> dict:
    """Land features, target and rows per class in both formats and describe them.

    ``target_dist`` is the table of rows per class, however many classes there are.
    """
    feature_table, target_table = split_source(source, features, target, key)
    written = write_table(feature_table, f"{out_dir}/features")
    written += write_table(target_table, f"{out_dir}/targets")
    classes = class_distribution(target_table, target)
    written += write_table(classes, f"{out_dir}/classes")
    stored = source.sparkSession.read.parquet(f"{out_dir}/classes.parquet")
    totals = stored.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes")).first()
    return {
        "n_rows": totals["n"] or 0,
        "n_features": len(features),
        "n_classes": totals["classes"],
        "target_dist": stored.select("label", "n"),
        "written_files": written,
        "output_dir": out_dir,
    }


def load_data(
    spark: SparkSession,
    raw_dir: str,
    processed_dir: str | None = None,
    feature_schema: T.StructType | str | None = None,
    target_schema: T.StructType | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Features and targets: processed tables where they exist, else the raw ones."""

    def first(name: str, schema):
        if processed_dir is not None:
            try:
                return read_table(spark, f"{processed_dir}/{name}_processed", prefer=("parquet",))
            except FileNotFoundError:
                pass
        return read_table(spark, f"{raw_dir}/{name}", schema)

    return first("features", feature_schema), first("targets", target_schema)
