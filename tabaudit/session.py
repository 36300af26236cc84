"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "8", app: str = "tabaudit", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    # Worker processes import this library by the same path.
    root = str(Path(__file__).resolve().parents[1])
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *paths])
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_root(spark: SparkSession) -> str:
    """The one folder of this application on storage that driver and executors share.

    It lies in the checkpoint folder that the cluster names, else in the warehouse.
    """
    base = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tabaudit-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the application's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> bool:
    """Delete the application's scratch folder; tables that were materialized are gone then."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    return bool(path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True))


def materialize(df, name: str = "table"):
    """Write ``df`` to the scratch folder and read it back.

    Cuts lineage before iterative work: the table survives lost executors and
    is computed once however many jobs read it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
