"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings that the operators rely on.
SQL_SETTINGS = {
    # dates and hour fields must not depend on the machine
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a side already hashed by ticker may join on (ticker, trade_date) as it
    # stands; a ticker has at most one row per session, so this cannot skew
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a row may be a whole archive: a Python worker takes no more than about one of them at a time
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # a row of the price chain is some forty times as large in a sort as it is compressed in a shuffle
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # generated methods above the JVM's limit for compiling are never compiled;
    # wide rows run faster through the split methods that take their place
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "brickfolio", master: str | None = None, **options: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    start = {"spark.python.sql.dataFrameDebugging.enabled": "false"}  # call sites per column cost driver time
    for key, value in {**start, **SQL_SETTINGS, **options}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="brickfolio-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_and_reread(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a written table, which survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
