"""Partitioned tables: contract check, latest and as-of partitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from brickfolio import contracts as C
from brickfolio.functions import columns as X


def schema_contract(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per expected column: its type against the contract and its null count."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    counts = df.agg(*[
        (F.count_if(F.col(f.name).isNull()) if f.name in have else F.lit(None).cast("bigint")).alias(f.name)
        for f in expected])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("expected_type"),
                 F.lit(have.get(f.name)).alias("actual_type"), F.col(f.name).alias("null_rows")) for f in expected])
    return counts.select(F.inline(rows)).withColumn(
        "status", F.when(F.col("expected_type") == F.col("actual_type"), "PASS").otherwise("FAIL"))


def read_panel(spark: SparkSession, root: str) -> DataFrame:
    """The day-partitioned price panel: one scan of all partitions, one schema."""
    rows = spark.read.parquet(root)
    C.require_columns(rows, [f.name for f in C.PANEL_SCHEMA], root)
    return rows.withColumn("ticker", X.upper_trim("ticker")).withColumns({c: X.no_nan(c) for c in C.PRICES}).select(
        [F.col(f.name).cast(f.dataType) for f in C.PANEL_SCHEMA])


def read_registry(spark: SparkSession, path: str | None) -> DataFrame:
    """The decision registry from CSV; no path gives an empty table of the same schema."""
    if path is None:
        return spark.createDataFrame([], C.REGISTRY_SCHEMA)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in C.REGISTRY_SCHEMA])
    return typed_registry(spark.read.csv(path, header=True, schema=text, enforceSchema=False))


def typed_registry(rows: DataFrame) -> DataFrame:
    upper = ("ticker", "review_status", "event_type")
    out = []
    for f in C.REGISTRY_SCHEMA:
        if isinstance(f.dataType, T.DateType):
            c = X.to_day(f.name)
        elif isinstance(f.dataType, T.DoubleType):
            c = X.to_double(f.name)
        else:
            c = X.upper_trim(f.name) if f.name in upper else F.trim(f.name)
        out.append(c.alias(f.name))
    return rows.select(out)


def latest_partition(df: DataFrame, column: str, as_of: date | None = None) -> DataFrame:
    """Rows of the last value of the partition column, at or before ``as_of``.

    The value comes from a scalar subquery; on a partition column Spark prunes
    the scan to that partition.
    """
    versions = df if as_of is None else df.filter(F.col(column) <= F.lit(as_of))
    return df.filter(F.col(column) == versions.agg(F.max(column)).scalar())
