"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickfolio.session import write_and_reread

WORD_BREAK = r"[\x20\x09-\x0D]+"
LAST_ID = (1 << 63) - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_or_last(name: str) -> Column:
    """A null id counts as later than all others."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST_ID))


def row_key(id_col: str, text_col: str) -> Column:
    """The same for rows that share id and text; rows that share only one of the two differ."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col).cast("long"), F.col(text_col).isNull(), F.col(text_col))


def bounded(docs: DataFrame, rows: int = 500) -> DataFrame:
    """Texts go to Python workers in batches of so many rows at most, so that a worker holds a few megabytes at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(docs.sparkSession.conf.get(name)) <= rows:
        docs.sparkSession.conf.set(name, str(rows))
    return docs


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage at a table in the shared folder."""
    return write_and_reread(df, name)
