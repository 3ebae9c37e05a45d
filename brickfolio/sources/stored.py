"""Stored tables: partitions known from their listing, and delimited files with good and bad records told apart."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from brickfolio.contracts import ContractError
from brickfolio.functions import columns as X


# --- partitions ---------------------------------------------------------------

def partition_listing(spark: SparkSession, root: str) -> DataFrame:
    """The files of a partitioned table with their partition values and lengths; no file is opened."""
    files = spark.read.format("binaryFile").load(root)
    return files.select(*[c for c in files.columns if c not in ("content", "modificationTime")])


def _day(columns: list[str], column: str | None) -> Column:
    """The business date of a partition: a column of dates, or year, month and day."""
    if column:
        return F.col(column).cast("date")
    if not {"year", "month", "day"} <= set(columns):
        raise ContractError(f"no business date among the partition columns {columns}")
    return F.make_date("year", "month", "day")


def latest_stored(spark: SparkSession, root: str, as_of: date | None = None, column: str | None = None) -> DataFrame:
    """Rows of the last business date at or before ``as_of``. The date comes from the listing, so the scan names its partition outright."""
    listing = partition_listing(spark, root)
    days = listing.select(_day(listing.columns, column).alias("d"))
    last = (days if as_of is None else days.filter(F.col("d") <= F.lit(as_of))).agg(F.max("d")).first()[0]
    if last is None:
        raise ContractError(f"{root} has no partition" + (f" up to {as_of}" if as_of else ""))
    rows = spark.read.parquet(root)
    if column:
        return rows.filter(F.col(column) == F.lit(last).cast(rows.schema[column].dataType))
    return rows.filter((F.col("year") == last.year) & (F.col("month") == last.month) & (F.col("day") == last.day))


def latest_objects(spark: SparkSession, root: str, source: str, column: str, as_of: date | None = None) -> DataFrame:
    """Per source the last date at or before ``as_of`` with its files and bytes, from the listing alone."""
    listing = partition_listing(spark, root).withColumn("partition_date", F.col(column).cast("date"))
    known = listing if as_of is None else listing.filter(F.col("partition_date") <= F.lit(as_of))
    per_day = known.groupBy(F.col(source).alias("source"), "partition_date").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    return per_day.groupBy("source").agg(F.max_by(F.struct("files", "bytes"), "partition_date").alias("s"), F.max("partition_date").alias("partition_date")).select(
        "source", "partition_date", "s.files", "s.bytes")


# --- delimited files -----------------------------------------------------------

def typed_or_rejected(rows: DataFrame, schema: T.StructType, key: tuple[str, ...] = (), upper: tuple[str, ...] = (), record: str | None = None) -> DataFrame:
    """Text columns by their contract, with ``reject_reason``: null, or the first of MALFORMED, MISSING_<key>, BAD_<column>.

    A value is bad if it is there and not of its type. ``record`` names the column that holds the text of malformed records.
    """
    typed, reason = {}, F.when(F.col(record).isNotNull(), "MALFORMED") if record else F.when(F.lit(False), "")
    for f in schema:
        text = F.trim(F.col(f.name).cast("string"))
        if isinstance(f.dataType, T.DateType):
            typed[f.name] = X.to_day(text)
        elif isinstance(f.dataType, T.DoubleType):
            typed[f.name] = X.to_double(text)
        elif isinstance(f.dataType, T.StringType):
            typed[f.name] = F.nullif(F.upper(text) if f.name in upper else text, F.lit(""))
        else:
            typed[f.name] = text.try_cast(f.dataType)
    for c in key:
        reason = reason.when(X.blank(F.col(c).cast("string")), f"MISSING_{c.upper()}")
    for f in schema:
        if not isinstance(f.dataType, T.StringType):
            reason = reason.when(~X.blank(F.col(f.name).cast("string")) & typed[f.name].isNull(), f"BAD_{f.name.upper()}")
    return rows.select(*[c.alias(n) for n, c in typed.items()], reason.alias("reject_reason"), *([F.col(record).alias("record")] if record else []))


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType, key: tuple[str, ...] = (), upper: tuple[str, ...] = (), sep: str = ",",
                     pattern: str = "*") -> DataFrame:
    """One scan of delimited files with a header: typed columns, ``reject_reason``, and ``record``, the text of malformed lines."""
    text = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema], T.StructField("_record", T.StringType())])
    # every column is parsed, or a line that lacks one would pass where that one is not asked for
    rows = (spark.read.option("header", True).option("columnPruning", False).option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record")
            .option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).schema(text).csv(path))
    return typed_or_rejected(rows, schema, key, upper, "_record")


def good_records(checked: DataFrame) -> DataFrame:
    return checked.filter("reject_reason is null").drop("reject_reason", "record")


def rejected_records(checked: DataFrame) -> DataFrame:
    return checked.filter("reject_reason is not null")
