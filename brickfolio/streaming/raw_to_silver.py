"""New raw files to silver partitions, each file once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from brickfolio.operators.publish import with_date_parts

PARTITION = ["year", "month", "day"]


def raw_to_silver(rows: DataFrame, path: str, date_column: str = "trade_date") -> DataFrame:
    """Write the day partitions the rows belong to; other days keep their files."""
    parts = with_date_parts(rows, date_column)
    (parts.hint("rebalance", *PARTITION).sortWithinPartitions(*PARTITION, "ticker")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION).parquet(path))
    return rows.sparkSession.read.schema(parts.schema).parquet(path).select(rows.columns)


def stream_raw_to_silver(spark: SparkSession, source: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame],
                         target: str, checkpoint: str, file_format: str = "parquet", day: Column | str = "trade_date",
                         key: list[str] | None = None, landing: str | None = None) -> DataFrame:
    """Process every file not seen before, then stop. No row is lost however a day is spread over files, batches and runs.

    Raw rows are first appended to ``landing`` under their batch and day; a batch that runs twice replaces only what it wrote before. Then
    the days that the batch touches are rebuilt from all their raw rows. ``day`` is the raw row's date, and ``key``, if given, says which raw
    rows restate each other: the one of the latest batch counts. Rows without a date belong to no day: they stay in ``landing``, where
    ``undated_rows`` finds them.
    """
    landing = landing or f"{target.rstrip('/')}-raw"
    reader = spark.readStream.format(file_format).schema(schema)

    def land(batch: DataFrame, batch_id: int) -> None:
        raw = batch.withColumns({"__batch": F.lit(batch_id), "__day": (F.col(day) if isinstance(day, str) else day).cast("date")})
        (raw.hint("rebalance", "__day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("__batch", "__day").parquet(landing))
        landed = spark.read.schema(raw.schema).parquet(landing)
        # one row per day of the batch; the scan below reads those days only
        touched = landed.filter((F.col("__batch") == batch_id) & F.col("__day").isNotNull()).select("__day").distinct()
        rows = landed.join(F.broadcast(touched), "__day", "left_semi")
        if key:
            last = rows.groupBy(*key).agg(F.max("__batch").alias("__batch"))
            rows = rows.join(last, [*key, "__batch"], "left_semi")
        raw_to_silver(transform(rows.select(*batch.columns)), target)

    query = (reader.load(source).writeStream.foreachBatch(land)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(target)


def undated_rows(spark: SparkSession, landing: str) -> DataFrame:
    """Raw rows that no day was built from, with their batch."""
    return spark.read.parquet(landing).filter(F.col("__day").isNull()).drop("__day")
