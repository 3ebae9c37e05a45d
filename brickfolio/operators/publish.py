"""Content fingerprints, publish decisions and partitioned writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from brickfolio.contracts import RUN_TIME_COLUMNS, ContractError
from brickfolio.operators.checks import assert_passed


def _row_text(columns: list[str]):
    """Every value behind its length, so that no two rows share a text; a null has no length."""
    text = lambda c: F.col(c).cast("string")
    return F.concat(*[F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-;")) for c in columns])


def content_fingerprint(df: DataFrame, partition: list[str]) -> DataFrame:
    """Logical content hash per partition: no order, no run times.

    Each row is hashed by itself; the hashes are combined by xor and by sum, both
    of which merge in any order, so nothing is sorted and the rows of a partition
    are pre-aggregated where they lie.
    """
    columns = sorted(c for c in df.columns if c not in RUN_TIME_COLUMNS)
    digest = F.md5(_row_text(columns))
    half = lambda start: F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")
    hashed = df.select(*partition, half(1).alias("h1"), half(16).alias("h2"))
    sums = hashed.groupBy(*partition).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"),
        F.sum(F.col("h1").cast("decimal(38,0)")).alias("s1"), F.sum(F.col("h2").cast("decimal(38,0)")).alias("s2"))
    schema = ",".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)
    text = F.concat_ws("#", F.lit(schema), *[F.col(c).cast("string") for c in ("rows", "x1", "x2", "s1", "s2")])
    return sums.select(*partition, "rows", F.sha2(text, 256).alias("content_sha256"))


def manifest_fingerprint(manifest: DataFrame) -> DataFrame:
    """Hash of each manifest row as canonical JSON without run times."""
    columns = sorted(c for c in manifest.columns if c not in RUN_TIME_COLUMNS)
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return manifest.withColumn("manifest_sha256", F.sha2(text, 256))


def publish_decision(new: DataFrame, published: DataFrame, key: list[str], force: bool = False) -> DataFrame:
    """What to do with each partition of ``new``.

    Both tables hold ``content_sha256`` and may hold ``raw_sha256`` (the bytes).
    """
    raw = "raw_sha256" in new.columns and "raw_sha256" in published.columns
    renamed = published.select(*key, F.lit(True).alias("exists"), F.col("content_sha256").alias("old_content"),
                               (F.col("raw_sha256") if raw else F.lit(None).cast("string")).alias("old_raw"))
    same_raw = F.col("raw_sha256").eqNullSafe(F.col("old_raw")) if raw else F.lit(False)
    same_content = F.coalesce(F.col("content_sha256") == F.col("old_content"), F.lit(False))
    # fixed values: the actions
    action = F.when(F.col("exists").isNull(), "UPLOAD")
    if force:
        action = action.otherwise("NEW_VERSION")
    else:
        action = action.when(same_raw, "SKIP_IDENTICAL").when(same_content, "SKIP_REPACKAGED").otherwise("BLOCK")
    return new.join(renamed, key, "left").withColumn("action", action).drop("exists", "old_content", "old_raw")


def _write(df: DataFrame, path: str, partition: list[str], order: list[str], given: list[dict[str, Column]], mode: str | None = None) -> None:
    """Ordered rows, grouped by partition, to files. Given columns take no part in the shuffle and the sort: they are put in as the rows are written, group by group."""
    rows = df.drop(*[c for group in given for c in group])
    if partition:
        rows = rows.hint("rebalance", *partition)
    # without partitions there is no shuffle: a sort by ranges would look for its bounds first and so see the rows twice
    rows = rows.sortWithinPartitions(*partition, *order)
    for group in given:
        rows = rows.withColumns(group)
    writer = rows.select(df.columns).write.mode("overwrite").option("compression", "zstd")
    if mode:
        writer = writer.option("partitionOverwriteMode", mode)
    (writer.partitionBy(*partition) if partition else writer).parquet(path)


def publish_partitioned(df: DataFrame, path: str, partition: list[str], order: list[str], given: list[dict[str, Column]] | None = None) -> DataFrame:
    """Write partitions in place and return them as read back; ``given`` as in ``publish_verified``, but not verified.

    ``rebalance`` groups the rows by partition and lets AQE split a partition
    that is much larger than the rest into several files.
    """
    _write(df, path, partition, order, given or [])
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _multiset(df: DataFrame) -> list[Column]:
    """Count, xor and sum of two hashes of each row: equal for equal rows in any order.

    A hash passes over nulls and takes both zeros for one, so it is also given which values are null and the text of a zero.
    """
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    value = lambda f: F.col(f.name).cast("string") if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) else F.col(f.name)
    zeros = [F.when(F.col(f.name) == 0, F.col(f.name).cast("string")) for f in fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    hashed = [F.xxhash64(F.lit(seed), *[F.col(f.name).isNull() for f in fields], *[value(f) for f in fields], *zeros) for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("rows"), *[F.bit_xor(h).alias(f"x{k}") for k, h in enumerate(hashed)],
            *[F.sum(h.cast("decimal(38,0)")).alias(f"s{k}") for k, h in enumerate(hashed)]]


def publish_verified(df: DataFrame, path: str, partition: list[str], order: list[str], given: dict[str, Column] | list[dict[str, Column]] | None = None) -> DataFrame:
    """Publish a whole table, partitioned or not, and make sure that what lies there is the input, row by row.

    The input is summed up while it is written; the stored files are read back and summed up in the same way. ``given`` holds groups of
    columns that have the same value in every row or follow from others of the row; a value that is not the input's own is found like any other difference.
    """
    sums, seen = _multiset(df), Observation()
    _write(df.observe(seen, *sums), path, partition, order, [given] if isinstance(given, dict) else given or [], "static" if partition else None)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    found, expected = out.agg(*sums).first().asDict(), seen.get
    if found != {k: expected[k] for k in found}:
        raise ContractError(f"published rows are not the input: {found['rows']} of {expected['rows']} rows")
    return out


def write_document(row: DataFrame, path: str) -> DataFrame:
    """One row as a JSON document, nulls kept, and as it is read back."""
    row.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return row.sparkSession.read.schema(row.schema).json(path)


def publish_checked(df: DataFrame, checks: DataFrame, path: str, partition: list[str], order: list[str]) -> DataFrame:
    """Publish a table whose checks have passed, and make sure that every row arrived."""
    assert_passed(checks)
    expected, out = df.count(), publish_partitioned(df, path, partition, order)
    if (found := out.count()) != expected:
        raise ContractError(f"published {found} of {expected} rows")
    return out


def publish_single(df: DataFrame, path: str, order: list[str]) -> DataFrame:
    """Write one unpartitioned table, range-ordered, and return it as read back."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_changed(df: DataFrame, decisions: DataFrame, path: str, partition: list[str], order: list[str]) -> None:
    """Write only the partitions whose action asks for it; a blocked one is an error."""
    blocked = decisions.filter("action = 'BLOCK'").limit(1).collect()
    if blocked:
        raise ContractError(f"content differs from the published partition: {blocked[0]}")
    wanted = decisions.filter(F.col("action").isin("UPLOAD", "NEW_VERSION")).select(*partition)
    publish_partitioned(df.join(wanted, partition, "left_semi").select(df.columns), path, partition, order)


def with_date_parts(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns({"year": F.year(column), "month": F.month(column), "day": F.day(column)})
