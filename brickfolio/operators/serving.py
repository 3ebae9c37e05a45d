"""Serving tables: inference rows, context records and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.operators.checks import rule_counts
from brickfolio.operators.features import latest_features

_META = ("feature_version", "source_price_history_version")
IDENTITY = ("cnpj", "codigo_cvm", "denominacao_social", "situacao_cvm")
MARKET = ("trade_date", *C.PRICES, "trades_quantity", "intraday_variation", "intraday_variation_pct", "price_range",
          "price_range_pct", "ticker_resolution_status", "market_evidence_confidence")
CONTEXT_VERSION = "v1"


def inference_dataset(features: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Ready rows of the last feature date with the allowed inputs only."""
    names = C.feature_names() if names is None else names
    bad = [n for n in names if C.is_forbidden_feature(n)]
    if bad:
        raise C.ContractError(f"not allowed as model inputs: {bad}")
    C.require_columns(features, names, "features")
    return latest_features(features).filter("feature_ready").select(
        "feature_date", "ticker", *_META, *names).orderBy("feature_date", "ticker")


def serving_checks(inference: DataFrame, reference_dates: DataFrame) -> DataFrame:
    """Keys, one date, freshness against the daily layer (``reference_dates.trade_date``)."""
    latest = reference_dates.agg(F.max("trade_date")).scalar()
    rows = inference.withColumn("serving_date", latest)
    return rule_counts(rows, {
        "TICKER_PRESENT": X.blank("ticker"), "DATE_PRESENT": F.col("feature_date").isNull(),
        "DATE_IS_SERVING_DATE": F.col("feature_date") != F.col("serving_date"),
    }, key=("ticker", "feature_date"))


def manifest(df: DataFrame, dataset: str, date_column: str) -> DataFrame:
    """One READY row describing a validated table."""
    per_ticker = df.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.min(date_column).alias("d0"), F.max(date_column).alias("d1"))
    return per_ticker.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("ticker_count"),
        F.max("d1").alias("business_date"), (F.min("d0") == F.max("d1")).alias("single_date"),
    ).select(F.lit(dataset).alias("dataset"), F.lit("READY").alias("status"), "*")


def source_alignment(daily: DataFrame, ml: DataFrame) -> DataFrame:
    """Tickers of both serving sources in one row: shared, missing on a side, repeated."""
    a = daily.groupBy("ticker").agg(F.count(F.lit(1)).alias("a"))
    b = ml.groupBy("ticker").agg(F.count(F.lit(1)).alias("b"))
    na, nb = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    return a.join(b, "ticker", "full_outer").agg(
        F.count_if((na > 0) & (nb > 0)).alias("shared_tickers"), F.count_if(nb == 0).alias("only_daily"),
        F.count_if(na == 0).alias("only_ml"), F.count_if((na > 1) | (nb > 1)).alias("repeated_tickers"),
    ).withColumn("aligned", (F.col("only_daily") == 0) & (F.col("only_ml") == 0) & (F.col("repeated_tickers") == 0))


def date_alignment(daily: DataFrame, ml: DataFrame, partition_date: str = "partition_date") -> DataFrame:
    """Whether both serving sources hold one date each, the same one, and that of the partition they were read from (if they carry it)."""
    def dates(df: DataFrame, column: str, name: str) -> DataFrame:
        stored = F.col(partition_date) if partition_date in df.columns else F.col(column)
        per_date = df.groupBy(column, stored.alias("p")).agg(F.count(F.lit(1)).alias("n"))
        return per_date.agg(F.count_distinct(column).alias(f"{name}_dates"), F.min(column).alias(f"{name}_date"),
                            F.coalesce(F.sum(F.when(~F.col("p").eqNullSafe(F.col(column)), F.col("n"))), F.lit(0)).alias(f"{name}_outside_partition"))
    # one row each
    row = dates(daily, "trade_date", "daily").crossJoin(F.broadcast(dates(ml, "feature_date", "ml")))
    return row.withColumn("dates_equal", (F.col("daily_dates") == 1) & (F.col("ml_dates") == 1) & F.coalesce(F.col("daily_date") == F.col("ml_date"), F.lit(False)))


def context_records(daily: DataFrame, ml: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One nested record per ticker; NaN becomes null, features are a map."""
    names = C.feature_names() if names is None else names
    features = F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[X.no_nan(F.col(f"m.{n}")) for n in names]))
    joined = daily.alias("d").join(ml.alias("m"), "ticker", "inner")
    return joined.select(
        F.lit(CONTEXT_VERSION).alias("context_version"), "ticker",
        F.struct(*[F.col(f"d.{c}").alias(c) for c in IDENTITY]).alias("identity"),
        F.struct(*[F.col(f"d.{c}").alias(c) for c in MARKET]).alias("market_state"),
        F.struct(F.col("m.feature_date").alias("feature_date"), *[F.col(f"m.{c}").alias(c) for c in _META],
                 features.alias("features")).alias("ml_state"),
        F.struct(F.lit("fii_daily_snapshot").alias("daily_dataset"), F.lit("fii_ml_inference").alias("ml_dataset"))
        .alias("provenance"),
    ).orderBy("ticker")


def context_json(records: DataFrame) -> DataFrame:
    """One JSON line per record with its keys in sorted order."""
    ordered = records.select([c for c in sorted(records.columns)])
    return ordered.select("ticker", F.to_json(F.struct(*ordered.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_context(records: DataFrame, path: str) -> DataFrame:
    """JSON lines, range-ordered by ticker; returns the table as read back."""
    lines = context_json(records).repartitionByRange("ticker").sortWithinPartitions("ticker")
    lines.select("value").write.mode("overwrite").text(path)
    return records.sparkSession.read.schema(records.schema).json(path)


def context_checks(records: DataFrame) -> DataFrame:
    sections = ("identity", "market_state", "ml_state", "provenance")
    return rule_counts(records, {f"{s.upper()}_PRESENT": F.col(s).isNull() for s in sections}, key=("ticker",))


def retrieve(records: DataFrame, ticker: str) -> DataFrame:
    """Exact lookup; the filter reaches the scan of a stored table."""
    return records.filter(F.col("ticker") == ticker.strip().upper())


def product_status(manifests: DataFrame) -> DataFrame:
    """Layers of the product on one date with one ticker count; a few manifest rows."""
    same_date = F.count_distinct("business_date") == 1
    same_count = F.count_distinct("ticker_count") == 1
    ready = F.bool_and(F.col("status") == "READY")
    return manifests.agg(
        F.count(F.lit(1)).alias("layers"), F.min("business_date").alias("first_date"),
        F.max("business_date").alias("last_date"), F.min("ticker_count").alias("min_tickers"),
        F.max("ticker_count").alias("max_tickers"), same_date.alias("dates_aligned"),
        same_count.alias("counts_aligned"), ready.alias("all_ready"),
    ).withColumn("status", F.when(
        F.col("dates_aligned") & F.col("counts_aligned") & F.col("all_ready"), "READY").otherwise("NOT_ALIGNED"))
