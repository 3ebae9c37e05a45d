"""Model features, their contract and the latest slices of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.operators.checks import rule_counts

_BASE = [
    "ticker", "cnpj", "codigo_cvm", "close_price", "close_price_raw", "close_price_adjusted",
    "trades_quantity", "daily_return", "daily_return_raw", "daily_return_economic", "daily_return_pct",
    "observations_count",
]


def output_columns(windows=C.DEFAULT_WINDOWS) -> list[str]:
    return (
        ["feature_date", *_BASE] + [c for n in windows for c in C.window_columns(n)]
        + C.cross_window_columns(windows)
        + ["feature_ready", "feature_version", "feature_windows", "source_price_history_version",
           "source_price_history_source", "price_semantics", "return_semantics",
           "corporate_action_value_semantics", "feature_price_semantics", "feature_return_semantics",
           "feature_corporate_action_policy"]
    )


def ml_features(history: DataFrame, windows=C.DEFAULT_WINDOWS) -> DataFrame:
    return with_features(history, windows).withColumnRenamed("trade_date", "feature_date").select(
        output_columns(C.normalize_windows(windows)))


def cross_columns(windows=C.DEFAULT_WINDOWS) -> dict[str, Column]:
    """The cross-window features, which follow from others of the same row."""
    cross = {}
    for a, b in zip(windows, windows[1:]):
        cross[f"return_spread_{a}d_{b}d"] = F.col(f"return_{a}d") - F.col(f"return_{b}d")
        cross[f"ma_ratio_{a}_{b}"] = X.ratio(f"ma_{a}", f"ma_{b}")
        cross[f"volatility_ratio_{a}d_{b}d"] = X.ratio(f"volatility_{a}d", f"volatility_{b}d")
        cross[f"trades_ratio_{a}d_{b}d"] = X.ratio(f"trades_avg_{a}d", f"trades_avg_{b}d")
    return cross


def with_features(history: DataFrame, windows=C.DEFAULT_WINDOWS) -> DataFrame:
    """Add cross-window features and readiness to history rows."""
    windows = C.normalize_windows(windows)
    needed = ["daily_return"] + [
        c for n in windows
        for c in (f"return_{n}d", f"ma_{n}", f"volatility_{n}d", f"trades_avg_{n}d", f"price_to_ma{n}")]
    ready = X.all_of([F.col(c).isNotNull() for c in needed] + [F.col("observations_count") > max(windows)])
    return history.withColumns({
        **cross_columns(windows),
        "feature_ready": ready,
        "feature_version": F.lit(C.FEATURE_VERSION),
        "source_price_history_version": F.col("price_history_version"),
        "source_price_history_source": F.col("price_history_source"),
        "feature_price_semantics": F.lit(C.PRICE_SEMANTICS),
        "feature_return_semantics": F.lit(C.FEATURE_RETURN_SEMANTICS),
        "feature_corporate_action_policy": F.lit(C.FEATURE_CA_POLICY),
    })


def feature_checks(features: DataFrame, windows=C.DEFAULT_WINDOWS, dataset: str | None = None) -> DataFrame:
    names = C.feature_names(windows)
    largest = max(windows)
    rules = {
        "FEATURE_DATE_PRESENT": F.col("feature_date").isNull(),
        "TICKER_PRESENT": X.blank("ticker"),
        **{f"{n.upper()}_FINITE": F.col(n).isNotNull() & ~X.finite(n) for n in names},
        "READY_HAS_FULL_WINDOW": F.col("feature_ready") & (F.col("observations_count") < largest + 1),
        "READY_HAS_RETURN": F.col("feature_ready") & F.col("daily_return").isNull(),
    }
    return rule_counts(features, rules, key=("ticker", "feature_date"), dataset=dataset)


def feature_windows(history: DataFrame) -> DataFrame:
    """The window lists recorded in the data, one row per (list, size)."""
    lists = history.groupBy("feature_windows").agg(F.count(F.lit(1)).alias("row_count"))
    return lists.select(
        "feature_windows", "row_count",
        F.posexplode(F.split("feature_windows", ",")).alias("position", "size"),
    ).select("feature_windows", "row_count", "position", F.trim("size").try_cast("int").alias("window_size"))


def discover_windows(history: DataFrame) -> list[int]:
    """The one window list of the data; zero or several lists are an error."""
    found = history.select("feature_windows").distinct().limit(2).collect()
    if len(found) != 1:
        raise C.ContractError(f"expected one feature window list, found {[r[0] for r in found]}")
    return C.normalize_windows(found[0][0].split(","))


def feature_contract(df: DataFrame, features: list[str]) -> DataFrame:
    """Model inputs: known, numeric, allowed and finite. One row per feature."""
    C.require_columns(df, features, "features")
    numeric = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)
    counts = df.agg(*[
        F.count_if(F.col(c).isNotNull() & ~X.finite(F.col(c).cast("double"))).alias(c) for c in features])
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("feature_name"), F.lit(isinstance(df.schema[c].dataType, numeric)).alias("is_numeric"),
            F.lit(C.is_forbidden_feature(c)).alias("is_forbidden"), F.col(c).alias("non_finite"))
        for c in features
    ])
    ok = F.col("is_numeric") & ~F.col("is_forbidden") & (F.col("non_finite") == 0)
    return counts.select(F.inline(rows)).withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def latest_features(features: DataFrame, tickers: list[str] | None = None) -> DataFrame:
    """Rows of the last feature date, which a scalar subquery finds."""
    last = features.agg(F.max("feature_date").alias("feature_date"))
    rows = features.join(F.broadcast(last), "feature_date", "left_semi")
    return rows if tickers is None else rows.filter(F.col("ticker").isin(*tickers))
