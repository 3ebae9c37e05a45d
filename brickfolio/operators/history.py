"""Price history: rolling economic features per ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.functions.windows import by_ticker, full_window, last_rows, total_of_last
from brickfolio.operators.adjusted import OUTPUT as ADJUSTED
from brickfolio.operators.checks import rule_counts

_GOVERNANCE = ADJUSTED[ADJUSTED.index("review_status_on_date"):ADJUSTED.index("ticker_resolution_status")]
_AUDIT = (
    [f"{c}_raw" for c in C.PRICES] + [f"{c}_adjusted" for c in C.PRICES] + ["structural_adjustment_factor"]
    + [c for c in ADJUSTED if "per_unit" in c and not c.startswith("confirmed")]
    + ["daily_return_raw", "daily_return_adjusted_price", "daily_return_economic"]
)


def output_columns(windows=C.DEFAULT_WINDOWS) -> list[str]:
    return (
        ["trade_date", "ticker", "cnpj", "codigo_cvm", "instrument_id", *C.PRICES, "trades_quantity"]
        + _AUDIT + ["daily_return", "daily_return_pct"]
        + [c for n in windows for c in C.window_columns(n)] + _GOVERNANCE
        + ["observations_count", "ticker_resolution_status", "market_evidence_confidence",
           "adjusted_prices_version", "adjusted_prices_source", "corporate_action_source",
           "price_history_version", "price_history_source", "return_semantics", "price_semantics",
           "corporate_action_value_semantics", "feature_windows"]
    )


def rolling_return(r, n: int):
    """Compounded return of the last ``n`` rows, null unless all ``n`` are present."""
    w = last_rows(n)
    return full_window(r, n, w, F.product(1.0 + r)) - 1.0


def price_history(adjusted: DataFrame, windows=C.DEFAULT_WINDOWS) -> DataFrame:
    return with_history(adjusted, windows).select(output_columns(C.normalize_windows(windows)))


def derived_columns(windows=C.DEFAULT_WINDOWS) -> dict[str, Column]:
    """The rolling columns that follow from others of the same row."""
    derived = {}
    for n in windows:
        derived[f"return_{n}d_pct"] = F.col(f"return_{n}d") * 100
        derived[f"volatility_{n}d_pct"] = F.col(f"volatility_{n}d") * 100
        derived[f"price_to_ma{n}"] = X.ratio("close_price", f"ma_{n}")
    return derived


def with_history(adjusted: DataFrame, windows=C.DEFAULT_WINDOWS) -> DataFrame:
    """Add the history columns to adjusted rows."""
    windows = C.normalize_windows(windows)
    base = adjusted.withColumns({
        **{c: F.col(f"{c}_adjusted") for c in C.PRICES},
        "daily_return": F.col("daily_return_economic"),
        "daily_return_pct": F.col("daily_return_economic") * 100,
        "observations_count": F.row_number().over(by_ticker()).cast("bigint"),
    })
    r, close, trades = F.col("daily_return"), F.col("close_price"), F.col("trades_quantity")
    whole = isinstance(adjusted.schema["trades_quantity"].dataType, (T.LongType, T.IntegerType))
    # all frames share one partitioning and ordering: one exchange, one sort
    rolled = {}
    for n in windows:
        w = last_rows(n)
        rolled[f"return_{n}d"] = rolling_return(r, n)
        rolled[f"ma_{n}"] = full_window(close, n, w, F.sum(close)) / n
        rolled[f"volatility_{n}d"] = full_window(r, n, w, F.stddev_samp(r))
        rolled[f"trades_avg_{n}d"] = F.when(total_of_last(F.count(trades), n) == n, total_of_last(F.sum(trades), n) / n) if whole else full_window(
            trades, n, w, F.avg(trades))
    lineage = {
        "price_history_version": F.lit(C.PRICE_HISTORY_VERSION),
        "price_history_source": F.lit(C.ADJUSTED_SOURCE),
        "return_semantics": F.lit(C.RETURN_SEMANTICS), "price_semantics": F.lit(C.PRICE_SEMANTICS),
        "corporate_action_value_semantics": F.lit(C.CA_VALUE_SEMANTICS),
        "feature_windows": F.lit(",".join(map(str, windows))),
    }
    return base.withColumns(rolled).withColumns({**derived_columns(windows), **lineage})


def history_checks(history: DataFrame, windows=C.DEFAULT_WINDOWS, dataset: str | None = None) -> DataFrame:
    """Early rows must be null; aliases must agree to 1e-12."""
    c = F.col
    rules = {}
    for n in windows:
        rules[f"RETURN_{n}D_NULL_BEFORE_FULL"] = (c("observations_count") < n + 1) & c(f"return_{n}d").isNotNull()
        rules[f"MA_{n}_NULL_BEFORE_FULL"] = (c("observations_count") < n) & c(f"ma_{n}").isNotNull()
        rules[f"MA_{n}_PRESENT_WHEN_FULL"] = (c("observations_count") >= n) & c(f"ma_{n}").isNull()
        rules[f"PCT_ALIAS_{n}"] = F.abs(c(f"return_{n}d") * 100 - c(f"return_{n}d_pct")) > 1e-12
    rules["RETURN_ALIAS"] = F.abs(c("daily_return") - c("daily_return_economic")) > 1e-12
    for p in C.PRICES:
        rules[f"{p.upper()}_ALIAS"] = F.abs(c(p) - c(f"{p}_adjusted")) > 1e-12
    return rule_counts(history, rules, key=("ticker", "trade_date"), dataset=dataset)
