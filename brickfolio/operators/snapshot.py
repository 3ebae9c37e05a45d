"""Daily prices of known funds and the daily snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brickfolio.contracts import PRICES
from brickfolio.functions import columns as X
from brickfolio.operators.checks import duplicate_rows, rule_counts

SNAPSHOT_COLUMNS = [
    "trade_date", "ticker", "cnpj", "codigo_cvm", "denominacao_social", "situacao_cvm", "instrument_id", *PRICES,
    "trades_quantity", "intraday_variation", "intraday_variation_pct", "price_range", "price_range_pct",
    "ticker_resolution_status", "market_evidence_confidence",
]


def daily_prices(trades: DataFrame, master: DataFrame, source_file: str = "") -> DataFrame:
    """Trades of the funds in the master. AQE broadcasts the master when it is small."""
    mapping = master.select("ticker", "cnpj", "codigo_cvm", "ticker_resolution_status", "market_evidence_confidence")
    return trades.select("trade_date", "ticker", "instrument_id", *PRICES, "trades_quantity").join(
        mapping, "ticker", "inner").withColumns({"source": F.lit("b3"), "source_file_name": F.lit(source_file)})


def ambiguous_master_tickers(master: DataFrame) -> DataFrame:
    """Tickers that point at several funds; the join above wants none."""
    return duplicate_rows(master, "ticker")


def price_checks(prices: DataFrame, dataset: str | None = None) -> DataFrame:
    c = F.col
    return rule_counts(prices, {
        **{f"{n.upper()}_PRESENT": c(n).isNull() for n in ("trade_date", "ticker", "cnpj", "close_price")},
        **{f"{n.upper()}_POSITIVE": c(n) <= 0 for n in PRICES},
        "CLOSE_INSIDE_RANGE": (c("close_price") < c("low_price")) | (c("close_price") > c("high_price")),
        "TRADES_NOT_NEGATIVE": c("trades_quantity") < 0,
    }, key=("ticker", "trade_date"), dataset=dataset)


def daily_snapshot(prices: DataFrame, master: DataFrame) -> DataFrame:
    info = master.select(
        "cnpj", "codigo_cvm", "denominacao_social", "situacao_cvm",
        "ticker_resolution_status", "market_evidence_confidence")
    base = prices.drop("ticker_resolution_status", "market_evidence_confidence")
    span = F.col("high_price") - F.col("low_price")
    return base.join(info, ["cnpj", "codigo_cvm"], "left").withColumns({
        "intraday_variation": F.col("close_price") - F.col("open_price"),
        "intraday_variation_pct": (X.ratio("close_price", "open_price") - 1.0) * 100,
        "price_range": span, "price_range_pct": X.ratio(span, "low_price") * 100,
    }).select(SNAPSHOT_COLUMNS)


def snapshot_checks(snapshot: DataFrame, dataset: str | None = None) -> DataFrame:
    required = ("trade_date", "ticker", "cnpj", "codigo_cvm", "denominacao_social", "close_price")
    metrics = ("intraday_variation", "intraday_variation_pct", "price_range", "price_range_pct")
    return rule_counts(
        snapshot, {f"{c.upper()}_PRESENT": F.col(c).isNull() for c in required + metrics},
        key=("ticker", "trade_date"), dataset=dataset)
