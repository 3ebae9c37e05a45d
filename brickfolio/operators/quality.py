"""Session gaps, quality flags and liquidity context of price rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.operators.checks import rule_counts
from brickfolio.functions.windows import by_ticker, rows_before
from brickfolio.operators.calendar import session_calendar, with_session_index

OUTPUT = [
    "trade_date", "ticker", "cnpj", "codigo_cvm", "close_price_raw", "close_price_adjusted",
    "daily_return_raw", "daily_return_adjusted_price", "daily_return_economic",
    "cash_amount_per_unit_raw", "in_kind_amount_per_unit_raw", "corporate_action_value_per_unit_raw",
    "confirmed_event_type", "confirmed_in_kind_asset_ticker",
    "previous_trade_date", "previous_close_price_raw", "trading_gap_calendar_days", "trading_gap_sessions",
    "trading_gap_class", "review_status_on_date", "confirmed_action_on_date", "pending_review_on_date",
    "flag_extreme_return", "flag_low_price", "flag_short_gap", "flag_medium_gap", "flag_long_gap",
    "flag_pending_corporate_action", "flag_confirmed_corporate_action",
    "flag_confirmed_economic_corporate_action", "flag_in_kind_corporate_action",
    "flag_possible_microliquidity", "quality_flags", "ml_quality_status",
    "price_quality_version", "price_quality_source",
]


def gap_class(sessions: Column) -> Column:
    return (
        F.when(sessions.isNull(), "UNKNOWN").when(sessions <= 1, "CONTIGUOUS")
        .when(sessions <= C.SHORT_GAP_SESSIONS, "SHORT_GAP")
        .when(sessions <= C.MEDIUM_GAP_SESSIONS, "MEDIUM_GAP").otherwise("LONG_GAP")
    )


def session_gaps(rows: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Distance to the ticker's previous row in days and in sessions of the whole market."""
    calendar = session_calendar(rows) if calendar is None else calendar
    w = by_ticker()
    return (
        with_session_index(rows, calendar)
        .withColumns({
            "previous_trade_date": F.lag("trade_date").over(w),
            "previous_session_index": F.lag("session_index").over(w),
        })
        .withColumns({
            "trading_gap_calendar_days": F.datediff("trade_date", "previous_trade_date"),
            "trading_gap_sessions": F.col("session_index") - F.col("previous_session_index"),
        })
        .withColumn("trading_gap_class", gap_class(F.col("trading_gap_sessions")))
    )


def price_quality(adjusted: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    return with_quality(adjusted, calendar).select(OUTPUT)


def with_quality(adjusted: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Add gap, flag and status columns to adjusted rows."""
    gap = F.col("trading_gap_class")
    flags = {
        "flag_extreme_return": X.flag(F.abs("daily_return_economic") >= C.EXTREME_RETURN),
        "flag_low_price": X.flag(F.col("close_price_raw") <= C.LOW_PRICE),
        "flag_short_gap": gap == "SHORT_GAP",
        "flag_medium_gap": gap == "MEDIUM_GAP",
        "flag_long_gap": gap == "LONG_GAP",
        "flag_pending_corporate_action": X.flag("pending_review_on_date"),
        "flag_confirmed_corporate_action": X.flag("confirmed_action_on_date"),
    }
    f = F.col
    combined = {
        "flag_confirmed_economic_corporate_action":
            f("flag_confirmed_corporate_action") & X.flag(f("confirmed_event_type") == "AMORTIZATION"),
        "flag_in_kind_corporate_action":
            f("flag_confirmed_corporate_action") & X.flag(f("in_kind_amount_per_unit_raw") > 0),
        "flag_possible_microliquidity":
            f("flag_extreme_return") & (f("flag_low_price") | f("flag_long_gap")),
    }
    labels = [
        (f("flag_extreme_return"), "EXTREME_RETURN"), (f("flag_low_price"), "LOW_PRICE"),
        (f("flag_short_gap"), "SHORT_TRADING_GAP"), (f("flag_medium_gap"), "MEDIUM_TRADING_GAP"),
        (f("flag_long_gap"), "LONG_TRADING_GAP"),
        (f("flag_pending_corporate_action"), "PENDING_CORPORATE_ACTION"),
        (f("flag_confirmed_corporate_action"), "CONFIRMED_CORPORATE_ACTION"),
        (f("flag_confirmed_economic_corporate_action"), "CONFIRMED_ECONOMIC_CORPORATE_ACTION"),
        (f("flag_in_kind_corporate_action"), "IN_KIND_CORPORATE_ACTION"),
        (f("flag_possible_microliquidity"), "POSSIBLE_MICROLIQUIDITY"),
    ]
    review = (
        f("flag_pending_corporate_action") | f("flag_long_gap") | f("flag_possible_microliquidity"))
    return (
        session_gaps(adjusted, calendar).withColumns(flags).withColumns(combined)
        .withColumns({
            "quality_flags": X.joined_flags(labels),
            "ml_quality_status": F.when(review, "REVIEW").otherwise("PASS"),
            "price_quality_version": F.lit(C.PRICE_QUALITY_VERSION),
            "price_quality_source": F.lit(C.ADJUSTED_SOURCE),
        })
    )


def price_quality_checks(quality: DataFrame, dataset: str | None = None) -> DataFrame:
    """The contract of the price quality table."""
    c = F.col
    named = lambda flag: F.array_contains(F.split("quality_flags", r"\|"), flag)
    rules = {
        "TICKER_PRESENT": X.blank("ticker"),
        "TRADE_DATE_PRESENT": c("trade_date").isNull(),
        "CLOSE_PRESENT": c("close_price_raw").isNull() | c("close_price_adjusted").isNull(),
        "GAP_CLASS_PRESENT": c("trading_gap_class").isNull(),
        "STATUS_DOMAIN": ~F.coalesce(c("ml_quality_status").isin("PASS", "REVIEW"), F.lit(False)),
        "EXTREME_FLAG_NAMED": c("flag_extreme_return") != named("EXTREME_RETURN"),
        "GAPS_NOT_NEGATIVE": c("trading_gap_sessions") < 0,
        "PREVIOUS_DATE_EARLIER": c("previous_trade_date") >= c("trade_date"),
        "VERSION_PRESENT": X.blank("price_quality_version") | X.blank("price_quality_source"),
    }
    return rule_counts(quality, rules, key=("ticker", "trade_date"), dataset=dataset)


LIQUIDITY_WINDOWS = (5, 20)


def lagged_liquidity(history: DataFrame, windows=LIQUIDITY_WINDOWS) -> DataFrame:
    """Mean and median trades and price dispersion of the rows before each row."""
    trades, change = F.col("trades_quantity"), F.col("price_change")
    measures = {}
    for n in windows:
        w = rows_before(n)
        measures[f"trades_avg_prev_{n}"] = F.avg(trades).over(w)
        measures[f"trades_median_prev_{n}"] = F.percentile(trades, F.lit(0.5)).over(w)
        measures[f"price_volatility_prev_{n}"] = F.when(
            F.count(change).over(w) >= 2, F.stddev_samp(change).over(w))
    previous = F.lag("close_price").over(by_ticker())
    return (
        history.withColumn("price_change", X.ratio(F.col("close_price"), previous) - 1.0)
        .withColumns(measures).drop("price_change")
    )


def case_dataset(cases: DataFrame, quality: DataFrame, history: DataFrame) -> DataFrame:
    """Case keys with their quality row, history row, relative liquidity and a diagnosis."""
    key = ["ticker", "trade_date"]
    liquidity = lagged_liquidity(history).select(
        *key, "close_price", "trades_quantity",
        *[f"{m}_prev_{n}" for n in LIQUIDITY_WINDOWS for m in ("trades_avg", "trades_median", "price_volatility")])
    rows = cases.select(*key).join(quality, key, "left").join(liquidity, key, "left")
    extreme = X.flag(F.abs("daily_return_economic") >= C.EXTREME_RETURN)
    # fixed values: diagnosis names and limits
    diagnosis = (
        F.when(F.col("trading_gap_sessions") > C.MEDIUM_GAP_SESSIONS, "STRONG_LIQUIDITY_GAP_SIGNAL")
        .when((F.col("close_price") <= C.LOW_PRICE) & extreme, "STRONG_MICROLIQUIDITY_SIGNAL")
        .when((F.col("trades_quantity") <= 5) & extreme, "LOW_TRADING_ACTIVITY_SIGNAL")
        .otherwise("UNRESOLVED")
    )
    return rows.withColumns({
        **{f"trades_vs_avg_{n}": X.ratio("trades_quantity", f"trades_avg_prev_{n}") for n in LIQUIDITY_WINDOWS},
        "diagnostic_class": diagnosis,
    })


def remaining_extremes(adjusted: DataFrame, threshold: float = C.EXTREME_RETURN,
                       calendar: DataFrame | None = None) -> DataFrame:
    """Economic moves still at or above the threshold, with their session gap."""
    size = F.abs("daily_return_economic")
    return session_gaps(adjusted, calendar).filter(size >= threshold).select(
        "ticker", "trade_date", "previous_trade_date", "close_price_raw", "daily_return_raw",
        "daily_return_economic", size.alias("absolute_economic_return"), "trading_gap_calendar_days",
        "trading_gap_sessions", "trading_gap_class",
    ).orderBy(F.desc("absolute_economic_return"), "ticker", "trade_date")


def detector_escapes(adjusted: DataFrame, reviewed: DataFrame, threshold: float = C.EXTREME_RETURN) -> DataFrame:
    """Economic extremes with the detector's view; escapes have no candidate."""
    found = reviewed.select(
        "ticker", F.col("event_date").alias("trade_date"), "classification", "confidence", "review_status")
    extremes = adjusted.filter(F.abs("daily_return_economic") >= threshold).select(
        "ticker", "trade_date", "daily_return_raw", "daily_return_economic")
    return extremes.join(found, ["ticker", "trade_date"], "left").withColumn(
        "detector_escape", F.col("classification").isNull())
