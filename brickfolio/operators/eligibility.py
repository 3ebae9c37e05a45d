"""Which samples may train a model: contamination before and after each date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.operators.checks import rule_counts
from brickfolio.functions.windows import exactly_ahead, running, total_of_last
from brickfolio.operators.calendar import session_calendar, with_session_index

# signal column -> (name in the lookback, running total, name in the horizon)
SIGNALS = {
    "blocking_signal": ("blocking_feature_lookback_count", "blocking_cumulative_count",
                        "blocking_target_horizon_count"),
    "informational_extreme_return": ("extreme_feature_lookback_count", "extreme_cumulative_count",
                                     "extreme_target_horizon_count"),
    "blocking_price_quality_review": (None, "price_quality_review_cumulative_count",
                                      "price_quality_review_target_count"),
    "blocking_rejected_ca_review": (None, "rejected_ca_cumulative_count", "rejected_ca_review_target_count"),
    "informational_confirmed_ca": ("confirmed_ca_feature_lookback_count", "confirmed_ca_cumulative_count",
                                   "confirmed_ca_target_count"),
    "informational_confirmed_economic_ca": (
        "confirmed_economic_ca_feature_lookback_count", "confirmed_economic_ca_cumulative_count",
        "confirmed_economic_ca_target_count"),
    "informational_in_kind_ca": ("in_kind_ca_feature_lookback_count", "in_kind_ca_cumulative_count",
                                 "in_kind_ca_target_count"),
}
LOOKBACK = [v[0] for v in SIGNALS.values() if v[0]]
RUNNING = [v[1] for v in SIGNALS.values()]
HORIZON = [v[2] for v in SIGNALS.values()]

OUTPUT = [
    "ticker", "feature_date", "target_date", "feature_global_session_index", "target_global_session_index",
    "target_horizon", "target_horizon_semantics", "feature_return_window", "feature_price_lookback_observations",
    "blocking_signal_on_feature_date", "price_quality_review_on_feature_date",
    "rejected_ca_review_on_feature_date", *LOOKBACK, "feature_window_clean", *HORIZON, "target_horizon_clean",
    "ml_eligible", "ml_ineligibility_reason", "ml_eligibility_version", "source_feature_version",
    "source_price_quality_version", "source_price_quality_source", "price_semantics", "return_semantics",
    "corporate_action_value_semantics", "eligibility_policy",
]

# columns of one value in every row, but for those of the horizon
FIXED = {
    "feature_return_window": C.RETURN_WINDOW, "feature_price_lookback_observations": C.PRICE_LOOKBACK,
    "ml_eligibility_version": C.ELIGIBILITY_VERSION, "source_feature_version": C.FEATURE_VERSION,
    "source_price_quality_version": C.PRICE_QUALITY_VERSION, "source_price_quality_source": C.ADJUSTED_SOURCE,
    "price_semantics": C.PRICE_SEMANTICS, "return_semantics": C.RETURN_SEMANTICS,
    "corporate_action_value_semantics": C.CA_VALUE_SEMANTICS, "eligibility_policy": C.ELIGIBILITY_POLICY,
}


def fixed_columns(horizon: int = C.TARGET_HORIZON) -> dict[str, Column]:
    """The literals of the columns that have the same value in every row of ``ml_eligibility``."""
    return {c: F.lit(v) for c, v in {**FIXED, "target_horizon": horizon, "target_horizon_semantics": C.HORIZON_SEMANTICS}.items()}


def blocking_signals(quality: DataFrame) -> DataFrame:
    review = X.flag(F.col("ml_quality_status") == "REVIEW")
    rejected = X.flag(F.col("review_status_on_date") == "REJECTED")
    return quality.withColumns({
        "blocking_price_quality_review": review,
        "blocking_rejected_ca_review": rejected,
        "blocking_signal": review | rejected,
        "informational_confirmed_ca": X.flag("flag_confirmed_corporate_action"),
        "informational_confirmed_economic_ca": X.flag("flag_confirmed_economic_corporate_action"),
        "informational_in_kind_ca": X.flag("flag_in_kind_corporate_action"),
        "informational_extreme_return": X.flag("flag_extreme_return"),
    })


def temporal_signals(quality: DataFrame) -> DataFrame:
    """Counts over the last 21 rows and running totals of the signals."""
    out = {}
    for signal, (lookback, total, _) in SIGNALS.items():
        value = F.col(signal).cast("bigint")
        if lookback:
            out[lookback] = total_of_last(F.sum(value), C.PRICE_LOOKBACK)
        out[total] = F.sum(value).over(running())
    return blocking_signals(quality).withColumns(out).withColumn(
        "feature_window_clean", F.col("blocking_feature_lookback_count") == 0)


def with_target_row(rows: DataFrame, values: list[str], calendar: DataFrame,
                    horizon: int = C.TARGET_HORIZON) -> DataFrame:
    """Attach ``values`` of the ticker's row exactly ``horizon`` sessions later as struct ``target``.

    The session index is dense over the whole market, so a range frame of
    width one on it finds the row, or nothing when the ticker did not trade
    that day. No self-join and no second shuffle.
    """
    indexed = with_session_index(rows, calendar)
    return indexed.withColumn(
        "target", F.first(F.struct("trade_date", "session_index", *values)).over(
            exactly_ahead(horizon, "session_index")))


def sample_universe(features: DataFrame, quality: DataFrame, calendar: DataFrame | None = None,
                    horizon: int = C.TARGET_HORIZON) -> DataFrame:
    """Ready feature rows whose ticker traded exactly ``horizon`` sessions later."""
    calendar = session_calendar(quality) if calendar is None else calendar
    rows = with_target_row(quality.select("ticker", "trade_date"), [], calendar, horizon)
    return _ready_with_target(features, rows, horizon).select(
        "ticker", "feature_date", "target_date", "feature_global_session_index", "target_global_session_index",
        "target_horizon", "target_horizon_semantics")


def _ready_with_target(features: DataFrame, rows: DataFrame, horizon: int) -> DataFrame:
    ready = features.filter(F.col("feature_ready")).select("ticker", "feature_date")
    available = rows.filter(F.col("target").isNotNull()).withColumnRenamed("trade_date", "feature_date")
    return with_sample_keys(ready.join(available, ["ticker", "feature_date"], "inner"), horizon)


def with_sample_keys(samples: DataFrame, horizon: int) -> DataFrame:
    return samples.withColumns({
        "target_date": F.col("target.trade_date"),
        "feature_global_session_index": F.col("session_index"),
        "target_global_session_index": F.col("target.session_index"),
        "target_horizon": F.lit(horizon),
        "target_horizon_semantics": F.lit(C.HORIZON_SEMANTICS),
    })


def ml_eligibility(features: DataFrame, quality: DataFrame, calendar: DataFrame | None = None,
                   horizon: int = C.TARGET_HORIZON) -> DataFrame:
    """A sample is eligible when its lookback rows and its target horizon (T, T+h] are clean.

    Horizon counts are differences of running totals, so no row range is joined.
    """
    calendar = session_calendar(quality) if calendar is None else calendar
    signals = with_target_row(temporal_signals(quality), RUNNING, calendar, horizon)
    return with_verdict(_ready_with_target(features, signals, horizon)).select(OUTPUT)


def with_verdict(samples: DataFrame) -> DataFrame:
    counts = {h: F.col(f"target.{total}") - F.col(total) for _, total, h in SIGNALS.values()}
    return (
        samples.withColumns(counts)
        .withColumns({
            "blocking_signal_on_feature_date": F.col("blocking_signal"),
            "price_quality_review_on_feature_date": F.col("blocking_price_quality_review"),
            "rejected_ca_review_on_feature_date": F.col("blocking_rejected_ca_review"),
            "target_horizon_clean": F.col("blocking_target_horizon_count") == 0,
        })
        .withColumns({
            "ml_eligible": F.col("feature_window_clean") & F.col("target_horizon_clean"),
            "ml_ineligibility_reason": X.joined_flags([
                (~F.col("feature_window_clean"), "BLOCKING_EVENT_IN_FEATURE_LOOKBACK"),
                (~F.col("target_horizon_clean"), "BLOCKING_EVENT_IN_TARGET_HORIZON")]),
            **{c: F.lit(v) for c, v in FIXED.items()},
        })
    )


def eligibility_checks(rows: DataFrame, dataset: str | None = None) -> DataFrame:
    """The contract of the eligibility table."""
    c = F.col
    rules = {
        "TICKER_PRESENT": X.blank("ticker"),
        "FEATURE_DATE_PRESENT": c("feature_date").isNull(),
        "TARGET_AFTER_FEATURE": c("target_date") <= c("feature_date"),
        "ELIGIBLE_IS_CLEAN": c("ml_eligible") != (c("feature_window_clean") & c("target_horizon_clean")),
        "REASON_FOLLOWS_VERDICT": c("ml_eligible") != (c("ml_ineligibility_reason") == "NONE"),
        "HORIZON_COUNT_FOLLOWS": c("target_horizon_clean") != (c("blocking_target_horizon_count") == 0),
        "COUNTS_NOT_NEGATIVE": c("blocking_target_horizon_count") < 0,
    }
    return rule_counts(rows, rules, key=("ticker", "feature_date"), dataset=dataset)
