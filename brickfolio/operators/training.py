"""Training samples with economic targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.functions.windows import running
from brickfolio.operators.calendar import session_calendar
from brickfolio.operators.checks import rule_counts
from brickfolio.operators import eligibility as EL, features as FEATURES, history as HISTORY
from brickfolio.operators.eligibility import (
    OUTPUT as ELIGIBILITY, RUNNING, temporal_signals, with_sample_keys, with_target_row, with_verdict,
)
from brickfolio.operators.features import with_features
from brickfolio.operators.history import with_history
from brickfolio.operators.quality import with_quality

FROM_ELIGIBILITY = [
    "target_date", "feature_global_session_index", "target_global_session_index", "feature_return_window",
    "feature_price_lookback_observations", "blocking_feature_lookback_count", "blocking_target_horizon_count",
    "feature_window_clean", "target_horizon_clean", "ml_eligible", "ml_ineligibility_reason",
    "ml_eligibility_version", "source_feature_version", "source_price_quality_version", "eligibility_policy",
]


def return_curve(history: DataFrame) -> DataFrame:
    """Running sum of log growth; the return over (T, U] is exp(curve U - curve T) - 1."""
    growth = 1.0 + F.coalesce("daily_return_economic", F.lit(0.0))
    # a growth factor of zero or less has no logarithm and would poison every later row
    checked = F.when(growth > 0, growth).otherwise(
        F.raise_error(F.lit("economic growth factor must be positive")).cast("double"))
    return history.withColumn("economic_growth_factor", checked).withColumn(
        "cumulative_economic_log_growth", F.sum(F.log("economic_growth_factor")).over(running()))


def training_dataset(features: DataFrame, eligibility: DataFrame, history: DataFrame,
                     calendar: DataFrame | None = None, horizon: int = C.TARGET_HORIZON) -> DataFrame:
    calendar = session_calendar(history) if calendar is None else calendar
    key = ["ticker", "feature_date"]
    h = f"{horizon}d"
    curve = return_curve(history.select("ticker", "trade_date", "close_price", "close_price_raw", "daily_return_economic"))
    outcome = with_target_row(
        curve, ["close_price", "close_price_raw", "cumulative_economic_log_growth"], calendar, horizon
    ).select(
        "ticker", F.col("trade_date").alias("feature_date"),
        F.col("cumulative_economic_log_growth").alias("economic_curve_at_feature"),
        F.col("target.close_price").alias(f"target_price_next_{h}"),
        F.col("target.close_price_raw").alias("target_price_raw"),
        F.col("target.cumulative_economic_log_growth").alias("economic_curve_at_target"),
    )
    ready = features.filter(F.col("feature_ready")).drop(*[c for c in FROM_ELIGIBILITY if c in features.columns])
    samples = eligibility.select(*key, *FROM_ELIGIBILITY).join(ready, key, "left").join(outcome, key, "left")
    windows = [int(c[3:]) for c in features.columns if c.startswith("ma_") and c[3:].isdigit()]
    return with_targets(samples, horizon).select(output_columns(windows, horizon))


def target_columns(horizon: int = C.TARGET_HORIZON) -> list[dict[str, Column]]:
    """The target columns that follow from others of the same row; the second group is of the first."""
    h = f"{horizon}d"
    target, price_only = f"target_return_next_{h}", f"target_price_return_next_{h}"
    return [{
        price_only: X.ratio(f"target_price_next_{h}", "close_price") - 1.0,
        target: F.exp(F.col("economic_curve_at_target") - F.col("economic_curve_at_feature")) - 1.0,
    }, {
        f"{price_only}_pct": F.col(price_only) * 100, f"{target}_pct": F.col(target) * 100,
        "target_economic_vs_price_difference": F.col(target) - F.col(price_only),
        "target_economic_vs_price_difference_pct": (F.col(target) - F.col(price_only)) * 100,
    }]


def with_targets(samples: DataFrame, horizon: int) -> DataFrame:
    returns, differences = target_columns(horizon)
    return (
        samples.withColumns(returns)
        .withColumns({
            **differences,
            "target_name": F.lit(f"target_return_next_{horizon}d"), "target_return_semantics": F.lit(C.RETURN_SEMANTICS),
            "target_horizon": F.lit(horizon), "target_horizon_semantics": F.lit(C.HORIZON_SEMANTICS),
            "training_dataset_version": F.lit(C.TRAINING_VERSION),
            "source_ml_eligibility_version": F.col("ml_eligibility_version"),
            "training_sample_policy": F.lit(C.TRAINING_POLICY),
        })
    )


def output_columns(windows=C.DEFAULT_WINDOWS, horizon: int = C.TARGET_HORIZON) -> list[str]:
    h = f"{horizon}d"
    feature_columns = [c for c in FEATURES.output_columns(windows) if c not in ("feature_date", "ticker", *FROM_ELIGIBILITY)]
    targets = [f"{kind}_next_{h}{suffix}" for kind in ("target_price_return", "target_return") for suffix in ("", "_pct")]
    return (
        ["ticker", "feature_date", *FROM_ELIGIBILITY, *feature_columns, "economic_curve_at_feature",
         f"target_price_next_{h}", "target_price_raw", "economic_curve_at_target", *targets,
         "target_economic_vs_price_difference", "target_economic_vs_price_difference_pct", "target_name",
         "target_return_semantics", "target_horizon", "target_horizon_semantics", "training_dataset_version",
         "source_ml_eligibility_version", "training_sample_policy"])


def fixed_columns(windows=C.DEFAULT_WINDOWS, horizon: int = C.TARGET_HORIZON) -> dict[str, Column]:
    """The literals of the columns that have the same value in every row of ``training_from_adjusted``."""
    own = {
        "feature_version": C.FEATURE_VERSION, "feature_windows": ",".join(map(str, C.normalize_windows(windows))),
        "source_price_history_version": C.PRICE_HISTORY_VERSION, "source_price_history_source": C.ADJUSTED_SOURCE,
        "feature_price_semantics": C.PRICE_SEMANTICS, "feature_return_semantics": C.FEATURE_RETURN_SEMANTICS,
        "feature_corporate_action_policy": C.FEATURE_CA_POLICY, "target_name": f"target_return_next_{horizon}d",
        "target_return_semantics": C.RETURN_SEMANTICS, "training_dataset_version": C.TRAINING_VERSION,
        "source_ml_eligibility_version": C.ELIGIBILITY_VERSION, "training_sample_policy": C.TRAINING_POLICY,
    }
    every = {**EL.fixed_columns(horizon), **{c: F.lit(v) for c, v in own.items()}}
    return {c: every[c] for c in output_columns(C.normalize_windows(windows), horizon) if c in every}


def given_columns(windows=C.DEFAULT_WINDOWS, horizon: int = C.TARGET_HORIZON) -> list[dict[str, Column]]:
    """The columns of ``training_from_adjusted`` that need not be carried: of one value, or computed from others of the row as they were first."""
    windows = C.normalize_windows(windows)
    returns, differences = target_columns(horizon)
    aliases = {"close_price_adjusted": F.col("close_price"), "daily_return_economic": F.col("daily_return"), "daily_return_pct": F.col("daily_return") * 100}
    return [{**fixed_columns(windows, horizon), **aliases, **HISTORY.derived_columns(windows), **FEATURES.cross_columns(windows), **returns}, differences]


def _sample_rows(adjusted: DataFrame, calendar: DataFrame | None, windows, horizon: int) -> DataFrame:
    """Adjusted rows widened by history, quality, features, signals and the row T+h.

    Every step adds columns to the same rows through windows of one ticker, so
    the whole chain keeps one hash partitioning and one sort order.
    """
    calendar = session_calendar(adjusted) if calendar is None else calendar
    h = f"{horizon}d"
    wide = with_features(with_history(with_quality(adjusted, calendar), windows), windows)
    curved = return_curve(temporal_signals(wide))
    rows = with_target_row(
        curved, [*RUNNING, "close_price", "close_price_raw", "cumulative_economic_log_growth"], calendar, horizon)
    samples = rows.filter(F.col("feature_ready") & F.col("target").isNotNull())
    return with_verdict(with_sample_keys(samples, horizon)).withColumns({
        "feature_date": F.col("trade_date"),
        "economic_curve_at_feature": F.col("cumulative_economic_log_growth"),
        f"target_price_next_{h}": F.col("target.close_price"),
        "target_price_raw": F.col("target.close_price_raw"),
        "economic_curve_at_target": F.col("target.cumulative_economic_log_growth"),
    })


def eligibility_from_adjusted(adjusted: DataFrame, calendar: DataFrame | None = None, windows=C.DEFAULT_WINDOWS,
                              horizon: int = C.TARGET_HORIZON) -> DataFrame:
    """``ml_eligibility`` in one pass over the adjusted prices."""
    return _sample_rows(adjusted, calendar, windows, horizon).select(ELIGIBILITY)


def training_from_adjusted(adjusted: DataFrame, calendar: DataFrame | None = None, windows=C.DEFAULT_WINDOWS,
                           horizon: int = C.TARGET_HORIZON) -> DataFrame:
    """``training_dataset`` in one pass over the adjusted prices."""
    rows = _sample_rows(adjusted, calendar, windows, horizon)
    return with_targets(rows, horizon).select(output_columns(C.normalize_windows(windows), horizon))


def training_checks(training: DataFrame, horizon: int = C.TARGET_HORIZON, dataset: str | None = None) -> DataFrame:
    target = f"target_return_next_{horizon}d"
    c = F.col
    rules = {
        "TICKER_PRESENT": X.blank("ticker"),
        "FEATURE_DATE_PRESENT": c("feature_date").isNull(),
        "TARGET_DATE_PRESENT": c("target_date").isNull(),
        "TARGET_AFTER_FEATURE": c("target_date") <= c("feature_date"),
        "FEATURE_READY": ~X.flag("feature_ready"),
        "TARGET_FINITE": ~X.finite(target),
        "TARGET_ABOVE_MINUS_ONE": c(target) <= -1.0,
        "HORIZON_EXACT":
            c("target_global_session_index") - c("feature_global_session_index") != F.lit(horizon),
        "ELIGIBLE_IS_CLEAN": c("ml_eligible") != (c("feature_window_clean") & c("target_horizon_clean")),
        "DIFFERENCE_CONSISTENT": F.abs(
            c(target) - c(f"target_price_return_next_{horizon}d") - c("target_economic_vs_price_difference")) > 1e-12,
    }
    return rule_counts(training, rules, key=("ticker", "feature_date"), dataset=dataset)


def horizon_check(samples: DataFrame, calendar: DataFrame, horizon: int = C.TARGET_HORIZON) -> DataFrame:
    """Recomputes T+h from the calendar alone and compares; one row."""
    index_of = calendar.select(F.col("trade_date").alias("feature_date"), F.col("session_index").alias("at"))
    date_at = calendar.select(F.col("trade_date").alias("expected_target_date"),
                              (F.col("session_index") - horizon).alias("at"))
    # both sides hold one row per calendar day
    joined = samples.join(F.broadcast(index_of), "feature_date", "left").join(F.broadcast(date_at), "at", "left")
    match = X.flag(F.col("expected_target_date") == F.col("target_date"))
    delay = F.datediff("target_date", "feature_date")
    return joined.agg(
        F.count(F.lit(1)).alias("sample_rows"), F.count_if(F.col("at").isNull()).alias("outside_calendar"),
        F.count_if(match).alias("matching_rows"), F.avg(match.cast("double")).alias("match_rate"),
        F.min(delay).alias("min_calendar_delay"), F.max(delay).alias("max_calendar_delay"),
        F.avg(delay).alias("mean_calendar_delay"),
    )


