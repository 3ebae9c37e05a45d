"""Queries over the price pipeline: panel to training set and walk-forward."""

from __future__ import annotations

from pyspark.sql import functions as F

from brickfolio import contracts as C
from brickfolio.operators import (
    adjusted as A, diagnostics as DG, discontinuities as D, eligibility as EL, features as FE,
    history as H, quality as Q, splits as S, training as T, walkforward as WF,
)
from brickfolio.plans.catalog import register
from brickfolio.plans.oracle_price import price_sql, table_sql
from brickfolio.plans.pipeline import Pipeline
from brickfolio.plans.shape import select_list


def staged(key, kind, build, columns, part, where=""):
    """A query that reads one stage of the pipeline; its oracle is the same part."""
    cols = columns.split() if isinstance(columns, str) else list(columns)
    register(key, lambda s, d: build(getattr(Pipeline, kind)(s, d)), cols, table_sql(kind, part, cols, where))


def final(key, kind, build, columns, part, sql):
    cols = columns.split() if isinstance(columns, str) else list(columns)
    register(key, lambda s, d: build(getattr(Pipeline, kind)(s, d)), cols,
             price_sql(kind, f"SELECT {select_list(cols)} FROM ({sql})", part))


def checks_sql(table, rules, key=None):
    """One row per rule, the same shape as the check operators."""
    out = [f"SELECT '{n}' AS check_name, CAST(count(*) FILTER ({c}) AS BIGINT) AS violations FROM {table}"
           for n, c in rules.items()]
    if key:
        out.append(f"SELECT 'KEY_UNIQUE', CAST(count(*) - count(DISTINCT ({key})) AS BIGINT) FROM {table}")
    return ("SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
            + " UNION ALL ".join(out) + ")")


CHECK = "check_name violations status"
PANEL_COLUMNS = [f.name for f in C.PANEL_SCHEMA]

# --- panel, detector, registry ------------------------------------------------
staged("panel_scan", "daily", lambda p: p.panel, PANEL_COLUMNS, "panel")
staged("price_movements", "daily", lambda p: D.price_movements(p.panel),
       "ticker trade_date close_price previous_trade_date previous_close_price price_factor daily_return", "movements")
staged("nearest_factor", "daily", lambda p: D.classified_movements(p.panel),
       "ticker trade_date price_factor nearest_common_factor factor_relative_error factor_match classification "
       "confidence candidate_reason review_status", "classified")
_CANDIDATE = (
    "ticker cnpj codigo_cvm previous_trade_date event_date price_before price_after daily_return observed_factor "
    "nearest_common_factor factor_relative_error factor_match classification confidence candidate_reason "
    "review_status detected_by_v4_threshold newly_visible_in_v5_band")
staged("discontinuities", "daily", lambda p: p.candidates, _CANDIDATE, "candidates")
_REGISTRY = [f.name for f in C.REGISTRY_SCHEMA]
staged("registry_scan", "daily", lambda p: p.registry, _REGISTRY, "registry")
_REVIEWED = _CANDIDATE.split() + [c for c in _REGISTRY if c not in _CANDIDATE.split()] + ["is_confirmed_corporate_action"]
staged("apply_reviews", "daily", lambda p: p.reviewed, _REVIEWED, "reviewed")


# the registry of the neighbouring ticker: some decisions then have no candidate
def _shifted(p):
    number = F.substring("ticker", 3, 20).cast("bigint")
    return p.registry.withColumn("ticker", F.concat(F.lit("FD"), (number + 1).cast("string")))


_SHIFTED = "SELECT 'FD' || (CAST(substr(ticker, 3) AS BIGINT) + 1) AS ticker, * EXCLUDE (ticker) FROM registry"
final("review_coverage", "daily", lambda p: D.uncovered_reviews(p.candidates, _shifted(p)),
      "ticker event_date review_status event_type", "registry",
      f"SELECT s.* FROM ({_SHIFTED}) s LEFT JOIN candidates c USING (ticker, event_date) WHERE c.ticker IS NULL")


# some decisions are spoiled on purpose so that the rules have something to find
def _spoiled(p):
    day = F.unix_date("event_date")
    return p.registry.withColumns({
        "review_status": F.when(day % 11 == 0, "DONE").otherwise(F.col("review_status")),
        "quantity_multiplier": F.when(day % 2 == 0, F.col("quantity_multiplier") * 1.5)
        .otherwise(F.col("quantity_multiplier")),
        "confirmation_source": F.when(day % 3 == 0, " ").otherwise(F.col("confirmation_source")),
        "total_economic_value_per_unit": F.when(day % 5 == 0, F.col("total_economic_value_per_unit") + 1e-7)
        .otherwise(F.col("total_economic_value_per_unit")),
        "in_kind_asset_ticker": F.when(day % 7 == 0, F.lit(None)).otherwise(F.col("in_kind_asset_ticker")),
    })


_DAY = "date_diff('day', DATE '1970-01-01', event_date)"
_SPOILED = f"""
  SELECT *, coalesce(review_status = 'CONFIRMED', false) AS conf,
         coalesce(review_status = 'CONFIRMED' AND event_type IN ('SPLIT', 'REVERSE_SPLIT'), false) AS split,
         coalesce(review_status = 'CONFIRMED' AND event_type = 'AMORTIZATION', false) AS amort,
         coalesce(cash_amount_per_unit, 0) AS cash, coalesce(in_kind_amount_per_unit, 0) AS kind
  FROM (SELECT * REPLACE (
      CASE WHEN {_DAY} % 11 = 0 THEN 'DONE' ELSE review_status END AS review_status,
      CASE WHEN {_DAY} % 2 = 0 THEN quantity_multiplier * 1.5::DOUBLE ELSE quantity_multiplier END AS quantity_multiplier,
      CASE WHEN {_DAY} % 3 = 0 THEN ' ' ELSE confirmation_source END AS confirmation_source,
      CASE WHEN {_DAY} % 5 = 0 THEN total_economic_value_per_unit + 1e-7 ELSE total_economic_value_per_unit END
        AS total_economic_value_per_unit,
      CASE WHEN {_DAY} % 7 = 0 THEN NULL ELSE in_kind_asset_ticker END AS in_kind_asset_ticker) FROM registry)"""
final("registry_checks", "daily", lambda p: D.registry_checks(_spoiled(p)), CHECK, "registry", checks_sql(f"({_SPOILED})", {
    "EVENT_DATE_PRESENT": "event_date IS NULL", "TICKER_PRESENT": "ticker IS NULL",
    "REVIEW_STATUS_PRESENT": "review_status IS NULL",
    "REVIEW_STATUS_DOMAIN": "review_status NOT IN ('PENDING_REVIEW', 'CONFIRMED', 'REJECTED', 'NOT_APPLICABLE')",
    "EVENT_TYPE_DOMAIN": "event_type NOT IN ('UNKNOWN', 'SPLIT', 'REVERSE_SPLIT', 'AMORTIZATION', 'OTHER')",
    "CONFIRMED_TYPE_KNOWN": "conf AND event_type = 'UNKNOWN'",
    "CONFIRMED_SOURCE_PRESENT": "conf AND trim(coalesce(confirmation_source, '')) = ''",
    "CONFIRMED_DATE_PRESENT": "conf AND confirmation_date IS NULL",
    "FIRST_TRADE_PRESENT": "conf AND first_post_event_trade_date IS NULL",
    "EVENT_IS_FIRST_TRADE": "conf AND event_date <> first_post_event_trade_date",
    "RECORD_DATE_NOT_AFTER_TRADE": "conf AND corporate_action_record_date > first_post_event_trade_date",
    "SPLIT_QUANTITY_POSITIVE": "split AND coalesce(quantity_multiplier, 0) <= 0",
    "SPLIT_FACTOR_POSITIVE": "split AND coalesce(price_adjustment_factor, 0) <= 0",
    "SPLIT_RECIPROCAL": "split AND abs(quantity_multiplier * price_adjustment_factor - 1) > 0.01",
    "AMORTIZATION_TOTAL_POSITIVE": "amort AND coalesce(total_economic_value_per_unit, 0) <= 0",
    "AMORTIZATION_CASH_NOT_NEGATIVE": "amort AND cash < 0",
    "AMORTIZATION_IN_KIND_NOT_NEGATIVE": "amort AND kind < 0",
    "AMORTIZATION_COMPONENT_SUM": "amort AND abs(cash + kind - total_economic_value_per_unit) > 1e-8",
    "IN_KIND_ASSET_PRESENT": "amort AND kind > 0 AND trim(coalesce(in_kind_asset_ticker, '')) = ''",
    "IN_KIND_QUANTITY_POSITIVE": "amort AND kind > 0 AND coalesce(in_kind_quantity_per_unit, 0) <= 0",
}, "ticker, event_date"))

_LEGACY = ["ticker", "event_date", "review_status", "event_type", "quantity_multiplier", "price_adjustment_factor",
           "cash_amount_per_unit", "confirmation_source", "confirmation_date", "review_notes"]


def _migrated(p):
    overrides = p.registry.filter("review_status = 'CONFIRMED'").select(
        "ticker", "event_date", "in_kind_amount_per_unit", "total_economic_value_per_unit",
        "in_kind_asset_ticker", "in_kind_quantity_per_unit", "corporate_action_record_date")
    return D.migrate_registry(p.registry.select(*_LEGACY), overrides)


final("registry_migrate", "daily", _migrated, _REGISTRY, "registry", """
  SELECT ticker, event_date, review_status, event_type, quantity_multiplier, price_adjustment_factor,
         cash_amount_per_unit, CASE WHEN conf THEN in_kind_amount_per_unit END AS in_kind_amount_per_unit,
         CASE WHEN conf THEN total_economic_value_per_unit END AS total_economic_value_per_unit,
         CASE WHEN conf THEN in_kind_asset_ticker END AS in_kind_asset_ticker,
         CASE WHEN conf THEN in_kind_quantity_per_unit END AS in_kind_quantity_per_unit,
         CASE WHEN conf THEN corporate_action_record_date END AS corporate_action_record_date,
         CASE WHEN conf THEN event_date END AS corporate_action_effective_date,
         CAST(NULL AS DATE) AS cash_payment_date, CAST(NULL AS DATE) AS in_kind_delivery_date,
         CASE WHEN conf THEN event_date END AS first_post_event_trade_date, confirmation_source, confirmation_date,
         CAST(NULL AS DATE) AS governance_review_date, review_notes
  FROM (SELECT *, review_status = 'CONFIRMED' AS conf FROM registry)""")

final("review_queue", "weekly", lambda p: D.review_queue(p.stored_pending),
      "ticker event_date classification confidence daily_return absolute_daily_return review_priority priority_score",
      "reviewed", """
  SELECT *, CASE review_priority WHEN 'P1' THEN 400.0::DOUBLE WHEN 'P2' THEN 300.0::DOUBLE WHEN 'P3' THEN 200.0::DOUBLE
                 ELSE 100.0::DOUBLE END + abs(daily_return) * 100.0::DOUBLE
            + CASE WHEN factor_match THEN 20.0::DOUBLE ELSE 0.0::DOUBLE END
            + CASE WHEN newly_visible_in_v5_band THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS priority_score
  FROM (SELECT *, abs(daily_return) AS absolute_daily_return,
               CASE WHEN factor_match AND confidence = 'HIGH' THEN 'P1' WHEN factor_match AND confidence = 'MEDIUM'
                    THEN 'P2' WHEN abs(daily_return) >= 0.5 THEN 'P3' ELSE 'P4' END AS review_priority
        FROM reviewed WHERE review_status = 'PENDING_REVIEW')""")

# --- adjusted prices ------------------------------------------------------------
staged("confirmed_actions", "daily", lambda p: A.confirmed_actions(p.reviewed), _REVIEWED, "reviewed",
       "WHERE review_status = 'CONFIRMED'")
# decisions moved one day on: many then have no price row
final("action_coverage", "daily", lambda p: A.actions_without_price(
    p.panel, p.reviewed.withColumn("event_date", F.date_add("event_date", 1))),
      "ticker event_date event_type", "reviewed", """
  SELECT r.ticker, r.event_date + 1 AS event_date, r.event_type FROM reviewed r
  LEFT JOIN panel p ON p.ticker = r.ticker AND p.trade_date = r.event_date + 1
  WHERE r.review_status = 'CONFIRMED' AND p.ticker IS NULL""")
staged("adjustment_factor", "weekly", lambda p: A.adjustment_factor(p.panel, p.reviewed),
       "ticker trade_date close_price structural_adjustment_factor", "adjusted0")
staged("adjusted_prices", "daily", lambda p: A.adjusted_prices(p.panel, p.reviewed), A.OUTPUT, "adjusted")
staged("adjusted_from_registry", "weekly", lambda p: p.adjusted, A.OUTPUT, "adjusted")
staged("economic_returns", "weekly", lambda p: p.adjusted,
       "ticker trade_date daily_return_raw daily_return_adjusted_price daily_return_economic", "adjusted")
_R3 = ("daily_return_raw", "daily_return_adjusted_price", "daily_return_economic")
ADJUSTED_RULES = {
    "FACTOR_POSITIVE": "structural_adjustment_factor <= 0",
    **{f"FINITE_{r.upper()}": f"previous_close_price_raw IS NOT NULL AND NOT coalesce(isfinite({r}), false)" for r in _R3},
    **{f"FIRST_ROW_NULL_{r.upper()}": f"previous_close_price_raw IS NULL AND {r} IS NOT NULL" for r in _R3},
    "COMPONENT_SUM": "abs(cash_amount_per_unit_raw + in_kind_amount_per_unit_raw - corporate_action_value_per_unit_raw) > 1e-8",
    "CASH_ALIAS": "abs(cash_flow_per_unit_adjusted - cash_amount_per_unit_adjusted) > 1e-12",
    "PAYLOAD_ONLY_WHEN_CONFIRMED": "NOT confirmed_action_on_date AND confirmed_event_type IS NOT NULL",
}
final("adjusted_checks", "daily", lambda p: A.adjusted_checks(p.adjusted), CHECK, "adjusted", checks_sql("adjusted", ADJUSTED_RULES, "ticker, trade_date"))
_EFFECT = (
    "ticker trade_date confirmed_event_type structural_adjustment_factor previous_close_price_raw close_price_raw "
    "previous_close_price_adjusted close_price_adjusted cash_amount_per_unit_adjusted "
    "in_kind_amount_per_unit_adjusted corporate_action_value_per_unit_adjusted daily_return_raw "
    "daily_return_adjusted_price daily_return_economic structural_effect economic_effect")
final("event_effect", "weekly", lambda p: A.event_effect(p.adjusted), _EFFECT, "adjusted", """
  SELECT *, daily_return_adjusted_price - daily_return_raw AS structural_effect,
         daily_return_economic - daily_return_adjusted_price AS economic_effect
  FROM adjusted WHERE confirmed_action_on_date""")
final("threshold_summary", "weekly", lambda p: A.threshold_summary(p.adjusted),
      "threshold_pct raw_count adjusted_price_count economic_count removed_by_price_adjustment "
      "removed_by_economic_adjustment", "adjusted", f"""
  SELECT *, raw_count - adjusted_price_count AS removed_by_price_adjustment,
         raw_count - economic_count AS removed_by_economic_adjustment
  FROM (SELECT t * 100.0::DOUBLE AS threshold_pct, count(*) FILTER (abs(daily_return_raw) >= t) AS raw_count,
               count(*) FILTER (abs(daily_return_adjusted_price) >= t) AS adjusted_price_count,
               count(*) FILTER (abs(daily_return_economic) >= t) AS economic_count
        FROM adjusted, (SELECT CAST(unnest({list(A.IMPACT_THRESHOLDS)}) AS DOUBLE) AS t) GROUP BY t)""")
final("changed_returns", "weekly", lambda p: A.changed_returns(p.adjusted),
      "ticker trade_date daily_return_raw daily_return_adjusted_price daily_return_economic event_type_on_date "
      "return_difference", "adjusted", """
  SELECT *, daily_return_economic - daily_return_raw AS return_difference FROM adjusted
  WHERE abs(daily_return_economic - daily_return_raw) > 1e-12""")
final("pending_summary", "weekly", lambda p: A.pending_summary(p.adjusted),
      "ticker trade_date close_price_raw previous_close_price_raw daily_return_raw daily_return_economic "
      "discontinuity_confidence_on_date absolute_raw_return", "adjusted",
      "SELECT *, abs(daily_return_raw) AS absolute_raw_return FROM adjusted WHERE pending_review_on_date")

# --- history and quality ----------------------------------------------------------
staged("price_history", "daily", lambda p: p.history, H.output_columns(), "history")
staged("rolling_return", "weekly", lambda p: p.history, "ticker trade_date return_5d return_10d return_20d", "history")
HISTORY_RULES = {
    **{k: v for n in C.DEFAULT_WINDOWS for k, v in {
        f"RETURN_{n}D_NULL_BEFORE_FULL": f"observations_count < {n + 1} AND return_{n}d IS NOT NULL",
        f"MA_{n}_NULL_BEFORE_FULL": f"observations_count < {n} AND ma_{n} IS NOT NULL",
        f"MA_{n}_PRESENT_WHEN_FULL": f"observations_count >= {n} AND ma_{n} IS NULL",
        f"PCT_ALIAS_{n}": f"abs(return_{n}d * 100 - return_{n}d_pct) > 1e-12"}.items()},
    "RETURN_ALIAS": "abs(daily_return - daily_return_economic) > 1e-12",
    **{f"{c.upper()}_ALIAS": f"abs({c} - {c}_adjusted) > 1e-12" for c in C.PRICES},
}
final("history_checks", "daily", lambda p: H.history_checks(p.history), CHECK, "history", checks_sql("history", HISTORY_RULES, "ticker, trade_date"))
staged("session_calendar", "weekly", lambda p: p.calendar, "trade_date session_index", "calendar")
_GAPS = ("ticker trade_date session_index previous_trade_date previous_session_index trading_gap_calendar_days "
         "trading_gap_sessions trading_gap_class")
staged("session_gaps", "weekly", lambda p: Q.session_gaps(p.adjusted, p.calendar), _GAPS, "gaps")
staged("price_quality", "daily", lambda p: p.quality, Q.OUTPUT, "quality")
final("remaining_extremes", "weekly", lambda p: Q.remaining_extremes(p.adjusted),
      "ticker trade_date previous_trade_date close_price_raw daily_return_raw daily_return_economic "
      "absolute_economic_return trading_gap_calendar_days trading_gap_sessions trading_gap_class", "gaps",
      "SELECT *, abs(daily_return_economic) AS absolute_economic_return FROM gaps WHERE abs(daily_return_economic) >= 0.5")
final("detector_escapes", "weekly", lambda p: Q.detector_escapes(p.adjusted, p.reviewed),
      "ticker trade_date daily_return_raw daily_return_economic classification confidence review_status detector_escape",
      "adjusted", """
  SELECT a.ticker, a.trade_date, a.daily_return_raw, a.daily_return_economic, r.classification, r.confidence,
         r.review_status, r.ticker IS NULL AS detector_escape
  FROM adjusted a LEFT JOIN reviewed r ON r.ticker = a.ticker AND r.event_date = a.trade_date
  WHERE abs(a.daily_return_economic) >= 0.5""")
_PREV = "OVER (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
_LIQUIDITY = "SELECT *, " + ", ".join(
    f"avg(trades_quantity) {w} AS trades_avg_prev_{n}, "
    f"median(CAST(trades_quantity AS DOUBLE)) {w} AS trades_median_prev_{n}, "
    f"CASE WHEN count(change) {w} >= 2 THEN stddev_samp(change) {w} END AS price_volatility_prev_{n}"
    for n in Q.LIQUIDITY_WINDOWS for w in [_PREV.format(n=n)]) + """
  FROM (SELECT *, close_price / nullif(lag(close_price) OVER (PARTITION BY ticker ORDER BY trade_date), 0) - 1 AS change
        FROM history)"""
_LIQ = [f"{m}_prev_{n}" for n in Q.LIQUIDITY_WINDOWS for m in ("trades_avg", "trades_median", "price_volatility")]
final("lagged_liquidity", "daily", lambda p: Q.lagged_liquidity(p.history),
      ["ticker", "trade_date", "trades_quantity", *_LIQ], "history", _LIQUIDITY)


def _cases(p):
    return Q.case_dataset(p.quality.filter("ml_quality_status = 'REVIEW'"), p.quality, p.history)


final("case_dataset", "daily", _cases,
      ["ticker", "trade_date", "quality_flags", "close_price", "trades_quantity", *_LIQ,
       "trades_vs_avg_5", "trades_vs_avg_20", "diagnostic_class"], "quality", f"""
  SELECT q.ticker, q.trade_date, q.quality_flags, l.close_price, l.trades_quantity,
         {", ".join("l." + c for c in _LIQ)},
         l.trades_quantity / nullif(trades_avg_prev_5, 0) AS trades_vs_avg_5,
         l.trades_quantity / nullif(trades_avg_prev_20, 0) AS trades_vs_avg_20,
         CASE WHEN q.trading_gap_sessions > 20 THEN 'STRONG_LIQUIDITY_GAP_SIGNAL'
              WHEN l.close_price <= 1 AND q.flag_extreme_return THEN 'STRONG_MICROLIQUIDITY_SIGNAL'
              WHEN l.trades_quantity <= 5 AND q.flag_extreme_return THEN 'LOW_TRADING_ACTIVITY_SIGNAL'
              ELSE 'UNRESOLVED' END AS diagnostic_class
  FROM quality q JOIN ({_LIQUIDITY}) l USING (ticker, trade_date) WHERE q.ml_quality_status = 'REVIEW'""")

# --- features ---------------------------------------------------------------------
staged("ml_features", "weekly", lambda p: p.features, FE.output_columns(), "features")
final("feature_windows", "daily", lambda p: FE.feature_windows(p.history),
      "feature_windows row_count position window_size", "history", """
  SELECT feature_windows, row_count, CAST(i - 1 AS INT) AS position,
         CAST(string_split(feature_windows, ',')[i] AS INT) AS window_size
  FROM (SELECT feature_windows, count(*) AS row_count FROM history GROUP BY 1), range(1, 10) t(i)
  WHERE i <= len(string_split(feature_windows, ','))""")
_FN = C.feature_names()
FEATURE_RULES = {
    "FEATURE_DATE_PRESENT": "feature_date IS NULL", "TICKER_PRESENT": "trim(coalesce(ticker, '')) = ''",
    **{f"{n.upper()}_FINITE": f"{n} IS NOT NULL AND NOT isfinite({n})" for n in _FN},
    "READY_HAS_FULL_WINDOW": "feature_ready AND observations_count < 21",
    "READY_HAS_RETURN": "feature_ready AND daily_return IS NULL",
}
final("feature_checks", "daily", lambda p: FE.feature_checks(p.features), CHECK, "features", checks_sql("features", FEATURE_RULES, "ticker, feature_date"))
_TRIED = _FN + ["close_price_raw", "daily_return_pct", "observations_count"]
final("feature_contract", "daily", lambda p: FE.feature_contract(p.features, _TRIED),
      "feature_name is_numeric is_forbidden non_finite status", "features", " UNION ALL ".join(
          f"SELECT '{n}' AS feature_name, true AS is_numeric, {str(C.is_forbidden_feature(n)).lower()} AS is_forbidden, "
          f"count(*) FILTER (NOT isfinite(CAST({n} AS DOUBLE))) AS non_finite, "
          f"'{'FAIL' if C.is_forbidden_feature(n) else 'PASS'}' AS status FROM features" for n in _TRIED))
staged("latest_features", "weekly", lambda p: FE.latest_features(p.features), ["ticker", "feature_date", *_FN,
       "feature_ready"], "features", "WHERE feature_date = (SELECT max(feature_date) FROM features)")

# --- eligibility and training -------------------------------------------------------
final("blocking_signals", "weekly", lambda p: EL.blocking_signals(p.quality),
      "ticker trade_date blocking_signal blocking_price_quality_review blocking_rejected_ca_review "
      "informational_extreme_return informational_confirmed_ca informational_confirmed_economic_ca "
      "informational_in_kind_ca", "signals0", """
  SELECT *, review AS blocking_price_quality_review, rejected AS blocking_rejected_ca_review,
         extreme AS informational_extreme_return, confirmed_ca AS informational_confirmed_ca,
         economic_ca AS informational_confirmed_economic_ca, in_kind_ca AS informational_in_kind_ca FROM signals0""")
_RUN = dict(zip(EL.RUNNING, ("blocking_signal", "extreme", "review", "rejected", "confirmed_ca", "economic_ca", "in_kind_ca")))
final("temporal_signals", "weekly", lambda p: EL.temporal_signals(p.quality),
      ["ticker", "trade_date", *EL.LOOKBACK, *EL.RUNNING, "feature_window_clean"], "signals",
      "SELECT *, " + ", ".join(f"run_{v} AS {k}" for k, v in _RUN.items()) + " FROM signals")
staged("sample_universe", "weekly", lambda p: EL.sample_universe(p.features, p.quality, p.calendar),
       "ticker feature_date target_date feature_global_session_index target_global_session_index target_horizon "
       "target_horizon_semantics", "samples")
staged("ml_eligibility", "weekly", lambda p: p.eligibility, EL.OUTPUT, "eligibility")
staged("return_curve", "weekly", lambda p: T.return_curve(p.history),
       "ticker trade_date economic_growth_factor cumulative_economic_log_growth", "curve")
staged("training_dataset", "weekly", lambda p: p.training, T.output_columns(), "training")
# --- contracts on tables with planted violations: each rule is broken on some days -----------------
def twice(df, condition):
    """The rows, those that meet the condition twice; the input is read once."""
    copies = F.when(condition, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("__copy", F.explode(copies)).drop("__copy")


def _broken(df, date, changes):
    """``changes``: column -> (day divisor, value); a fifth of the first ticker's rows is there twice."""
    day = F.unix_date(date)
    df = df.withColumns({c: F.when(day % n == 0, value).otherwise(F.col(c)) for c, (n, value) in changes.items()})
    return twice(df, day % 35 == 3)


def _broken_sql(table, date, changes):
    day = f"date_diff('day', DATE '1970-01-01', CAST({date} AS DATE))"
    parts = ", ".join(f"CASE WHEN {day} % {n} = 0 THEN {value} ELSE {c} END AS {c}" for c, (n, value) in changes.items())
    body = f"SELECT * REPLACE ({parts}) FROM ({table})"
    return f"({body} UNION ALL SELECT * FROM ({body}) WHERE {day} % 35 = 3)"


_QUEUE_SQL = """SELECT *, abs(daily_return) AS absolute_daily_return, 'P1' AS review_priority, 100.0::DOUBLE AS priority_score
                FROM reviewed WHERE review_status = 'PENDING_REVIEW'"""
final("queue_checks", "weekly", lambda p: D.queue_checks(_broken(D.review_queue(p.stored_pending), "event_date", {
    "ticker": (3, F.lit(None)), "classification": (4, F.lit(None)), "review_status": (5, F.lit("DONE")), "review_priority": (2, F.lit("P9")),
    "absolute_daily_return": (7, F.lit(-1.0)), "priority_score": (8, F.lit(0.0)), "daily_return": (9, F.lit(None))})),
      CHECK, "reviewed", checks_sql(_broken_sql(_QUEUE_SQL, "event_date", {
          "ticker": (3, "NULL"), "classification": (4, "NULL"), "review_status": (5, "'DONE'"), "review_priority": (2, "'P9'"),
          "absolute_daily_return": (7, "-1.0::DOUBLE"), "priority_score": (8, "0.0::DOUBLE"), "daily_return": (9, "NULL")}), {
              "TICKER_PRESENT": "trim(coalesce(ticker, '')) = ''", "EVENT_DATE_PRESENT": "event_date IS NULL", "DAILY_RETURN_PRESENT": "daily_return IS NULL",
              "CLASSIFIED": "classification IS NULL OR confidence IS NULL", "STATUS_PENDING": "review_status IS DISTINCT FROM 'PENDING_REVIEW'",
              "PRIORITY_DOMAIN": "review_priority NOT IN ('P1', 'P2', 'P3', 'P4')", "ABSOLUTE_RETURN_CONSISTENT": "absolute_daily_return <> abs(daily_return)",
              "SCORE_POSITIVE": "NOT priority_score > 0"}, "ticker, event_date"))
final("price_quality_checks", "daily", lambda p: Q.price_quality_checks(_broken(p.quality, "trade_date", {
    "ticker": (11, F.lit(" ")), "close_price_adjusted": (3, F.lit(None)), "trading_gap_class": (4, F.lit(None)), "ml_quality_status": (5, F.lit("BAD")),
    "flag_extreme_return": (6, ~F.col("flag_extreme_return")), "trading_gap_sessions": (7, F.lit(-1)), "previous_trade_date": (8, F.col("trade_date")),
    "price_quality_version": (9, F.lit(""))})), CHECK, "quality", checks_sql(_broken_sql("SELECT * FROM quality", "trade_date", {
        "ticker": (11, "' '"), "close_price_adjusted": (3, "NULL"), "trading_gap_class": (4, "NULL"), "ml_quality_status": (5, "'BAD'"),
        "flag_extreme_return": (6, "NOT flag_extreme_return"), "trading_gap_sessions": (7, "-1"), "previous_trade_date": (8, "trade_date"),
        "price_quality_version": (9, "''")}), {
            "TICKER_PRESENT": "trim(coalesce(ticker, '')) = ''", "TRADE_DATE_PRESENT": "trade_date IS NULL",
            "CLOSE_PRESENT": "close_price_raw IS NULL OR close_price_adjusted IS NULL", "GAP_CLASS_PRESENT": "trading_gap_class IS NULL",
            "STATUS_DOMAIN": "ml_quality_status NOT IN ('PASS', 'REVIEW')",
            "EXTREME_FLAG_NAMED": "flag_extreme_return <> list_contains(string_split(quality_flags, '|'), 'EXTREME_RETURN')",
            "GAPS_NOT_NEGATIVE": "trading_gap_sessions < 0", "PREVIOUS_DATE_EARLIER": "previous_trade_date >= trade_date",
            "VERSION_PRESENT": "trim(price_quality_version) = '' OR trim(price_quality_source) = ''"}, "ticker, trade_date"))
final("eligibility_checks", "weekly", lambda p: EL.eligibility_checks(_broken(p.eligibility, "feature_date", {
    "ticker": (11, F.lit(None)), "target_date": (3, F.col("feature_date")), "ml_eligible": (2, ~F.col("ml_eligible")),
    "blocking_target_horizon_count": (5, F.lit(-1))})), CHECK, "eligibility", checks_sql(_broken_sql("SELECT * FROM eligibility", "feature_date", {
        "ticker": (11, "NULL"), "target_date": (3, "feature_date"), "ml_eligible": (2, "NOT ml_eligible"), "blocking_target_horizon_count": (5, "-1")}), {
            "TICKER_PRESENT": "trim(coalesce(ticker, '')) = ''", "FEATURE_DATE_PRESENT": "feature_date IS NULL", "TARGET_AFTER_FEATURE": "target_date <= feature_date",
            "ELIGIBLE_IS_CLEAN": "ml_eligible <> (feature_window_clean AND target_horizon_clean)",
            "REASON_FOLLOWS_VERDICT": "ml_eligible <> (ml_ineligibility_reason = 'NONE')",
            "HORIZON_COUNT_FOLLOWS": "target_horizon_clean <> (blocking_target_horizon_count = 0)", "COUNTS_NOT_NEGATIVE": "blocking_target_horizon_count < 0"},
        "ticker, feature_date"))
final("horizon_check", "weekly", lambda p: T.horizon_check(p.eligibility, p.calendar),
      "sample_rows outside_calendar matching_rows match_rate min_calendar_delay max_calendar_delay mean_calendar_delay",
      "eligibility", """
  SELECT count(*) AS sample_rows, count(*) FILTER (c.trade_date IS NULL) AS outside_calendar,
         count(*) FILTER (x.trade_date = target_date) AS matching_rows,
         avg((coalesce(x.trade_date = target_date, false))::INT) AS match_rate,
         min(CAST(target_date - feature_date AS INT)) AS min_calendar_delay,
         max(CAST(target_date - feature_date AS INT)) AS max_calendar_delay,
         avg(target_date - feature_date) AS mean_calendar_delay
  FROM eligibility e LEFT JOIN calendar c ON c.trade_date = e.feature_date
       LEFT JOIN calendar x ON x.session_index = c.session_index + 5""")

# --- split --------------------------------------------------------------------------
_LINEAGE = ["split_version", "validation_days", "test_days", "split_source_training_dataset_version",
            "split_requires_ml_eligible", "split_purge_semantics", "test_holdout_policy"]
staged("split_boundaries", "weekly", lambda p: p.boundaries, "validation_start test_start feature_dates", "bounds")
staged("temporal_split", "weekly", lambda p: p.sample_split,
       ["ticker", "feature_date", "target_date", "split_name", "validation_start", "test_start", *_FN,
        "target_return_next_5d", *_LINEAGE], "split")
_REG = [f"{n}_{k}" for k in ("region_before_purge", "purged") for n in ("train", "validation", "test")]
final("purge_diagnostics", "weekly", lambda p: S.purge_diagnostics(p.stored_samples),
      ["eligible_total", *_REG, "total_purged", "assigned_total"], "labelled",
      "SELECT count(*) AS eligible_total, " + ", ".join(
          f"count(*) FILTER (split_region = '{n}') AS {n}_region_before_purge, "
          f"count(*) FILTER (split_region = '{n}' AND split_name IS NULL) AS {n}_purged"
          for n in ("train", "validation", "test")) + """,
         count(*) FILTER (split_name IS NULL) AS total_purged,
         count(*) FILTER (split_name IS NOT NULL) AS assigned_total FROM labelled""")
_KEYS = "SELECT ticker, feature_date FROM split WHERE split_name = "
final("split_overlap", "weekly", lambda p: S.split_overlap(p.sample_split), "left_split right_split shared_keys", "split",
      " UNION ALL ".join(
          f"SELECT '{a}' AS left_split, '{b}' AS right_split, count(*) AS shared_keys "
          f"FROM ({_KEYS}'{a}' INTERSECT {_KEYS}'{b}')"
          for a, b in (("train", "validation"), ("train", "test"), ("validation", "test"))))
SPLIT_RULES = {
    "TRAIN_FEATURE_BEFORE_VALIDATION": "split_name = 'train' AND feature_date >= validation_start",
    "TRAIN_TARGET_BEFORE_VALIDATION": "split_name = 'train' AND target_date >= validation_start",
    "VALIDATION_FEATURE_NOT_EARLY": "split_name = 'validation' AND feature_date < validation_start",
    "VALIDATION_FEATURE_BEFORE_TEST": "split_name = 'validation' AND feature_date >= test_start",
    "VALIDATION_TARGET_BEFORE_TEST": "split_name = 'validation' AND target_date >= test_start",
    "TEST_FEATURE_NOT_EARLY": "split_name = 'test' AND feature_date < test_start",
    "ROWS_ELIGIBLE": "NOT ml_eligible",
}
final("split_checks", "weekly", lambda p: S.split_checks(p.sample_split), CHECK, "split", checks_sql("split", SPLIT_RULES, "ticker, feature_date"))
final("chronological_order", "weekly", lambda p: S.chronological_order(p.sample_split),
      "split_name sample_rows first_feature_date last_feature_date last_target_date starts_after_previous_targets",
      "split", """
  SELECT *, coalesce(first_feature_date > lag(last_target_date) OVER (ORDER BY
            CASE split_name WHEN 'train' THEN 1 WHEN 'validation' THEN 2 ELSE 3 END), true) AS starts_after_previous_targets
  FROM (SELECT split_name, count(*) AS sample_rows, min(feature_date) AS first_feature_date,
               max(feature_date) AS last_feature_date, max(target_date) AS last_target_date FROM split GROUP BY 1)""")

# --- walk-forward ---------------------------------------------------------------------
final("walk_forward_folds", "weekly", lambda p: WF.walk_forward_folds(p.universe),
      "fold_id train_rows train_feature_dates train_start train_end train_target_max train_tickers validation_rows "
      "validation_tickers validation_start validation_end validation_target_min validation_target_max "
      "validation_feature_dates purged enough_history", "members", f"""
  SELECT *, train_target_max < validation_start AS purged,
         train_feature_dates >= {C.MIN_TRAIN_SESSIONS} AS enough_history
  FROM (SELECT fold_id, count(*) FILTER (role = 'train') AS train_rows,
               count(DISTINCT feature_date) FILTER (role = 'train') AS train_feature_dates,
               min(feature_date) FILTER (role = 'train') AS train_start,
               max(feature_date) FILTER (role = 'train') AS train_end,
               max(target_date) FILTER (role = 'train') AS train_target_max,
               count(DISTINCT ticker) FILTER (role = 'train') AS train_tickers,
               count(*) FILTER (role = 'validation') AS validation_rows,
               count(DISTINCT ticker) FILTER (role = 'validation') AS validation_tickers,
               min(feature_date) FILTER (role = 'validation') AS validation_start,
               max(feature_date) FILTER (role = 'validation') AS validation_end,
               min(target_date) FILTER (role = 'validation') AS validation_target_min,
               max(target_date) FILTER (role = 'validation') AS validation_target_max,
               count(DISTINCT feature_date) FILTER (role = 'validation') AS validation_feature_dates
        FROM members GROUP BY fold_id)""")
final("fold_members", "weekly", lambda p: WF.fold_members(p.universe), "fold_id role ticker feature_date target_date",
      "members", "SELECT * FROM members")
final("target_profile", "weekly", lambda p: WF.target_profile(p.universe),
      "fold_id role target_mean positive_share target_median", "members", """
  SELECT fold_id, role, avg(target_return_next_5d) AS target_mean, avg((target_return_next_5d > 0)::INT) AS positive_share,
         median(target_return_next_5d) AS target_median FROM members GROUP BY 1, 2""")
staged("majority_baseline", "weekly", lambda p: WF.majority_baseline(p.universe),
       "fold_id train_positive_share train_target_mean validation_positive_share validation_rows majority_direction "
       "majority_directional_accuracy", "majority")
_METRICS = ("fold_id model rows mae rmse r2 directional_accuracy directional_lift prediction_mean prediction_min "
            "prediction_max prediction_median majority_direction majority_directional_accuracy")


def _dummy_metrics(p):
    return WF.fold_metrics(WF.mean_predictions(p.universe), WF.majority_baseline(p.universe))


staged("fold_metrics", "weekly", _dummy_metrics, _METRICS, "metrics")
_M5 = ("mae", "rmse", "r2", "directional_accuracy", "directional_lift")
_SUMMARY = "SELECT model, count(*) AS folds, " + ", ".join(
    [f"avg({m}) AS {m}_mean, median({m}) AS {m}_median" for m in _M5]
    + [f"stddev_pop({m}) AS {m}_std" for m in ("mae", "rmse")]
    + [f"count(*) FILTER ({m} > 0) AS positive_{m}_folds, count(*) FILTER ({m} <= 0) AS non_positive_{m}_folds"
       for m in ("directional_lift", "r2")]) + " FROM metrics GROUP BY model"
_SUMMARY_COLUMNS = (["model", "folds"] + [f"{m}_{k}" for m in _M5 for k in ("mean", "median")] + ["mae_std", "rmse_std"]
                    + [f"{s}_{m}_folds" for m in ("directional_lift", "r2") for s in ("positive", "non_positive")])
final("model_summary", "weekly", lambda p: WF.model_summary(_dummy_metrics(p)), _SUMMARY_COLUMNS, "metrics", _SUMMARY)
_BASE = "model rows mae rmse r2 directional_accuracy directional_lift prediction_mean prediction_min prediction_max"
final("split_majority", "weekly", lambda p: WF.split_majority(p.sample_split),
      "direction positive_rate_train non_positive_rate_train train_accuracy validation_accuracy train_target_mean",
      "split", """
  SELECT CASE WHEN a > 1 - a THEN 'POSITIVE' ELSE 'NON_POSITIVE' END AS direction, a AS positive_rate_train,
         1 - a AS non_positive_rate_train, greatest(a, 1 - a) AS train_accuracy,
         CASE WHEN a > 1 - a THEN b ELSE 1 - b END AS validation_accuracy, m AS train_target_mean
  FROM (SELECT avg((target_return_next_5d > 0)::INT) FILTER (split_name = 'train') AS a,
               avg((target_return_next_5d > 0)::INT) FILTER (split_name = 'validation') AS b,
               avg(target_return_next_5d) FILTER (split_name = 'train') AS m FROM split)""")
_PRED = """
  SELECT 'dummy_mean' AS model, ticker, feature_date, target_return_next_5d,
         (SELECT avg(target_return_next_5d) FROM split WHERE split_name = 'train') AS prediction
  FROM split WHERE split_name = 'validation'"""
final("baseline_metrics", "weekly", lambda p: WF.baseline_metrics(
    WF.mean_baseline_predictions(p.sample_split), WF.split_majority(p.sample_split)), _BASE, "split", f"""
  SELECT model, count(*) AS rows, avg(abs(y - prediction)) AS mae, sqrt(avg((y - prediction) * (y - prediction))) AS rmse,
         1 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)) AS r2,
         avg(((y > 0) = (prediction > 0))::INT) AS directional_accuracy,
         avg(((y > 0) = (prediction > 0))::INT) - (
            SELECT CASE WHEN a > 1 - a THEN b ELSE 1 - b END FROM (
              SELECT avg((target_return_next_5d > 0)::INT) FILTER (split_name = 'train') AS a,
                     avg((target_return_next_5d > 0)::INT) FILTER (split_name = 'validation') AS b FROM split))
           AS directional_lift,
         avg(prediction) AS prediction_mean, min(prediction) AS prediction_min, max(prediction) AS prediction_max
  FROM (SELECT *, target_return_next_5d AS y FROM ({_PRED})) GROUP BY model""")
# --- diagnostics ------------------------------------------------------------------------
_STATS = "split_name feature_name rows nulls non_finite finite_rows mean std min max p01 p05 p25 median p75 p95 p99"
_STATS_SQL = " UNION ALL ".join(
    f"SELECT split_name, '{c}' AS feature_name, count(*) AS rows, count(*) - count({c}) AS nulls, CAST(0 AS BIGINT) AS non_finite, "
    f"count({c}) AS finite_rows, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, "
    + ", ".join(f"quantile_cont({c}, {q}) AS {n}" for n, q in DG.FEATURE_QUANTILES.items())
    + " FROM split GROUP BY split_name" for c in _FN)
final("feature_stats", "weekly", lambda p: DG.feature_stats(p.stored_split, _FN), _STATS, "split", _STATS_SQL)
_DRIFT = ("feature_name train_mean validation_mean mean_delta train_median validation_median median_delta train_std "
          "validation_std std_ratio train_p01 validation_p01 train_p99 validation_p99 train_nulls validation_nulls smd "
          "abs_smd smd_class")
final("feature_drift", "weekly", lambda p: DG.feature_drift(DG.feature_stats(p.stored_split, _FN)), _DRIFT, "split", f"""
  SELECT *, abs(smd) AS abs_smd, CASE WHEN smd IS NULL THEN 'UNDEFINED' WHEN abs(smd) < 0.10 THEN 'LOW'
            WHEN abs(smd) < 0.25 THEN 'MODERATE' WHEN abs(smd) < 0.50 THEN 'HIGH' ELSE 'VERY_HIGH' END AS smd_class
  FROM (SELECT t.feature_name, t.mean AS train_mean, v.mean AS validation_mean, v.mean - t.mean AS mean_delta,
               t.median AS train_median, v.median AS validation_median, v.median - t.median AS median_delta,
               t.std AS train_std, v.std AS validation_std, v.std / nullif(t.std, 0) AS std_ratio,
               t.p01 AS train_p01, v.p01 AS validation_p01, t.p99 AS train_p99, v.p99 AS validation_p99,
               t.nulls AS train_nulls, v.nulls AS validation_nulls,
               (v.mean - t.mean) / nullif(sqrt((t.std * t.std + v.std * v.std) / 2), 0) AS smd
        FROM ({_STATS_SQL}) t JOIN ({_STATS_SQL}) v ON v.feature_name = t.feature_name
        WHERE t.split_name = 'train' AND v.split_name = 'validation')""")
_Y = "target_return_next_5d"
final("target_distribution", "weekly", lambda p: DG.target_distribution(p.stored_split),
      ["split_name", "rows", "mean", "std", "min", "max", *DG.TARGET_QUANTILES], "split",
      f"SELECT split_name, count(*) AS rows, avg({_Y}) AS mean, stddev_samp({_Y}) AS std, min({_Y}) AS min, max({_Y}) AS max, "
      + ", ".join(f"quantile_cont({_Y}, {q}) AS {n}" for n, q in DG.TARGET_QUANTILES.items())
      + " FROM split GROUP BY split_name")
final("target_thresholds", "weekly", lambda p: DG.target_thresholds(p.sample_split),
      "split_name direction threshold sample_count share", "split", " UNION ALL ".join(
          f"SELECT split_name, '{d}' AS direction, CAST({t} AS DOUBLE) AS threshold, count(*) FILTER ({_Y} {op} {s}{t}) "
          f"AS sample_count, count(*) FILTER ({_Y} {op} {s}{t}) / count(*) AS share FROM split GROUP BY split_name"
          for d, op, s, ts in (("loss", "<=", "-", DG.LOSS_THRESHOLDS), ("gain", ">=", "", DG.GAIN_THRESHOLDS)) for t in ts))
_ORDERS = {"negative": f"{_Y}", "positive": f"{_Y} DESC", "absolute": f"abs({_Y}) DESC"}
final("trimmed_mean", "weekly", lambda p: DG.trimmed_mean(p.stored_split), "direction removed trimmed_mean original_mean",
      "split", " UNION ALL ".join(
          f"SELECT '{d}' AS direction, {n} AS removed, avg({_Y}) FILTER (rn > {n}) AS trimmed_mean, avg({_Y}) AS original_mean "
          f"FROM (SELECT {_Y}, row_number() OVER (ORDER BY {o}) AS rn FROM split) HAVING count(*) > {n}"
          for d, o in _ORDERS.items() for n in DG.TRIM_SIZES))
final("loss_concentration", "weekly", lambda p: DG.loss_concentration(p.stored_split),
      "ticker occurrences mean_target min_target first_feature_date last_feature_date share_of_loss_events", "split", f"""
  SELECT *, occurrences / (SELECT count(*) FROM split WHERE {_Y} <= -0.1) AS share_of_loss_events
  FROM (SELECT ticker, count(*) AS occurrences, avg({_Y}) AS mean_target, min({_Y}) AS min_target,
               min(feature_date) AS first_feature_date, max(feature_date) AS last_feature_date
        FROM split WHERE {_Y} <= -0.1 GROUP BY ticker)
  ORDER BY occurrences DESC, min_target, ticker LIMIT 20""")
final("ticker_distribution", "weekly", lambda p: DG.ticker_distribution(p.sample_split),
      "split_name tickers negative_mean_tickers positive_mean_tickers zero_mean_tickers mean_of_medians max_observations",
      "split", f"""
  SELECT split_name, count(*) AS tickers, count(*) FILTER (m < 0) AS negative_mean_tickers,
         count(*) FILTER (m > 0) AS positive_mean_tickers, count(*) FILTER (m = 0) AS zero_mean_tickers,
         avg(md) AS mean_of_medians, max(n) AS max_observations
  FROM (SELECT split_name, ticker, avg({_Y}) AS m, median({_Y}) AS md, count(*) AS n FROM split GROUP BY 1, 2)
  GROUP BY split_name""")
_SUM = ["mean", "median", "std", "positive_rate", "loss_5_rate", "loss_10_rate", "loss_20_rate"]
_SUM_SQL = f"""
  SELECT split_name, count(*) AS rows, count(DISTINCT ticker) AS tickers, avg({_Y}) AS mean, median({_Y}) AS median,
         stddev_samp({_Y}) AS std, avg(({_Y} > 0)::INT) AS positive_rate, avg(({_Y} <= -0.05)::INT) AS loss_5_rate,
         avg(({_Y} <= -0.1)::INT) AS loss_10_rate, avg(({_Y} <= -0.2)::INT) AS loss_20_rate FROM split GROUP BY split_name"""
final("split_summary", "weekly", lambda p: DG.split_summary(p.stored_split), ["split_name", "rows", "tickers", *_SUM], "split", _SUM_SQL)
final("split_deltas", "weekly", lambda p: DG.split_deltas(DG.split_summary(p.stored_split)),
      "metric train_value validation_value delta", "split", f"""
  SELECT metric, max(v) FILTER (split_name = 'train') AS train_value,
         max(v) FILTER (split_name = 'validation') AS validation_value,
         max(v) FILTER (split_name = 'validation') - max(v) FILTER (split_name = 'train') AS delta
  FROM (""" + " UNION ALL ".join(f"SELECT split_name, '{m}' AS metric, {m} AS v FROM ({_SUM_SQL})" for m in _SUM)
      + ") GROUP BY metric")
_FOCUS = ["FD1", "FD2"]
_AUDIT = f"""SELECT ticker, feature_date, target_date, {_Y} FROM split
             WHERE split_name = 'validation' AND (ticker IN ('FD1', 'FD2') OR {_Y} <= -0.2)"""


def _audit(p):
    return DG.audit_samples(p.sample_split.filter("split_name = 'validation'"), _FOCUS)


final("audit_samples", "weekly", _audit, f"ticker feature_date target_date {_Y}", "split", _AUDIT)
final("context_window", "weekly", lambda p: DG.context_window(_audit(p), p.adjusted),
      "ticker feature_date target_date trade_date inside close_price_adjusted daily_return_raw daily_return_economic",
      "split", f"""
  SELECT s.ticker, s.feature_date, s.target_date, a.trade_date, a.close_price_adjusted, a.daily_return_raw,
         a.daily_return_economic, a.trade_date BETWEEN s.feature_date AND s.target_date AS inside
  FROM (SELECT s.*, f.rn AS r0, t.rn AS r1 FROM ({_AUDIT}) s
        JOIN (SELECT ticker, trade_date, row_number() OVER (PARTITION BY ticker ORDER BY trade_date) AS rn FROM adjusted) f
          ON f.ticker = s.ticker AND f.trade_date = s.feature_date
        JOIN (SELECT ticker, trade_date, row_number() OVER (PARTITION BY ticker ORDER BY trade_date) AS rn FROM adjusted) t
          ON t.ticker = s.ticker AND t.trade_date = s.target_date) s
  JOIN (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date) AS rn FROM adjusted) a
    ON a.ticker = s.ticker AND a.rn BETWEEN r0 - 5 AND r1 + 5""")
_PATH = f"""
  SELECT s.ticker, s.feature_date, s.target_date, count(*) AS path_rows,
         count(*) FILTER (abs(daily_return_raw) >= 0.2) AS large_raw_moves,
         count(*) FILTER (abs(daily_return_economic) >= 0.2) AS large_economic_moves,
         max(abs(daily_return_raw)) AS max_abs_raw_return, max(abs(daily_return_economic)) AS max_abs_economic_return,
         bool_or(review_status_on_date = 'PENDING_REVIEW') AS has_pending,
         bool_or(review_status_on_date = 'CONFIRMED') AS has_confirmed,
         bool_or(review_status_on_date = 'REJECTED') AS has_rejected
  FROM ({_AUDIT}) s JOIN adjusted a ON a.ticker = s.ticker AND a.trade_date BETWEEN s.feature_date AND s.target_date
  GROUP BY 1, 2, 3"""
_PATH_COLUMNS = ("ticker feature_date target_date path_rows large_raw_moves large_economic_moves max_abs_raw_return "
                 "max_abs_economic_return has_pending has_confirmed has_rejected")
final("path_metrics", "weekly", lambda p: DG.path_metrics(_audit(p), p.adjusted), _PATH_COLUMNS, "split", _PATH)
final("audit_class", "weekly", lambda p: DG.audit_class(DG.path_metrics(_audit(p), p.adjusted)),
      "ticker feature_date target_date audit_class", "split", f"""
  SELECT *, CASE WHEN has_pending THEN 'REVIEW_REQUIRED_PENDING_EVENT' WHEN has_confirmed THEN 'KNOWN_CORPORATE_ACTION'
            WHEN large_economic_moves > 0 THEN 'LARGE_ECONOMIC_MARKET_MOVE'
            WHEN large_raw_moves > 0 AND has_rejected THEN 'LARGE_RAW_MOVE_REJECTED_AS_CORPORATE_ACTION'
            WHEN large_raw_moves > 0 THEN 'LARGE_RAW_MOVE_WITHOUT_CONFIRMED_ACTION'
            ELSE 'NO_SINGLE_LARGE_DAILY_MOVE' END AS audit_class FROM ({_PATH})""")
