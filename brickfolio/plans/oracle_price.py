"""Oracle SQL of the price and learning pipeline, as a chain of named parts."""

from __future__ import annotations

from brickfolio import contracts as C
from brickfolio.plans.shape import select_list

PANELS = {
    "daily": """
      SELECT 'FD' || user_id AS ticker, CAST(ts AS DATE) AS trade_date,
             arg_min(value, (ts, event_id)) AS open_price, min(value) AS low_price, max(value) AS high_price,
             avg(value) AS average_price, arg_max(value, (ts, event_id)) AS close_price, count(*) AS trades_quantity,
             CAST(user_id AS VARCHAR) AS codigo_cvm
      FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "weekly": """
      SELECT 'FD' || l_suppkey AS ticker, CAST(date_trunc('week', l_shipdate) AS DATE) AS trade_date,
             avg(l_extendedprice / l_quantity) AS open_price, min(l_extendedprice / l_quantity) AS low_price,
             max(l_extendedprice / l_quantity) AS high_price, avg(l_extendedprice / l_quantity) AS average_price,
             sum(l_extendedprice) / sum(l_quantity) AS close_price, count(*) AS trades_quantity,
             CAST(l_suppkey AS VARCHAR) AS codigo_cvm
      FROM lineitem GROUP BY l_suppkey, CAST(date_trunc('week', l_shipdate) AS DATE)""",
}

_FACTORS = ", ".join(repr(f) for f in C.COMMON_FACTORS)


def _history_windows(windows) -> str:
    parts = []
    for n in windows:
        w = f"OVER (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        parts.append(f"""
          CASE WHEN count(daily_return) {w} = {n} THEN product(1 + daily_return) {w} - 1 END AS return_{n}d,
          CASE WHEN count(close_price) {w} = {n} THEN avg(close_price) {w} END AS ma_{n},
          CASE WHEN count(daily_return) {w} = {n} THEN stddev_samp(daily_return) {w} END AS volatility_{n}d,
          CASE WHEN count(trades_quantity) {w} = {n} THEN avg(trades_quantity) {w} END AS trades_avg_{n}d""")
    return ",".join(parts)


def _history_derived(windows) -> str:
    return ", ".join(
        f"return_{n}d * 100 AS return_{n}d_pct, volatility_{n}d * 100 AS volatility_{n}d_pct, "
        f"close_price / nullif(ma_{n}, 0) AS price_to_ma{n}" for n in windows)


def _cross(windows) -> str:
    return ", ".join(
        f"return_{a}d - return_{b}d AS return_spread_{a}d_{b}d, ma_{a} / nullif(ma_{b}, 0) AS ma_ratio_{a}_{b}, "
        f"volatility_{a}d / nullif(volatility_{b}d, 0) AS volatility_ratio_{a}d_{b}d, "
        f"trades_avg_{a}d / nullif(trades_avg_{b}d, 0) AS trades_ratio_{a}d_{b}d" for a, b in zip(windows, windows[1:]))


W = C.DEFAULT_WINDOWS
_PAYLOAD = ", ".join(f"CASE WHEN confirmed THEN r.{old} END AS {new}" for old, new in C.PAYLOAD_NAMES.items())
_RUN = "(PARTITION BY ticker ORDER BY trade_date ROWS UNBOUNDED PRECEDING)"
_BACK = "(PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)"
_SIGNALS = {  # signal -> (lookback name, horizon name)
    "blocking_signal": ("blocking_feature_lookback_count", "blocking_target_horizon_count"),
    "extreme": ("extreme_feature_lookback_count", "extreme_target_horizon_count"),
    "review": (None, "price_quality_review_target_count"),
    "rejected": (None, "rejected_ca_review_target_count"),
    "confirmed_ca": ("confirmed_ca_feature_lookback_count", "confirmed_ca_target_count"),
    "economic_ca": ("confirmed_economic_ca_feature_lookback_count", "confirmed_economic_ca_target_count"),
    "in_kind_ca": ("in_kind_ca_feature_lookback_count", "in_kind_ca_target_count"),
}

PARTS: dict[str, str] = {
    "panel0": "",  # set per panel
    "panel": """
      SELECT trade_date, ticker, lpad(codigo_cvm, 14, '0') AS cnpj, codigo_cvm, 'I' || codigo_cvm AS instrument_id,
             open_price, low_price, high_price, average_price, close_price, trades_quantity,
             'SINGLE_TICKER' AS ticker_resolution_status,
             CASE WHEN trades_quantity >= 3 THEN 'HIGH' ELSE 'LOW' END AS market_evidence_confidence
      FROM panel0""",
    "movements": """
      SELECT *, close_price / nullif(previous_close_price, 0) AS price_factor,
             close_price / nullif(previous_close_price, 0) - 1 AS daily_return
      FROM (SELECT *, lag(trade_date) OVER (PARTITION BY ticker ORDER BY trade_date) AS previous_trade_date,
                   lag(close_price) OVER (PARTITION BY ticker ORDER BY trade_date) AS previous_close_price FROM panel)""",
    "nearest": f"""
      SELECT m.ticker, m.trade_date, arg_min(f.factor, (abs(m.price_factor - f.factor), f.pos)) AS nearest_common_factor
      FROM movements m, (SELECT CAST(unnest([{_FACTORS}]) AS DOUBLE) AS factor, generate_subscripts([{_FACTORS}], 1) AS pos) f
      WHERE m.price_factor IS NOT NULL GROUP BY 1, 2""",
    "classified": """
      SELECT *, CASE WHEN NOT candidate THEN 'NORMAL_PRICE_MOVE' WHEN factor_match THEN 'POSSIBLE_CORPORATE_FACTOR'
                     ELSE 'LARGE_SINGLE_DAY_MOVE' END AS classification,
             CASE WHEN NOT candidate THEN 'NONE' WHEN factor_match AND factor_relative_error <= 0.05 THEN 'HIGH'
                  WHEN factor_match OR abs(daily_return) >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
             CASE WHEN NOT candidate THEN 'BELOW_CANDIDATE_THRESHOLD'
                  WHEN factor_match THEN 'EXTREME_RETURN_AND_COMMON_FACTOR_MATCH'
                  ELSE 'EXTREME_RETURN_WITHOUT_COMMON_FACTOR_MATCH' END AS candidate_reason,
             CASE WHEN candidate THEN 'PENDING_REVIEW' ELSE 'NOT_APPLICABLE' END AS review_status
      FROM (SELECT m.*, n.nearest_common_factor,
                   abs(m.price_factor - n.nearest_common_factor) / n.nearest_common_factor AS factor_relative_error,
                   abs(m.price_factor - n.nearest_common_factor) / n.nearest_common_factor <= 0.10 AS factor_match,
                   abs(m.daily_return) >= 0.3 AS candidate
            FROM movements m JOIN nearest n USING (ticker, trade_date))""",
    "candidates": """
      SELECT *, trade_date AS event_date, previous_close_price AS price_before, close_price AS price_after,
             price_factor AS observed_factor, abs(daily_return) >= 0.5 AS detected_by_v4_threshold,
             abs(daily_return) < 0.5 AS newly_visible_in_v5_band
      FROM classified WHERE candidate""",
    "registry": """
      SELECT ticker, event_date,
             CASE WHEN h <= 3 THEN 'CONFIRMED' WHEN h = 4 THEN 'REJECTED' ELSE 'NOT_APPLICABLE' END AS review_status,
             CASE h WHEN 0 THEN 'SPLIT' WHEN 1 THEN 'REVERSE_SPLIT' WHEN 2 THEN 'AMORTIZATION'
                    WHEN 3 THEN 'AMORTIZATION' ELSE 'OTHER' END AS event_type,
             CASE h WHEN 0 THEN 2.0::DOUBLE WHEN 1 THEN 0.5::DOUBLE END AS quantity_multiplier,
             CASE h WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 2.0::DOUBLE END AS price_adjustment_factor,
             cash AS cash_amount_per_unit, in_kind AS in_kind_amount_per_unit,
             cash + in_kind AS total_economic_value_per_unit,
             CASE WHEN h = 3 THEN 'FD999' END AS in_kind_asset_ticker,
             CASE WHEN h = 3 THEN 0.5::DOUBLE END AS in_kind_quantity_per_unit,
             CASE WHEN h <= 3 THEN event_date - 2 END AS corporate_action_record_date,
             CASE WHEN h <= 3 THEN event_date END AS corporate_action_effective_date,
             CASE WHEN h IN (2, 3) THEN event_date + 10 END AS cash_payment_date,
             CASE WHEN h = 3 THEN event_date + 12 END AS in_kind_delivery_date,
             CASE WHEN h <= 3 THEN event_date END AS first_post_event_trade_date,
             CASE WHEN h <= 3 THEN 'NOTICE' END AS confirmation_source,
             CASE WHEN h <= 3 THEN event_date + 1 END AS confirmation_date,
             event_date + 3 AS governance_review_date, 'reviewed' AS review_notes
      FROM (SELECT *, CASE h WHEN 2 THEN price_before * 0.05::DOUBLE
                             WHEN 3 THEN price_before * 0.03::DOUBLE END AS cash,
                   CASE h WHEN 2 THEN 0.0::DOUBLE WHEN 3 THEN price_before * 0.02::DOUBLE END AS in_kind
            FROM (SELECT *, (CAST(substr(ticker, 3) AS BIGINT) * 31
                             + date_diff('day', DATE '1970-01-01', event_date) * 17) % 97 AS h FROM candidates))
      WHERE h <> 5""",
    "reviewed": """
      SELECT c.ticker, c.event_date, c.cnpj, c.codigo_cvm, c.previous_trade_date, c.price_before, c.price_after,
             c.daily_return, c.observed_factor, c.nearest_common_factor, c.factor_relative_error, c.factor_match,
             c.classification, c.confidence, c.candidate_reason, c.detected_by_v4_threshold, c.newly_visible_in_v5_band,
             coalesce(r.review_status, c.review_status) AS review_status,
             CASE WHEN r.review_status IS NULL THEN 'UNKNOWN' ELSE r.event_type END AS event_type,
             coalesce(r.review_status = 'CONFIRMED', false) AS is_confirmed_corporate_action,
             r.* EXCLUDE (ticker, event_date, review_status, event_type)
      FROM candidates c LEFT JOIN registry r USING (ticker, event_date)""",
    "events0": f"""
      SELECT p.*, coalesce(r.review_status, 'NONE') AS review_status_on_date,
             coalesce(r.event_type, 'NONE') AS event_type_on_date,
             coalesce(r.confidence, 'NONE') AS discontinuity_confidence_on_date,
             coalesce(r.is_confirmed_corporate_action, false) AS confirmed_action_on_date,
             coalesce(r.review_status = 'PENDING_REVIEW', false) AS pending_review_on_date, {_PAYLOAD}
      FROM panel p LEFT JOIN (SELECT *, review_status = 'CONFIRMED' AS confirmed FROM reviewed) r
           ON p.ticker = r.ticker AND p.trade_date = r.event_date""",
    # an independent form of the structural factor: a join on later events
    "factors": """
      SELECT p.ticker, p.trade_date, product(e.confirmed_price_adjustment_factor) AS f
      FROM panel p JOIN events0 e ON e.ticker = p.ticker AND e.trade_date > p.trade_date
      WHERE e.confirmed_event_type IN ('SPLIT', 'REVERSE_SPLIT') GROUP BY 1, 2""",
    "adjusted0": """
      SELECT e.*, coalesce(f.f, 1.0) AS structural_adjustment_factor,
             coalesce(confirmed_cash_amount_per_unit, 0) AS cash_amount_per_unit_raw,
             coalesce(confirmed_in_kind_amount_per_unit, 0) AS in_kind_amount_per_unit_raw,
             coalesce(confirmed_total_economic_value_per_unit, 0) AS corporate_action_value_per_unit_raw
      FROM events0 e LEFT JOIN factors f USING (ticker, trade_date)""",
    "adjusted1": """
      SELECT *, """ + ", ".join(
        f"{c} AS {c}_raw, {c} * structural_adjustment_factor AS {c}_adjusted" for c in C.PRICES) + """,
             cash_amount_per_unit_raw * structural_adjustment_factor AS cash_amount_per_unit_adjusted,
             in_kind_amount_per_unit_raw * structural_adjustment_factor AS in_kind_amount_per_unit_adjusted,
             corporate_action_value_per_unit_raw * structural_adjustment_factor
               AS corporate_action_value_per_unit_adjusted,
             cash_amount_per_unit_raw AS cash_flow_per_unit_raw,
             cash_amount_per_unit_raw * structural_adjustment_factor AS cash_flow_per_unit_adjusted
      FROM adjusted0""",
    "adjusted": f"""
      SELECT *, close_price_raw / nullif(previous_close_price_raw, 0) - 1 AS daily_return_raw,
             close_price_adjusted / nullif(previous_close_price_adjusted, 0) - 1 AS daily_return_adjusted_price,
             (close_price_adjusted + corporate_action_value_per_unit_adjusted)
               / nullif(previous_close_price_adjusted, 0) - 1 AS daily_return_economic,
             '{C.ADJUSTED_PRICES_VERSION}' AS adjusted_prices_version, '{C.SILVER_SOURCE}' AS adjusted_prices_source,
             '{C.REGISTRY_SOURCE}' AS corporate_action_source
      FROM (SELECT * EXCLUDE (open_price, low_price, high_price, average_price, close_price),
                   lag(close_price_raw) OVER (PARTITION BY ticker ORDER BY trade_date) AS previous_close_price_raw,
                   lag(close_price_adjusted) OVER (PARTITION BY ticker ORDER BY trade_date)
                     AS previous_close_price_adjusted
            FROM adjusted1)""",
    "calendar": """
      SELECT trade_date, row_number() OVER (ORDER BY trade_date) - 1 AS session_index
      FROM (SELECT DISTINCT trade_date FROM panel)""",
    "history": f"""
      SELECT *, {_history_derived(W)}, '{C.PRICE_HISTORY_VERSION}' AS price_history_version,
             '{C.ADJUSTED_SOURCE}' AS price_history_source, '{C.RETURN_SEMANTICS}' AS return_semantics,
             '{C.PRICE_SEMANTICS}' AS price_semantics, '{C.CA_VALUE_SEMANTICS}' AS corporate_action_value_semantics,
             '{",".join(map(str, W))}' AS feature_windows
      FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date) AS observations_count,
                   {_history_windows(W)}
            FROM (SELECT *, {", ".join(f"{c}_adjusted AS {c}" for c in C.PRICES)},
                         daily_return_economic AS daily_return, daily_return_economic * 100 AS daily_return_pct
                  FROM adjusted))""",
    "gaps": """
      SELECT *, CASE WHEN trading_gap_sessions IS NULL THEN 'UNKNOWN' WHEN trading_gap_sessions <= 1 THEN 'CONTIGUOUS'
                     WHEN trading_gap_sessions <= 5 THEN 'SHORT_GAP' WHEN trading_gap_sessions <= 20 THEN 'MEDIUM_GAP'
                     ELSE 'LONG_GAP' END AS trading_gap_class
      FROM (SELECT a.*, c.session_index, p.session_index AS previous_session_index,
                   CAST(date_diff('day', a.previous_trade_date, a.trade_date) AS INT) AS trading_gap_calendar_days,
                   c.session_index - p.session_index AS trading_gap_sessions
            FROM (SELECT *, lag(trade_date) OVER (PARTITION BY ticker ORDER BY trade_date) AS previous_trade_date
                  FROM adjusted) a
            JOIN calendar c USING (trade_date) LEFT JOIN calendar p ON p.trade_date = a.previous_trade_date)""",
    "quality0": """
      SELECT *, coalesce(abs(daily_return_economic) >= 0.5, false) AS flag_extreme_return,
             close_price_raw <= 1.0 AS flag_low_price, trading_gap_class = 'SHORT_GAP' AS flag_short_gap,
             trading_gap_class = 'MEDIUM_GAP' AS flag_medium_gap, trading_gap_class = 'LONG_GAP' AS flag_long_gap,
             pending_review_on_date AS flag_pending_corporate_action,
             confirmed_action_on_date AS flag_confirmed_corporate_action,
             confirmed_action_on_date AND coalesce(confirmed_event_type = 'AMORTIZATION', false)
               AS flag_confirmed_economic_corporate_action,
             confirmed_action_on_date AND in_kind_amount_per_unit_raw > 0 AS flag_in_kind_corporate_action
      FROM gaps""",
    "quality": f"""
      SELECT *, CASE WHEN flags = '' THEN 'NONE' ELSE flags END AS quality_flags,
             CASE WHEN flag_pending_corporate_action OR flag_long_gap OR flag_possible_microliquidity
                  THEN 'REVIEW' ELSE 'PASS' END AS ml_quality_status,
             '{C.PRICE_QUALITY_VERSION}' AS price_quality_version, '{C.ADJUSTED_SOURCE}' AS price_quality_source
      FROM (SELECT *, concat_ws('|', CASE WHEN flag_extreme_return THEN 'EXTREME_RETURN' END,
                   CASE WHEN flag_low_price THEN 'LOW_PRICE' END, CASE WHEN flag_short_gap THEN 'SHORT_TRADING_GAP' END,
                   CASE WHEN flag_medium_gap THEN 'MEDIUM_TRADING_GAP' END,
                   CASE WHEN flag_long_gap THEN 'LONG_TRADING_GAP' END,
                   CASE WHEN flag_pending_corporate_action THEN 'PENDING_CORPORATE_ACTION' END,
                   CASE WHEN flag_confirmed_corporate_action THEN 'CONFIRMED_CORPORATE_ACTION' END,
                   CASE WHEN flag_confirmed_economic_corporate_action THEN 'CONFIRMED_ECONOMIC_CORPORATE_ACTION' END,
                   CASE WHEN flag_in_kind_corporate_action THEN 'IN_KIND_CORPORATE_ACTION' END,
                   CASE WHEN flag_possible_microliquidity THEN 'POSSIBLE_MICROLIQUIDITY' END) AS flags
            FROM (SELECT *, flag_extreme_return AND (flag_low_price OR flag_long_gap) AS flag_possible_microliquidity
                  FROM quality0))""",
    "features": f"""
      SELECT *, trade_date AS feature_date, {_cross(W)},
             daily_return IS NOT NULL AND observations_count >= 21 AND """
                + " AND ".join(f"{c} IS NOT NULL" for n in W for c in (
                    f"return_{n}d", f"ma_{n}", f"volatility_{n}d", f"trades_avg_{n}d", f"price_to_ma{n}")) + f"""
               AS feature_ready,
             '{C.FEATURE_VERSION}' AS feature_version, price_history_version AS source_price_history_version,
             price_history_source AS source_price_history_source, '{C.PRICE_SEMANTICS}' AS feature_price_semantics,
             '{C.FEATURE_RETURN_SEMANTICS}' AS feature_return_semantics,
             '{C.FEATURE_CA_POLICY}' AS feature_corporate_action_policy
      FROM history""",
    "signals0": """
      SELECT *, ml_quality_status = 'REVIEW' AS review, review_status_on_date = 'REJECTED' AS rejected,
             ml_quality_status = 'REVIEW' OR review_status_on_date = 'REJECTED' AS blocking_signal,
             flag_extreme_return AS extreme, flag_confirmed_corporate_action AS confirmed_ca,
             flag_confirmed_economic_corporate_action AS economic_ca, flag_in_kind_corporate_action AS in_kind_ca
      FROM quality""",
    "signals": "SELECT *, blocking_feature_lookback_count = 0 AS feature_window_clean FROM (SELECT *, " + ", ".join(
        [f"CAST(sum({s}::INT) OVER {_BACK} AS BIGINT) AS {v[0]}" for s, v in _SIGNALS.items() if v[0]]
        + [f"CAST(sum({s}::INT) OVER {_RUN} AS BIGINT) AS run_{s}" for s in _SIGNALS]) + " FROM signals0)",
    "samples": f"""
      SELECT f.ticker, f.feature_date, t.trade_date AS target_date,
             c.session_index AS feature_global_session_index, t.session_index AS target_global_session_index,
             {C.TARGET_HORIZON} AS target_horizon, '{C.HORIZON_SEMANTICS}' AS target_horizon_semantics
      FROM features f JOIN calendar c ON c.trade_date = f.feature_date
           JOIN calendar t ON t.session_index = c.session_index + {C.TARGET_HORIZON}
           JOIN panel p ON p.ticker = f.ticker AND p.trade_date = t.trade_date
      WHERE f.feature_ready""",
    "eligibility": f"""
      SELECT *, feature_window_clean AND target_horizon_clean AS ml_eligible,
             CASE WHEN feature_window_clean AND target_horizon_clean THEN 'NONE' ELSE concat_ws('|',
               CASE WHEN NOT feature_window_clean THEN 'BLOCKING_EVENT_IN_FEATURE_LOOKBACK' END,
               CASE WHEN NOT target_horizon_clean THEN 'BLOCKING_EVENT_IN_TARGET_HORIZON' END) END
               AS ml_ineligibility_reason,
             {C.RETURN_WINDOW} AS feature_return_window, {C.PRICE_LOOKBACK} AS feature_price_lookback_observations,
             '{C.ELIGIBILITY_VERSION}' AS ml_eligibility_version, '{C.FEATURE_VERSION}' AS source_feature_version,
             '{C.PRICE_QUALITY_VERSION}' AS source_price_quality_version,
             '{C.ADJUSTED_SOURCE}' AS source_price_quality_source, '{C.PRICE_SEMANTICS}' AS price_semantics,
             '{C.RETURN_SEMANTICS}' AS return_semantics,
             '{C.CA_VALUE_SEMANTICS}' AS corporate_action_value_semantics, '{C.ELIGIBILITY_POLICY}' AS eligibility_policy
      FROM (SELECT *, blocking_target_horizon_count = 0 AS target_horizon_clean
            FROM (SELECT s.*, a.blocking_signal AS blocking_signal_on_feature_date,
                         a.review AS price_quality_review_on_feature_date,
                         a.rejected AS rejected_ca_review_on_feature_date, """
                   + ", ".join(f"a.{v[0]}" for v in _SIGNALS.values() if v[0]) + """, a.feature_window_clean, """
                   + ", ".join(f"b.run_{s} - a.run_{s} AS {v[1]}" for s, v in _SIGNALS.items()) + """
                  FROM samples s JOIN signals a ON a.ticker = s.ticker AND a.trade_date = s.feature_date
                       JOIN signals b ON b.ticker = s.ticker AND b.trade_date = s.target_date))""",
    "curve": f"""
      SELECT ticker, trade_date, close_price, close_price_raw, 1 + coalesce(daily_return_economic, 0) AS economic_growth_factor,
             sum(ln(1 + coalesce(daily_return_economic, 0))) OVER {_RUN} AS cumulative_economic_log_growth
      FROM history""",
    "training": f"""
      SELECT *, target_return_next_5d * 100 AS target_return_next_5d_pct,
             target_price_return_next_5d * 100 AS target_price_return_next_5d_pct,
             target_return_next_5d - target_price_return_next_5d AS target_economic_vs_price_difference,
             (target_return_next_5d - target_price_return_next_5d) * 100 AS target_economic_vs_price_difference_pct,
             'target_return_next_5d' AS target_name, '{C.RETURN_SEMANTICS}' AS target_return_semantics,
             '{C.TRAINING_VERSION}' AS training_dataset_version, ml_eligibility_version AS source_ml_eligibility_version,
             '{C.TRAINING_POLICY}' AS training_sample_policy
      FROM (SELECT e.*, f.* EXCLUDE (ticker, feature_date, price_semantics, return_semantics,
                                     corporate_action_value_semantics),
                   a.cumulative_economic_log_growth AS economic_curve_at_feature,
                   b.close_price AS target_price_next_5d, b.close_price_raw AS target_price_raw,
                   b.cumulative_economic_log_growth AS economic_curve_at_target,
                   b.close_price / nullif(f.close_price, 0) - 1 AS target_price_return_next_5d,
                   exp(b.cumulative_economic_log_growth - a.cumulative_economic_log_growth) - 1 AS target_return_next_5d
            FROM eligibility e JOIN features f USING (ticker, feature_date)
                 JOIN curve a ON a.ticker = e.ticker AND a.trade_date = e.feature_date
                 JOIN curve b ON b.ticker = e.ticker AND b.trade_date = e.target_date)""",
    "bounds": f"""
      SELECT max(feature_date) FILTER (rn = {C.TEST_DAYS + C.VALIDATION_DAYS}) AS validation_start,
             max(feature_date) FILTER (rn = {C.TEST_DAYS}) AS test_start, count(*) AS feature_dates
      FROM (SELECT feature_date, row_number() OVER (ORDER BY feature_date DESC) AS rn
            FROM (SELECT DISTINCT feature_date FROM training WHERE ml_eligible))""",
    "labelled": """
      SELECT *, CASE WHEN split_region = 'train' AND target_date < validation_start THEN 'train'
                     WHEN split_region = 'validation' AND target_date < test_start THEN 'validation'
                     WHEN split_region = 'test' THEN 'test' END AS split_name
      FROM (SELECT t.*, b.validation_start, b.test_start,
                   CASE WHEN feature_date < validation_start THEN 'train' WHEN feature_date < test_start
                        THEN 'validation' ELSE 'test' END AS split_region
            FROM training t, bounds b WHERE ml_eligible)""",
    "split": f"""
      SELECT *, 'v3' AS split_version, {C.VALIDATION_DAYS} AS validation_days, {C.TEST_DAYS} AS test_days,
             training_dataset_version AS split_source_training_dataset_version, true AS split_requires_ml_eligible,
             '{C.PURGE_SEMANTICS}' AS split_purge_semantics, '{C.HOLDOUT_POLICY}' AS test_holdout_policy
      FROM labelled WHERE split_name IS NOT NULL""",
    "universe": """
      SELECT t.* FROM training t, bounds b
      WHERE ml_eligible AND feature_ready AND feature_date < b.test_start AND target_date < b.test_start""",
    "fold_dates": f"""
      SELECT feature_date, CAST(({C.FOLDS * C.FOLD_SESSIONS} - rn) // {C.FOLD_SESSIONS} + 1 AS INT) AS fold_id
      FROM (SELECT feature_date, row_number() OVER (ORDER BY feature_date DESC) AS rn
            FROM (SELECT DISTINCT feature_date FROM universe)) WHERE rn <= {C.FOLDS * C.FOLD_SESSIONS}""",
    "folds": """
      SELECT fold_id, min(feature_date) AS validation_start, max(feature_date) AS validation_end
      FROM fold_dates GROUP BY fold_id""",
    "members": """
      SELECT f.fold_id, 'train' AS role, u.* FROM universe u JOIN folds f
             ON u.feature_date < f.validation_start AND u.target_date < f.validation_start
      UNION ALL
      SELECT d.fold_id, 'validation' AS role, u.* FROM universe u JOIN fold_dates d USING (feature_date)""",
    "fold_base": """
      SELECT fold_id, avg(target_return_next_5d) FILTER (role = 'train') AS train_target_mean,
             avg((target_return_next_5d > 0)::INT) FILTER (role = 'train') AS train_positive_share,
             avg((target_return_next_5d > 0)::INT) FILTER (role = 'validation') AS validation_positive_share,
             count(*) FILTER (role = 'validation') AS validation_rows
      FROM members GROUP BY fold_id""",
    "majority": """
      SELECT *, CASE WHEN train_positive_share > 0.5 THEN 'POSITIVE' ELSE 'NON_POSITIVE' END AS majority_direction,
             CASE WHEN train_positive_share > 0.5 THEN validation_positive_share
                  ELSE 1 - validation_positive_share END AS majority_directional_accuracy
      FROM fold_base""",
    "predicted": """
      SELECT fold_id, 'dummy_mean' AS model, ticker, feature_date, target_return_next_5d AS y,
             train_target_mean AS prediction
      FROM members JOIN fold_base USING (fold_id) WHERE role = 'validation'""",
    "metrics": """
      SELECT m.*, j.majority_direction, j.majority_directional_accuracy,
             m.directional_accuracy - j.majority_directional_accuracy AS directional_lift
      FROM (SELECT fold_id, model, count(*) AS rows, avg(abs(y - prediction)) AS mae,
                   sqrt(avg((y - prediction) * (y - prediction))) AS rmse,
                   1 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)) AS r2,
                   avg(((y > 0) = (prediction > 0))::INT) AS directional_accuracy,
                   avg(prediction) AS prediction_mean, min(prediction) AS prediction_min,
                   max(prediction) AS prediction_max, median(prediction) AS prediction_median
            FROM predicted GROUP BY fold_id, model) m JOIN majority j USING (fold_id)""",
}
_ORDER = list(PARTS)


def price_sql(panel: str, final: str, last: str) -> str:
    """``final`` over the chain up to the part ``last``."""
    names = _ORDER[: _ORDER.index(last) + 1]
    parts = {**PARTS, "panel0": PANELS[panel]}
    body = ",\n".join(f"{n} AS ({parts[n]})" for n in names)
    return f"WITH {body}\n{final}"


def table_sql(panel: str, part: str, columns: list[str], where: str = "") -> str:
    return price_sql(panel, f"SELECT {select_list(columns)} FROM {part} {where}", part)


# --- least squares ---------------------------------------------------------------
# the spreads are differences of two other inputs; leaving them out changes no prediction
_INPUTS = [c for c in C.feature_names() if not c.startswith("return_spread_")]


def linear_sql(panel: str, last: str, source: str, final: str) -> str:
    """``final`` over ``linear`` (grp, ticker, feature_date, y, mean, prediction): normal equations solved by elimination.

    ``source`` gives grp, role, ticker, feature_date, target and inputs.
    """
    p, x = len(_INPUTS), _INPUTS
    keys = "grp, role, ticker, feature_date, y"
    body = {
        "lin_source": source,
        "lin_medians": f"SELECT grp, {', '.join(f'median({c}) AS {c}' for c in x)} FROM lin_source WHERE role = 'train' GROUP BY grp",
        "lin_rows": f"SELECT {', '.join(f's.{k}' for k in keys.split(', '))}, {', '.join(f'coalesce(s.{c}, m.{c}) AS {c}' for c in x)} "
                    "FROM lin_source s JOIN lin_medians m USING (grp)",
        "lin_stats": f"SELECT grp, avg(y) AS mean, {', '.join(f'avg({c}) AS m{k}, stddev_pop({c}) AS s{k}' for k, c in enumerate(x))} "
                     "FROM lin_rows WHERE role = 'train' GROUP BY grp",
        "lin_scaled": f"SELECT {keys}, mean, y - mean AS z{p}, "
                      + ", ".join(f"({c} - m{k}) / CASE WHEN s{k} = 0 THEN 1 ELSE s{k} END AS z{k}" for k, c in enumerate(x))
                      + " FROM lin_rows JOIN lin_stats USING (grp)",
        "lin_gram": "SELECT grp, [" + ", ".join("[" + ", ".join(f"sum(z{i} * z{j})" for j in range(p + 1)) + "]" for i in range(p))
                    + "] AS m FROM lin_scaled WHERE role = 'train' GROUP BY grp",
        "lin_solved": f"""SELECT grp, 1 AS k, m FROM lin_gram UNION ALL
          SELECT grp, k + 1, [CASE WHEN i = k THEN [v / m[k][k] FOR v IN m[k]] ELSE [m[i][j] - m[i][k] * m[k][j] / m[k][k] FOR j IN range(1, {p + 2})] END
                              FOR i IN range(1, {p + 1})] FROM lin_solved WHERE k <= {p}""",
        "linear": f"SELECT {keys}, mean, mean + {' + '.join(f'm[{k + 1}][{p + 1}] * z{k}' for k in range(p))} AS prediction "
                  f"FROM lin_scaled JOIN (SELECT grp, m FROM lin_solved WHERE k = {p + 1}) USING (grp) WHERE role = 'validation'",
    }
    names = _ORDER[: _ORDER.index(last) + 1]
    parts = {**{n: {**PARTS, "panel0": PANELS[panel]}[n] for n in names}, **body}
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({q})" for n, q in parts.items()) + f"\n{final}"


BOTH_MODELS = """(SELECT grp, 'linear_regression' AS model, ticker, feature_date, y, prediction FROM linear
                  UNION ALL SELECT grp, 'dummy_mean', ticker, feature_date, y, mean FROM linear)"""
SCORES = """count(*) AS rows, avg(abs(y - prediction)) AS mae, sqrt(avg((y - prediction) * (y - prediction))) AS rmse,
  1 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)) AS r2, avg(((y > 0) = (prediction > 0))::INT) AS directional_accuracy,
  avg(prediction) AS prediction_mean, min(prediction) AS prediction_min, max(prediction) AS prediction_max, median(prediction) AS prediction_median"""
