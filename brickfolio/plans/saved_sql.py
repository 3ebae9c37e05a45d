"""The analysts' saved queries, as SQL over the pipeline's tables."""

from __future__ import annotations

LATEST = "SELECT {columns} FROM {table} {where} ORDER BY {date} DESC, ticker LIMIT 20"

# name -> (stage of the pipeline, columns, filter, date column)
SAVED = {
    "sql_trades": ("panel", "trade_date ticker close_price trades_quantity",
                   "WHERE trade_date = (SELECT max(trade_date) FROM {table})", "trade_date"),
    "sql_snapshot": ("snapshot", "trade_date ticker close_price intraday_variation price_range",
                     "WHERE trade_date = (SELECT max(trade_date) FROM {table})", "trade_date"),
    "sql_history": ("history", "trade_date ticker close_price daily_return return_5d ma_5 volatility_5d",
                    "WHERE trade_date >= DATE '2024-01-01' AND trade_date < DATE '2024-02-01'", "trade_date"),
    "sql_adjusted": ("adjusted", "trade_date ticker close_price_raw close_price_adjusted daily_return_economic",
                     "WHERE trade_date >= DATE '2024-01-01' AND trade_date < DATE '2025-01-01'", "trade_date"),
    "sql_discontinuities": ("reviewed", "event_date ticker daily_return classification confidence review_status", "", "event_date"),
    "sql_features": ("features", "feature_date ticker daily_return return_5d price_to_ma5 feature_ready",
                     "WHERE feature_date >= DATE '2024-01-01' AND feature_date < DATE '2024-02-01'", "feature_date"),
    "sql_eligibility": ("eligibility", "feature_date ticker target_date ml_eligible ml_ineligibility_reason", "", "feature_date"),
    "sql_training": ("training", "feature_date ticker target_date target_return_next_5d", "WHERE ml_eligible = true", "feature_date"),
    "sql_split": ("split", "feature_date ticker target_date split_name target_return_next_5d",
                  "WHERE split_name = 'test'", "feature_date"),
}


def statement(name: str, table: str, columns: str | None = None) -> str:
    _, wanted, where, day = SAVED[name]
    return LATEST.format(columns=columns or ", ".join(wanted.split()), table=table, where=where.format(table=table), date=day)
