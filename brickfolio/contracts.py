"""Fixed values and table contracts of the price platform."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: versions and lineage literals ---------------------------
DISCONTINUITY_VERSION = "v5"
ADJUSTED_PRICES_VERSION = "v3"
PRICE_HISTORY_VERSION = "v3"
PRICE_QUALITY_VERSION = "v2"
FEATURE_VERSION = "v7"
ELIGIBILITY_VERSION = "v3"
TRAINING_VERSION = "v4"
WALK_FORWARD_VERSION = "v1"
SILVER_SOURCE = "SILVER_FII_DAILY_PRICES"
REGISTRY_SOURCE = "FII_PRICE_DISCONTINUITIES_V5_REGISTRY_V2"
ADJUSTED_SOURCE = "FII_CORPORATE_ACTION_ADJUSTED_PRICES_V3"
DETECTION_POLICY = "ABS_DAILY_RETURN_GTE_30_PERCENT"
REVIEW_POLICY = "ALL_DETECTED_CANDIDATES_REQUIRE_REVIEW"
RETURN_SEMANTICS = "COMPOUNDED_DAILY_RETURN_ECONOMIC"
PRICE_SEMANTICS = "STRUCTURALLY_ADJUSTED_PRICE"
CA_VALUE_SEMANTICS = "TOTAL_ECONOMIC_VALUE_CASH_PLUS_IN_KIND"
FEATURE_RETURN_SEMANTICS = "ECONOMIC_RETURN"
FEATURE_CA_POLICY = "ECONOMIC_EFFECT_EMBEDDED_IN_RETURNS_NO_DIRECT_CA_PAYLOAD_FEATURES"
HORIZON_SEMANTICS = "GLOBAL_B3_TRADING_DAYS"
ELIGIBILITY_POLICY = (
    "QUALITY_REVIEW_OR_REJECTED_CA_BLOCKS_CONFIRMED_CA_AND_ISOLATED_EXTREME_INFORMATIONAL"
)
TRAINING_POLICY = "PRESERVE_ALL_SUPERVISABLE_SAMPLES_ML_ELIGIBLE_FILTER_DOWNSTREAM"
PURGE_SEMANTICS = "TARGET_DATE_BEFORE_NEXT_SPLIT"
HOLDOUT_POLICY = "RESERVED_UNTOUCHED_FOR_MODEL_SELECTION"

# --- fixed values: detection, quality and learning parameters --------------
COMMON_FACTORS = (0.05, 0.10, 0.20, 0.25, 0.50, 2.0, 4.0, 5.0, 10.0, 20.0)
FACTOR_TOLERANCE = 0.10
HIGH_CONFIDENCE_TOLERANCE = 0.05
CANDIDATE_THRESHOLD = 0.30
LEGACY_THRESHOLD = 0.50
EXTREME_RETURN = 0.50
LOW_PRICE = 1.00
SHORT_GAP_SESSIONS = 5
MEDIUM_GAP_SESSIONS = 20
DEFAULT_WINDOWS = (5, 10, 20)
TARGET_HORIZON = 5
PRICE_LOOKBACK = 21
RETURN_WINDOW = 20
VALIDATION_DAYS = 10
TEST_DAYS = 10
FOLDS = 12
FOLD_SESSIONS = 5
MIN_TRAIN_SESSIONS = 80
FOREST_TREES = 200
SEED = 42

# --- fixed values: governance domains ---------------------------------------
REVIEW_STATUSES = ("PENDING_REVIEW", "CONFIRMED", "REJECTED", "NOT_APPLICABLE")
EVENT_TYPES = ("UNKNOWN", "SPLIT", "REVERSE_SPLIT", "AMORTIZATION", "OTHER")
STRUCTURAL_TYPES = ("SPLIT", "REVERSE_SPLIT")

# --- fixed values: identity resolution --------------------------------------
FUND_CLASS = "Classes de Cotas de Fundos FII"
GENERIC_NAME_TOKENS = (
    "FII", "FUNDO", "FDO", "INVESTIMENTO", "INV", "IMOBILIARIO", "IMOB", "DE", "DA", "DO",
    "DAS", "DOS", "RESPONSABILIDADE", "RESP", "LIMITADA", "LIM", "RESPLIM",
)
PRIMARY_SIGNATURE = {
    "instrument_type": "EqtyInf",
    "security_category": "6",
    "b3_market": "10",
    "b3_segment": "1",
}
PRIMARY_TICKER_SUFFIX = "11"

PRICES = ("open_price", "low_price", "high_price", "average_price", "close_price")

_S, _D, _L, _DATE = T.StringType(), T.DoubleType(), T.LongType(), T.DateType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


PANEL_SCHEMA = _schema(
    trade_date=_DATE, ticker=_S, cnpj=_S, codigo_cvm=_S, instrument_id=_S,
    open_price=_D, low_price=_D, high_price=_D, average_price=_D, close_price=_D,
    trades_quantity=_L, ticker_resolution_status=_S, market_evidence_confidence=_S,
)

REGISTRY_SCHEMA = _schema(
    ticker=_S, event_date=_DATE, review_status=_S, event_type=_S,
    quantity_multiplier=_D, price_adjustment_factor=_D, cash_amount_per_unit=_D,
    in_kind_amount_per_unit=_D, total_economic_value_per_unit=_D,
    in_kind_asset_ticker=_S, in_kind_quantity_per_unit=_D,
    corporate_action_record_date=_DATE, corporate_action_effective_date=_DATE,
    cash_payment_date=_DATE, in_kind_delivery_date=_DATE, first_post_event_trade_date=_DATE,
    confirmation_source=_S, confirmation_date=_DATE, governance_review_date=_DATE, review_notes=_S,
)
DECISION_COLUMNS = [f.name for f in REGISTRY_SCHEMA if f.name not in ("ticker", "event_date")]

# Name each governed column takes once it is attached to a price row.
PAYLOAD_NAMES = {
    "event_type": "confirmed_event_type",
    "quantity_multiplier": "confirmed_quantity_multiplier",
    "price_adjustment_factor": "confirmed_price_adjustment_factor",
    "cash_amount_per_unit": "confirmed_cash_amount_per_unit",
    "in_kind_amount_per_unit": "confirmed_in_kind_amount_per_unit",
    "total_economic_value_per_unit": "confirmed_total_economic_value_per_unit",
    "in_kind_asset_ticker": "confirmed_in_kind_asset_ticker",
    "in_kind_quantity_per_unit": "confirmed_in_kind_quantity_per_unit",
    "corporate_action_record_date": "confirmed_corporate_action_record_date",
    "corporate_action_effective_date": "confirmed_corporate_action_effective_date",
    "cash_payment_date": "confirmed_cash_payment_date",
    "in_kind_delivery_date": "confirmed_in_kind_delivery_date",
    "first_post_event_trade_date": "confirmed_first_post_event_trade_date",
    "confirmation_source": "confirmed_action_source",
    "confirmation_date": "confirmed_action_confirmation_date",
    "governance_review_date": "confirmed_governance_review_date",
}

# Columns that only say when a job ran; they never reach a content fingerprint.
RUN_TIME_COLUMNS = (
    "created_at", "gold_created_at", "features_created_at", "training_dataset_created_at",
    "split_created_at", "ingestion_timestamp", "generated_at",
)


class ContractError(ValueError):
    """A table does not meet its contract."""


def require_columns(df, columns, table: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ContractError(f"{table}: missing columns {missing}")


def window_columns(n: int) -> list[str]:
    return [
        f"return_{n}d", f"return_{n}d_pct", f"ma_{n}", f"volatility_{n}d",
        f"volatility_{n}d_pct", f"trades_avg_{n}d", f"price_to_ma{n}",
    ]


def cross_window_columns(windows) -> list[str]:
    out = []
    for a, b in zip(windows, windows[1:]):
        out += [f"return_spread_{a}d_{b}d", f"ma_ratio_{a}_{b}",
                f"volatility_ratio_{a}d_{b}d", f"trades_ratio_{a}d_{b}d"]
    return out


def normalize_windows(windows) -> list[int]:
    clean = sorted({int(w) for w in windows})
    if not clean or clean[0] <= 0:
        raise ContractError(f"window list must hold positive sizes: {list(windows)}")
    return clean


def feature_names(windows=DEFAULT_WINDOWS) -> list[str]:
    """The allowlist of model inputs for a window list (18 names for 5, 10, 20)."""
    names = ["daily_return"]
    for n in windows:
        names += [f"return_{n}d", f"volatility_{n}d", f"price_to_ma{n}"]
    return names + cross_window_columns(windows)


# --- fixed values: name patterns that may never be a model input ------------
FORBIDDEN_NAMES = {
    "target", "feature_date", "trade_date", "ticker", "cnpj", "codigo_cvm", "close_price",
    "close_price_adjusted", "trades_quantity", "observations_count",
    "daily_return_adjusted_price", "daily_return_economic",
}
FORBIDDEN_PREFIXES = ("target_", "split_")
FORBIDDEN_SUFFIXES = ("_pct",)
FORBIDDEN_PARTS = (
    "next_", "_raw",
    "cash_amount", "cash_flow", "in_kind_amount", "corporate_action_value", "confirmed_cash",
    "confirmed_in_kind", "confirmed_total_economic", "quantity_multiplier",
    "price_adjustment_factor", "asset_ticker", "quantity_per_unit",
    "ml_eligible", "eligibility", "quality_status", "review_status", "review_",
    "confirmed_action", "pending_", "blocking_", "ineligibility",
    "_version", "_semantics", "_policy", "created_at", "feature_windows",
)


def is_forbidden_feature(column: str) -> bool:
    name = column.strip().lower()
    return (
        name in FORBIDDEN_NAMES
        or name.startswith(FORBIDDEN_PREFIXES)
        or name.endswith(FORBIDDEN_SUFFIXES)
        or any(part in name for part in FORBIDDEN_PARTS)
    )
