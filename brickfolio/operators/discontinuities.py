"""Price-jump candidates and the human decisions laid over them.

The detector only proposes; the registry decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.functions.windows import by_ticker
from brickfolio.operators.checks import rule_counts


def price_movements(panel: DataFrame) -> DataFrame:
    w = by_ticker()
    return (
        panel.withColumns({
            "previous_trade_date": F.lag("trade_date").over(w),
            "previous_close_price": F.lag("close_price").over(w),
        })
        .withColumn("price_factor", X.ratio("close_price", "previous_close_price"))
        .withColumn("daily_return", F.col("price_factor") - 1.0)
    )


def comparable() -> Column:
    """Rows that have a previous close and a finite move."""
    return F.col("previous_close_price").isNotNull() & X.finite("daily_return") & X.finite("price_factor")


def is_candidate() -> Column:
    return comparable() & (F.abs("daily_return") >= C.CANDIDATE_THRESHOLD)


def with_confidence(moves: DataFrame) -> DataFrame:
    """Nearest common factor of each move and how sure the detector is of it."""
    near, candidate = F.col("near"), is_candidate()
    match = near["relative_error"] <= C.FACTOR_TOLERANCE
    return (
        moves.withColumn("near", X.nearest_factor("price_factor"))
        .withColumns({
            "nearest_common_factor": near["factor"], "factor_relative_error": near["relative_error"],
            "factor_match": match,
            "confidence": F.when(~candidate, "NONE")
            .when(match & (near["relative_error"] <= C.HIGH_CONFIDENCE_TOLERANCE), "HIGH")
            .when(match | (F.abs("daily_return") >= C.LEGACY_THRESHOLD), "MEDIUM").otherwise("LOW"),
        })
        .drop("near")
    )


def classified_movements(panel: DataFrame) -> DataFrame:
    """Comparable movements with the nearest common factor and the candidate class."""
    candidate, match = is_candidate(), F.col("factor_match")
    return with_confidence(price_movements(panel)).filter(comparable()).withColumns({
        "classification": F.when(~candidate, "NORMAL_PRICE_MOVE")
        .when(match, "POSSIBLE_CORPORATE_FACTOR").otherwise("LARGE_SINGLE_DAY_MOVE"),
        "candidate_reason": F.when(~candidate, "BELOW_CANDIDATE_THRESHOLD")
        .when(match, "EXTREME_RETURN_AND_COMMON_FACTOR_MATCH")
        .otherwise("EXTREME_RETURN_WITHOUT_COMMON_FACTOR_MATCH"),
        "review_status": F.when(candidate, "PENDING_REVIEW").otherwise("NOT_APPLICABLE"),
    })


def discontinuities(panel: DataFrame) -> DataFrame:
    """Candidate table; every governed column starts at its default."""
    size = F.abs("daily_return")
    moves = classified_movements(panel).filter(size >= C.CANDIDATE_THRESHOLD)
    undecided = [
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in C.REGISTRY_SCHEMA if f.name not in ("ticker", "event_date", "review_status", "event_type")
    ]
    return moves.select(
        "ticker", "cnpj", "codigo_cvm", "previous_trade_date", F.col("trade_date").alias("event_date"),
        F.col("previous_close_price").alias("price_before"), F.col("close_price").alias("price_after"),
        "daily_return", F.col("price_factor").alias("observed_factor"),
        "nearest_common_factor", "factor_relative_error", "factor_match",
        "classification", "confidence", "candidate_reason", "review_status",
        F.lit("UNKNOWN").alias("event_type"), *undecided,
        F.lit(False).alias("is_confirmed_corporate_action"),
        (size >= C.LEGACY_THRESHOLD).alias("detected_by_v4_threshold"),
        (size < C.LEGACY_THRESHOLD).alias("newly_visible_in_v5_band"),
        F.lit(C.CANDIDATE_THRESHOLD).alias("candidate_threshold"),
        F.lit(C.DETECTION_POLICY).alias("detection_policy"), F.lit(C.REVIEW_POLICY).alias("review_policy"),
        F.lit(C.DISCONTINUITY_VERSION).alias("discontinuity_version"),
        F.lit(C.SILVER_SOURCE).alias("discontinuity_source"),
    )


def apply_reviews(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """A decision replaces all governed columns at once, its nulls included."""
    decisions = registry.select(
        "ticker", "event_date", F.struct(*C.DECISION_COLUMNS).alias("decision")
    ).filter(F.col("decision.review_status").isNotNull())
    joined = candidates.join(decisions, ["ticker", "event_date"], "left")
    decided = F.col("decision").isNotNull()
    out = joined.withColumns({
        c: F.when(decided, F.col(f"decision.{c}")).otherwise(F.col(c)) for c in C.DECISION_COLUMNS
    })
    return out.withColumn(
        "is_confirmed_corporate_action", X.flag(F.col("review_status") == "CONFIRMED")
    ).drop("decision").select(candidates.columns)


def uncovered_reviews(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Decisions without a candidate; the contract wants none."""
    return registry.join(candidates.select("ticker", "event_date"), ["ticker", "event_date"], "left_anti")


def _registry_rules() -> dict[str, Column]:
    c = F.col
    confirmed = X.flag(c("review_status") == "CONFIRMED")
    split = confirmed & c("event_type").isin(*C.STRUCTURAL_TYPES)
    amortization = confirmed & (c("event_type") == "AMORTIZATION")
    cash = F.coalesce(c("cash_amount_per_unit"), F.lit(0.0))
    in_kind = F.coalesce(c("in_kind_amount_per_unit"), F.lit(0.0))
    positive = lambda name: X.flag(c(name) > 0)
    return {
        "EVENT_DATE_PRESENT": c("event_date").isNull(),
        "TICKER_PRESENT": c("ticker").isNull(),
        "REVIEW_STATUS_PRESENT": c("review_status").isNull(),
        "REVIEW_STATUS_DOMAIN": ~c("review_status").isin(*C.REVIEW_STATUSES),
        "EVENT_TYPE_DOMAIN": ~c("event_type").isin(*C.EVENT_TYPES),
        "CONFIRMED_TYPE_KNOWN": confirmed & (c("event_type") == "UNKNOWN"),
        "CONFIRMED_SOURCE_PRESENT": confirmed & X.blank("confirmation_source"),
        "CONFIRMED_DATE_PRESENT": confirmed & c("confirmation_date").isNull(),
        "FIRST_TRADE_PRESENT": confirmed & c("first_post_event_trade_date").isNull(),
        "EVENT_IS_FIRST_TRADE": confirmed & (c("event_date") != c("first_post_event_trade_date")),
        "RECORD_DATE_NOT_AFTER_TRADE":
            confirmed & (c("corporate_action_record_date") > c("first_post_event_trade_date")),
        "SPLIT_QUANTITY_POSITIVE": split & ~positive("quantity_multiplier"),
        "SPLIT_FACTOR_POSITIVE": split & ~positive("price_adjustment_factor"),
        "SPLIT_RECIPROCAL":
            split & (F.abs(c("quantity_multiplier") * c("price_adjustment_factor") - 1.0) > 0.01),
        "AMORTIZATION_TOTAL_POSITIVE": amortization & ~positive("total_economic_value_per_unit"),
        "AMORTIZATION_CASH_NOT_NEGATIVE": amortization & (cash < 0),
        "AMORTIZATION_IN_KIND_NOT_NEGATIVE": amortization & (in_kind < 0),
        "AMORTIZATION_COMPONENT_SUM":
            amortization & (F.abs(cash + in_kind - c("total_economic_value_per_unit")) > 1e-8),
        "IN_KIND_ASSET_PRESENT": amortization & (in_kind > 0) & X.blank("in_kind_asset_ticker"),
        "IN_KIND_QUANTITY_POSITIVE": amortization & (in_kind > 0) & ~positive("in_kind_quantity_per_unit"),
    }


def registry_checks(registry: DataFrame) -> DataFrame:
    """One row per governance rule with its number of violations."""
    return rule_counts(registry, _registry_rules(), key=("ticker", "event_date"))


def migrate_registry(legacy: DataFrame, overrides: DataFrame) -> DataFrame:
    """Registry v1 to v2: new typed columns, confirmed defaults, keyed overrides.

    ``overrides`` holds (ticker, event_date) and any of the governed columns;
    a value present there replaces the default of that confirmed row.
    """
    have = set(legacy.columns)
    base = legacy.withColumns({
        f.name: (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType) for f in C.REGISTRY_SCHEMA
    })
    confirmed = X.flag(F.col("review_status") == "CONFIRMED")
    amortization = confirmed & (F.col("event_type") == "AMORTIZATION")

    def default(name: str, when: Column, value: Column):
        return F.when(when, value).otherwise(F.col(name))

    filled = base.withColumns({
        "total_economic_value_per_unit": default(
            "total_economic_value_per_unit", amortization, F.col("cash_amount_per_unit")),
        "in_kind_amount_per_unit": default("in_kind_amount_per_unit", amortization, F.lit(0.0)),
        "first_post_event_trade_date": default("first_post_event_trade_date", confirmed, F.col("event_date")),
        "corporate_action_effective_date": default(
            "corporate_action_effective_date", confirmed, F.col("event_date")),
    })
    given = [c for c in C.DECISION_COLUMNS if c in overrides.columns]
    joined = filled.join(
        overrides.select("ticker", "event_date", F.struct(*given).alias("override")),
        ["ticker", "event_date"], "left")
    changed = joined.withColumns({
        c: F.when(confirmed, F.coalesce(F.col(f"override.{c}"), F.col(c))).otherwise(F.col(c)) for c in given
    })
    return changed.select([f.name for f in C.REGISTRY_SCHEMA])


def override_mismatches(legacy: DataFrame, overrides: DataFrame) -> DataFrame:
    """Overrides without a confirmed row, and confirmed rows without an override."""
    key = ["ticker", "event_date"]
    confirmed = legacy.filter(F.col("review_status") == "CONFIRMED").select(*key)
    extra = overrides.select(*key).join(confirmed, key, "left_anti").withColumn("problem", F.lit("NOT_CONFIRMED"))
    missing = confirmed.join(overrides.select(*key), key, "left_anti").withColumn("problem", F.lit("NO_OVERRIDE"))
    return extra.unionByName(missing)


def review_queue(reviewed: DataFrame) -> DataFrame:
    """Pending candidates in working order: priority, then score."""
    size = F.abs("daily_return")
    match = X.flag("factor_match")
    factor = F.col("classification") == "POSSIBLE_CORPORATE_FACTOR"
    priority = (
        F.when(factor & (F.col("confidence") == "HIGH"), "P1")
        .when(factor & (F.col("confidence") == "MEDIUM"), "P2")
        .when(size >= C.LEGACY_THRESHOLD, "P3").otherwise("P4")
    )
    base = F.when(priority == "P1", 400.0).when(priority == "P2", 300.0).when(priority == "P3", 200.0).otherwise(100.0)
    return (
        reviewed.filter(F.col("review_status") == "PENDING_REVIEW")
        .withColumns({
            "absolute_daily_return": size,
            "review_priority": priority,
            "priority_score": base + size * 100.0 + F.when(match, 20.0).otherwise(0.0)
            + F.when(F.col("newly_visible_in_v5_band"), 5.0).otherwise(0.0),
        })
        .orderBy("review_priority", F.desc("priority_score"), "event_date", "ticker")
    )


def queue_checks(queue: DataFrame, dataset: str | None = None) -> DataFrame:
    """The contract of the review queue; an empty queue passes."""
    c = F.col
    rules = {
        "TICKER_PRESENT": X.blank("ticker"),
        "EVENT_DATE_PRESENT": c("event_date").isNull(),
        "DAILY_RETURN_PRESENT": c("daily_return").isNull(),
        "CLASSIFIED": c("classification").isNull() | c("confidence").isNull(),
        "STATUS_PENDING": ~c("review_status").eqNullSafe("PENDING_REVIEW"),
        "PRIORITY_DOMAIN": ~F.coalesce(c("review_priority").isin("P1", "P2", "P3", "P4"), F.lit(False)),
        "ABSOLUTE_RETURN_CONSISTENT": c("absolute_daily_return") != F.abs("daily_return"),
        "SCORE_POSITIVE": ~F.coalesce(c("priority_score") > 0, F.lit(False)),
    }
    return rule_counts(queue, rules, key=("ticker", "event_date"), dataset=dataset)


CANDIDATE_REQUIRED = [
    "ticker", "cnpj", "codigo_cvm", "previous_trade_date", "event_date", "price_before", "price_after", "daily_return", "observed_factor",
    "nearest_common_factor", "factor_relative_error", "factor_match", "classification", "confidence", "candidate_reason", "review_status",
    "event_type", "is_confirmed_corporate_action", "detected_by_v4_threshold", "newly_visible_in_v5_band",
]


def candidate_checks(reviewed: DataFrame, dataset: str | None = None) -> DataFrame:
    """Output contract of the reviewed candidates: required values, domains, threshold, bands and the confirmation flag."""
    C.require_columns(reviewed, CANDIDATE_REQUIRED, "candidates")
    size, absent = F.abs("daily_return"), [F.col(c).isNull() for c in CANDIDATE_REQUIRED]
    new = F.col("newly_visible_in_v5_band")
    rules = {
        "REQUIRED_PRESENT": reduce(lambda a, b: a | b, absent),
        "STATUS_IN_DOMAIN": ~F.col("review_status").isin(*C.REVIEW_STATUSES), "EVENT_TYPE_IN_DOMAIN": ~F.col("event_type").isin(*C.EVENT_TYPES),
        "FLAG_IS_CONFIRMED": F.col("is_confirmed_corporate_action") != (F.col("review_status") == "CONFIRMED"),
        "ABOVE_THRESHOLD": size < C.CANDIDATE_THRESHOLD, "BANDS_DISJOINT": F.col("detected_by_v4_threshold") & new,
        "NEW_BAND_MATCHES": new != ((size >= C.CANDIDATE_THRESHOLD) & (size < C.LEGACY_THRESHOLD)),
    }
    return rule_counts(reviewed, rules, key=("ticker", "event_date"), dataset=dataset)
