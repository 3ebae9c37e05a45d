"""Corporate-action-adjusted prices and the three daily returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.functions.windows import by_ticker, running, whole
from brickfolio.operators import discontinuities as D
from brickfolio.operators.checks import assert_passed, rule_counts
from brickfolio.operators.publish import publish_verified, with_date_parts
from brickfolio.session import write_and_reread

OUTPUT = [
    "trade_date", "ticker", "cnpj", "codigo_cvm", "instrument_id",
    *[f"{c}_raw" for c in C.PRICES], "structural_adjustment_factor",
    *[f"{c}_adjusted" for c in C.PRICES], "trades_quantity",
    "cash_amount_per_unit_raw", "cash_amount_per_unit_adjusted",
    "in_kind_amount_per_unit_raw", "in_kind_amount_per_unit_adjusted",
    "corporate_action_value_per_unit_raw", "corporate_action_value_per_unit_adjusted",
    "cash_flow_per_unit_raw", "cash_flow_per_unit_adjusted",
    "previous_close_price_raw", "previous_close_price_adjusted",
    "daily_return_raw", "daily_return_adjusted_price", "daily_return_economic",
    "review_status_on_date", "event_type_on_date", "discontinuity_confidence_on_date",
    "confirmed_action_on_date", "pending_review_on_date", *C.PAYLOAD_NAMES.values(),
    "ticker_resolution_status", "market_evidence_confidence",
    "adjusted_prices_version", "adjusted_prices_source", "corporate_action_source",
]


def confirmed_actions(reviewed: DataFrame) -> DataFrame:
    return reviewed.filter(F.col("review_status") == "CONFIRMED")


def confirmed_action_checks(reviewed: DataFrame) -> DataFrame:
    c = F.col
    split = c("event_type").isin(*C.STRUCTURAL_TYPES)
    economic = c("event_type") == "AMORTIZATION"
    cash = F.coalesce(c("cash_amount_per_unit"), F.lit(0.0))
    in_kind = F.coalesce(c("in_kind_amount_per_unit"), F.lit(0.0))
    product = c("quantity_multiplier") * c("price_adjustment_factor")
    return rule_counts(confirmed_actions(reviewed), {
        "TYPE_SUPPORTED": ~X.flag(split | economic),
        "FACTOR_POSITIVE": split & ~X.flag(c("price_adjustment_factor") > 0),
        "QUANTITY_POSITIVE": split & ~X.flag(c("quantity_multiplier") > 0),
        "RECIPROCAL": split & (F.abs(product - 1.0) > 0.05),
        "TOTAL_POSITIVE": economic & ~X.flag(c("total_economic_value_per_unit") > 0),
        "COMPONENT_SUM": economic & (F.abs(cash + in_kind - c("total_economic_value_per_unit")) > 1e-8),
        "IN_KIND_ASSET": economic & (in_kind > 0) & X.blank("in_kind_asset_ticker"),
        "IN_KIND_QUANTITY": economic & (in_kind > 0) & ~X.flag(c("in_kind_quantity_per_unit") > 0),
    }, key=("ticker", "event_date"))


def actions_without_price(panel: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Confirmed actions that have no price row on their date."""
    keys = panel.select("ticker", F.col("trade_date").alias("event_date"))
    return confirmed_actions(reviewed).select("ticker", "event_date", "event_type").join(
        keys, ["ticker", "event_date"], "left_anti")


def require_covered(panel: DataFrame, registry: DataFrame) -> None:
    """Stops where a confirmed decision would be without effect: its date has no price row, or its row is no candidate."""
    confirmed = registry.filter(F.col("review_status") == "CONFIRMED").select("ticker", F.col("event_date").alias("trade_date"), F.lit(True).alias("confirmed"))
    rows = D.with_confidence(D.price_movements(panel)).select("ticker", "trade_date", D.is_candidate().alias("candidate"))
    lost = confirmed.join(rows, ["ticker", "trade_date"], "left").filter(~F.coalesce("candidate", F.lit(False)))
    found = lost.select("ticker", "trade_date", F.col("candidate").isNotNull().alias("priced")).limit(5).collect()
    if found:
        raise C.ContractError("confirmed decisions without " + "; ".join(
            f"{'candidate' if r.priced else 'price row'}: {r.ticker} {r.trade_date}" for r in found))


def attach_events(panel: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Detector status and, for confirmed rows only, the governed payload.

    Candidates and confirmed actions are the same table, so one join serves both.
    """
    events = reviewed.select(
        "ticker", F.col("event_date").alias("trade_date"), "review_status", "confidence",
        "is_confirmed_corporate_action",
        *C.PAYLOAD_NAMES,
    )
    joined = panel.join(events, ["ticker", "trade_date"], "left")
    confirmed = X.flag(F.col("review_status") == "CONFIRMED")
    out = {
        "review_status_on_date": F.coalesce("review_status", F.lit("NONE")),
        "event_type_on_date": F.coalesce("event_type", F.lit("NONE")),
        "discontinuity_confidence_on_date": F.coalesce("confidence", F.lit("NONE")),
        "confirmed_action_on_date": X.flag("is_confirmed_corporate_action"),
        "pending_review_on_date": X.flag(F.col("review_status") == "PENDING_REVIEW"),
        **{new: F.when(confirmed, F.col(old)) for old, new in C.PAYLOAD_NAMES.items()},
    }
    return joined.select(*panel.columns, *[v.alias(k) for k, v in out.items()])


def attach_decisions(panel: DataFrame, registry: DataFrame) -> DataFrame:
    """As ``attach_events``, straight from the panel and the registry.

    The detector is a function of the row and its lag, so the candidate table
    need not be joined back: only the decisions are. Both sides are hashed by
    ticker, and no row leaves its place.
    """
    decisions = registry.filter(F.col("review_status").isNotNull()).select(
        "ticker", F.col("event_date").alias("trade_date"),
        F.struct("review_status", *C.PAYLOAD_NAMES).alias("decision"))
    found = D.with_confidence(D.price_movements(panel)).select(
        *panel.columns, D.is_candidate().alias("candidate"), "confidence")
    joined = found.join(decisions, ["ticker", "trade_date"], "left")
    candidate, d = F.col("candidate"), F.col("decision")
    decided = candidate & d.isNotNull()
    confirmed = decided & (d["review_status"] == "CONFIRMED")
    status = F.when(decided, d["review_status"]).when(candidate, "PENDING_REVIEW").otherwise("NONE")
    out = {
        "review_status_on_date": status,
        "event_type_on_date": F.when(decided, F.coalesce(d["event_type"], F.lit("NONE")))
        .when(candidate, "UNKNOWN").otherwise("NONE"),
        "discontinuity_confidence_on_date": F.col("confidence"),
        "confirmed_action_on_date": confirmed,
        "pending_review_on_date": status == "PENDING_REVIEW",
        **{new: F.when(confirmed, d[old]) for old, new in C.PAYLOAD_NAMES.items()},
    }
    return joined.select(*panel.columns, *[v.alias(k) for k, v in out.items()])


def with_structural_factor(rows: DataFrame) -> DataFrame:
    """Product of the split factors of all later rows of the ticker.

    Needs every event on a price row (``actions_without_price`` is empty); the
    product over the following rows then equals the product over later events.
    The ticker's own factors are listed once; a row multiplies those behind the
    ones seen so far, so rows without an event are not gone through again.
    """
    own = F.when(
        F.col("confirmed_event_type").isin(*C.STRUCTURAL_TYPES), F.col("confirmed_price_adjustment_factor"))
    listed = rows.withColumns({"_factors": F.collect_list(own.cast("double")).over(whole()), "_seen": F.count(own).over(running())})
    some, n = F.col("_factors"), F.size("_factors")
    later = F.aggregate(F.slice(some, F.col("_seen").cast("int") + 1, n), F.lit(1.0), lambda product, v: product * v)
    return listed.withColumn("structural_adjustment_factor", F.when(F.col("_seen") < n, later).otherwise(1.0)).drop("_factors", "_seen")


def adjustment_factor(panel: DataFrame, reviewed: DataFrame) -> DataFrame:
    return with_structural_factor(attach_events(panel, reviewed)).select(
        "ticker", "trade_date", "close_price", "structural_adjustment_factor")


def adjusted_prices(panel: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Adjusted prices from the panel and the reviewed candidate table."""
    return _adjusted(attach_events(panel, reviewed))


def adjusted_from_registry(panel: DataFrame, registry: DataFrame) -> DataFrame:
    """The same table without building the candidate table."""
    return _adjusted(attach_decisions(panel, registry))


def _adjusted(events: DataFrame) -> DataFrame:
    rows = with_structural_factor(events)
    factor = F.col("structural_adjustment_factor")
    money = {
        "cash_amount_per_unit": "confirmed_cash_amount_per_unit",
        "in_kind_amount_per_unit": "confirmed_in_kind_amount_per_unit",
        "corporate_action_value_per_unit": "confirmed_total_economic_value_per_unit",
        "cash_flow_per_unit": "confirmed_cash_amount_per_unit",
    }
    scaled = {}
    for name in C.PRICES:
        scaled[f"{name}_raw"] = F.col(name)
        scaled[f"{name}_adjusted"] = F.col(name) * factor
    for name, source in money.items():
        raw = F.coalesce(F.col(source), F.lit(0.0))
        scaled[f"{name}_raw"] = raw
        scaled[f"{name}_adjusted"] = raw * factor
    w = by_ticker()
    previous = {
        f"previous_{c}": F.lag(c).over(w) for c in ("close_price_raw", "close_price_adjusted")
    }
    adj, prev_adj = F.col("close_price_adjusted"), F.col("previous_close_price_adjusted")
    returns = {
        "daily_return_raw": X.ratio("close_price_raw", "previous_close_price_raw") - 1.0,
        "daily_return_adjusted_price": X.ratio(adj, prev_adj) - 1.0,
        "daily_return_economic":
            X.ratio(adj + F.col("corporate_action_value_per_unit_adjusted"), prev_adj) - 1.0,
        "adjusted_prices_version": F.lit(C.ADJUSTED_PRICES_VERSION),
        "adjusted_prices_source": F.lit(C.SILVER_SOURCE),
        "corporate_action_source": F.lit(C.REGISTRY_SOURCE),
    }
    return rows.withColumns(scaled).withColumns(previous).withColumns(returns).select(OUTPUT)


def adjusted_checks(adjusted: DataFrame, dataset: str | None = None, zero_base: bool = False) -> DataFrame:
    """The contract of the adjusted prices; ``zero_base`` accepts that there is no return after a close of zero."""
    c = F.col
    first = c("previous_close_price_raw").isNull()
    undefined = X.flag(c("previous_close_price_raw") == 0) if zero_base else F.lit(False)
    returns = ("daily_return_raw", "daily_return_adjusted_price", "daily_return_economic")
    rules = {
        "FACTOR_POSITIVE": ~X.flag(c("structural_adjustment_factor") > 0),
        **{f"FINITE_{r.upper()}": ~first & ~X.finite(r) & ~(undefined & c(r).isNull()) for r in returns},
        **{f"FIRST_ROW_NULL_{r.upper()}": first & c(r).isNotNull() for r in returns},
        "COMPONENT_SUM": F.abs(
            c("cash_amount_per_unit_raw") + c("in_kind_amount_per_unit_raw")
            - c("corporate_action_value_per_unit_raw")) > 1e-8,
        "CASH_ALIAS": F.abs(c("cash_flow_per_unit_adjusted") - c("cash_amount_per_unit_adjusted")) > 1e-12,
        "PAYLOAD_ONLY_WHEN_CONFIRMED": ~c("confirmed_action_on_date") & c("confirmed_event_type").isNotNull(),
    }
    return rule_counts(adjusted, rules, key=("ticker", "trade_date"), dataset=dataset)


def event_reconciliation(adjusted: DataFrame, registry: DataFrame) -> DataFrame:
    """Confirmed decisions of each type against the price rows that carry them."""
    decided = confirmed_actions(registry).groupBy("event_type").agg(F.count(F.lit(1)).alias("decisions"))
    carried = adjusted.filter("confirmed_action_on_date").groupBy(F.col("confirmed_event_type").alias("event_type")).agg(F.count(F.lit(1)).alias("price_rows"))
    # a row per type on both sides
    n = {c: F.coalesce(c, F.lit(0)) for c in ("decisions", "price_rows")}
    return decided.join(carried, "event_type", "full_outer").select("event_type", *[v.alias(c) for c, v in n.items()]).withColumn(
        "status", F.when(F.col("decisions") == F.col("price_rows"), "PASS").otherwise("FAIL"))


def event_effect(adjusted: DataFrame) -> DataFrame:
    """Confirmed events with the raw, adjusted and economic return side by side."""
    return adjusted.filter("confirmed_action_on_date").select(
        "ticker", "trade_date", "confirmed_event_type", "structural_adjustment_factor",
        "previous_close_price_raw", "close_price_raw", "previous_close_price_adjusted", "close_price_adjusted",
        "cash_amount_per_unit_adjusted", "in_kind_amount_per_unit_adjusted",
        "corporate_action_value_per_unit_adjusted",
        "daily_return_raw", "daily_return_adjusted_price", "daily_return_economic",
        (F.col("daily_return_adjusted_price") - F.col("daily_return_raw")).alias("structural_effect"),
        (F.col("daily_return_economic") - F.col("daily_return_adjusted_price")).alias("economic_effect"),
    ).orderBy("ticker", "trade_date")


# fixed values: thresholds of the return-impact report
IMPACT_THRESHOLDS = (0.10, 0.20, 0.50, 1.00)


def threshold_summary(adjusted: DataFrame, thresholds=IMPACT_THRESHOLDS) -> DataFrame:
    """Extreme-return counts per threshold, all in one pass over the rows."""
    returns = {"raw_count": "daily_return_raw", "adjusted_price_count": "daily_return_adjusted_price",
               "economic_count": "daily_return_economic"}
    counts = adjusted.agg(*[
        F.count_if(F.abs(c) >= t).alias(f"{name}_{i}")
        for name, c in returns.items() for i, t in enumerate(thresholds)
    ])
    rows = F.array(*[
        F.struct(F.lit(t * 100.0).alias("threshold_pct"), *[F.col(f"{n}_{i}").alias(n) for n in returns])
        for i, t in enumerate(thresholds)
    ])
    return counts.select(F.inline(rows)).withColumns({
        "removed_by_price_adjustment": F.col("raw_count") - F.col("adjusted_price_count"),
        "removed_by_economic_adjustment": F.col("raw_count") - F.col("economic_count"),
    })


def changed_returns(adjusted: DataFrame) -> DataFrame:
    diff = F.col("daily_return_economic") - F.col("daily_return_raw")
    return adjusted.select(
        "ticker", "trade_date", "daily_return_raw", "daily_return_adjusted_price", "daily_return_economic",
        "event_type_on_date", diff.alias("return_difference"),
    ).filter(F.abs("return_difference") > 1e-12).orderBy(F.desc(F.abs("return_difference")), "ticker", "trade_date")


def pending_summary(adjusted: DataFrame) -> DataFrame:
    return adjusted.filter("pending_review_on_date").select(
        "ticker", "trade_date", "close_price_raw", "previous_close_price_raw", "daily_return_raw",
        "daily_return_economic", "discontinuity_confidence_on_date",
        F.abs("daily_return_raw").alias("absolute_raw_return"),
    ).orderBy(F.desc("absolute_raw_return"), "ticker", "trade_date")


def publish_adjusted(panel: DataFrame, registry: DataFrame, path: str) -> DataFrame:
    """The publishing job: every confirmed decision must have effect and follow its rules, the prices must keep their contract, and
    every row must arrive. A close of zero has no return after it, which is no fault of the row that follows."""
    require_covered(panel, registry)
    assert_passed(confirmed_action_checks(registry))
    prices = write_and_reread(adjusted_from_registry(panel, registry), "adjusted")
    assert_passed(adjusted_checks(prices, zero_base=True))
    return publish_verified(with_date_parts(prices, "trade_date").drop("day"), path, ["year", "month"], ["trade_date", "ticker"])
