"""Queries of contracts that bind, with a violation of each rule planted, and of the reports beside them."""

from __future__ import annotations

from pyspark.sql import functions as F

from brickfolio import contracts as C
from brickfolio.operators import adjusted as A, checks as CH, discontinuities as D, features as FE, health as HE, history as H, identity as ID, serving as SV, splits as S
from brickfolio.plans.catalog import register
from brickfolio.plans import tables as TB
from brickfolio.plans.oracle_price import price_sql
from brickfolio.plans.pipeline import Pipeline
from brickfolio.plans.queries_data import _DAY_SQL, _STATE_SQL, Serving, _states, cycle
from brickfolio.plans.queries_identity import Identity, identity_sql
from brickfolio.plans.queries_price import ADJUSTED_RULES, CHECK, FEATURE_RULES, HISTORY_RULES, SPLIT_RULES, checks_sql, final
from brickfolio.session import scratch_path

_D = "right(ticker, 1)"


def _status(*counts: str) -> str:
    return "SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (" + " UNION ALL ".join(counts) + ")"


def _put(digit, column, value):
    return F.when(F.substring("ticker", -1, 1) == digit, value).otherwise(F.col(column))


# --- decisions ------------------------------------------------------------------------
_ADJUSTED = "ticker trade_date close_price_raw close_price_adjusted structural_adjustment_factor daily_return_economic review_status_on_date event_type_on_date"
final("job_adjusted", "daily", lambda p: A.publish_adjusted(p.panel, p.registry, scratch_path(p.panel.sparkSession, "job-adjusted")), _ADJUSTED, "adjusted",
      "SELECT * FROM adjusted")


def _spoiled_actions(p):
    """The registry with a violation of each rule among its confirmed rows, by the last digit of the ticker."""
    rows = p.registry.withColumns({
        "event_type": _put("0", "event_type", F.lit("OTHER")), "price_adjustment_factor": _put("1", "price_adjustment_factor", F.lit(-2.0)),
        "quantity_multiplier": _put("2", "quantity_multiplier", F.lit(0.0)), "total_economic_value_per_unit": _put("3", "total_economic_value_per_unit", F.lit(-1.0)),
        "in_kind_asset_ticker": _put("4", "in_kind_asset_ticker", F.lit(" ")), "in_kind_quantity_per_unit": _put("5", "in_kind_quantity_per_unit", F.lit(None))})
    return A.confirmed_action_checks(rows.unionByName(rows.filter(F.substring("ticker", -1, 1) == "6")))


_CONFIRMED = f"""(SELECT *, {_D} AS d, event_type IN ('SPLIT', 'REVERSE_SPLIT') AND {_D} <> '0' AS split, event_type = 'AMORTIZATION' AND {_D} <> '0' AS amort
  FROM registry WHERE review_status = 'CONFIRMED')"""
_RULES = {
    "TYPE_SUPPORTED": "d = '0'", "FACTOR_POSITIVE": "split AND d = '1'", "QUANTITY_POSITIVE": "split AND d = '2'", "RECIPROCAL": "split AND d IN ('1', '2')",
    "TOTAL_POSITIVE": "amort AND (d = '3' OR total_economic_value_per_unit <= 0)", "COMPONENT_SUM": "amort AND d = '3' AND total_economic_value_per_unit <> -1",
    "IN_KIND_ASSET": "amort AND d = '4' AND in_kind_amount_per_unit > 0", "IN_KIND_QUANTITY": "amort AND d = '5' AND in_kind_amount_per_unit > 0"}
final("confirmed_action_checks", "weekly", _spoiled_actions, CHECK, "registry", _status(
    *[f"SELECT '{n}' AS check_name, count(*) FILTER ({w}) + count(*) FILTER (d = '6' AND ({w})) AS violations FROM {_CONFIRMED}" for n, w in _RULES.items()],
    f"SELECT 'KEY_UNIQUE', count(*) FILTER (d = '6') FROM {_CONFIRMED}"))


def _overrides(p):
    """Overrides for confirmed rows but those of tickers that end in 3, and for some rows that are not confirmed."""
    keys = p.registry.select("ticker", "event_date", "review_status")
    last = F.substring("ticker", -1, 1)
    given = keys.filter(((F.col("review_status") == "CONFIRMED") & (last != "3")) | ((F.col("review_status") != "CONFIRMED") & (last == "4")))
    return D.override_mismatches(p.registry, given.drop("review_status"))


final("override_mismatches", "daily", _overrides, "ticker event_date problem", "registry", f"""
  SELECT ticker, event_date, CASE WHEN review_status = 'CONFIRMED' THEN 'NO_OVERRIDE' ELSE 'NOT_CONFIRMED' END AS problem FROM registry
  WHERE (review_status = 'CONFIRMED' AND {_D} = '3') OR (review_status <> 'CONFIRMED' AND {_D} = '4')""")

# --- fund master ----------------------------------------------------------------------
_OK = "resolution_status = 'AUTO_RESOLVED'"
_AGAIN = "(SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM master WHERE {w} GROUP BY {c}) WHERE n > 1)"
_METRICS = {
    "rows": "count(*)", "resolved": f"count(*) FILTER ({_OK})", "unresolved": f"count(*) FILTER (NOT {_OK})",
    "structural_resolution": "count(*) FILTER (resolution_method = 'B3_UNDERLYING_REFERENCE')", "signature_resolution": "count(*) FILTER (resolution_method = 'B3_PRIMARY_SIGNATURE')",
    "missing_cnpj": "count(*) FILTER (cnpj_classe IS NULL)", "resolved_without_primary_id": f"count(*) FILTER ({_OK} AND primary_instrument_id IS NULL)",
    "resolved_without_ticker": f"count(*) FILTER ({_OK} AND ticker IS NULL)", "resolved_without_isin": f"count(*) FILTER ({_OK} AND isin IS NULL)",
    "unresolved_with_primary_id": f"count(*) FILTER (NOT {_OK} AND primary_instrument_id IS NOT NULL)", "unresolved_with_ticker": f"count(*) FILTER (NOT {_OK} AND ticker IS NOT NULL)",
    "unresolved_with_isin": f"count(*) FILTER (NOT {_OK} AND isin IS NOT NULL)", "duplicate_cnpj_rows": _AGAIN.format(w="cnpj_classe IS NOT NULL", c="cnpj_classe"),
    "duplicate_primary_instrument_id_rows": _AGAIN.format(w=f"{_OK} AND primary_instrument_id IS NOT NULL", c="primary_instrument_id")}
_SPOILED_MASTER = """SELECT * REPLACE (CASE WHEN n % 10 = 1 THEN NULL ELSE cnpj_classe END AS cnpj_classe, CASE WHEN n % 10 = 2 THEN NULL ELSE ticker END AS ticker,
  CASE WHEN n % 10 = 3 THEN 'BR' ELSE isin END AS isin, CASE WHEN n % 10 IN (4, 5) THEN 'I0' ELSE primary_instrument_id END AS primary_instrument_id)
  FROM (SELECT *, CAST(codigo_cvm AS BIGINT) AS n FROM master0)"""


def _spoiled_master(s, d):
    n = F.col("codigo_cvm").cast("bigint") % 10
    put = lambda k, c, v: F.when(n.isin(*k), v).otherwise(F.col(c))
    return HE.master_metrics(Identity(s, d).master.withColumns({
        "cnpj_classe": put([1], "cnpj_classe", F.lit(None)), "ticker": put([2], "ticker", F.lit(None)), "isin": put([3], "isin", F.lit("BR")),
        "primary_instrument_id": put([4, 5], "primary_instrument_id", F.lit("I0"))}))


_MASTER_SQL = identity_sql("SELECT * FROM master", "master")
register("master_metrics", _spoiled_master, [*_METRICS, "resolution_rate"], f"""
  WITH master0 AS ({_MASTER_SQL}), master AS ({_SPOILED_MASTER})
  SELECT {', '.join(f'{v} AS {k}' for k, v in _METRICS.items())},
         floor(count(*) FILTER ({_OK}) / count(*) * 1e6::DOUBLE + 0.41421356::DOUBLE) / 1e6::DOUBLE AS resolution_rate FROM master""")
register("trade_only_profile", lambda s, d: (lambda i: ID.trade_only_profile(i.marked, i.master))(Identity(s, d)),
         "resolution_status attribute attribute_value candidate_rows", identity_sql(" UNION ALL ".join(
             f"SELECT resolution_status, '{a}' AS attribute, {e} AS attribute_value, count(*) AS candidate_rows FROM marked m JOIN master r ON r.cnpj_classe = m.CNPJ_Classe "
             f"WHERE m.is_traded AND NOT m.is_underlying_target AND NOT m.matches_primary_signature AND NOT r.{_OK} GROUP BY 1, 2, 3"
             for a, e in [(c, f"m.{c}") for c in ID.PROFILE_ATTRIBUTES] + [("ticker_suffix", "regexp_extract(m.ticker, '(\\d+)$', 1)")]), "master"))


# --- serving --------------------------------------------------------------------------
def _dates(s, d):
    """The serving sources as they are, and with rows in a partition of another date."""
    v = Serving(s, d)
    moved = v.daily.withColumn("partition_date", F.when(F.substring("ticker", -1, 1) == "7", F.date_sub("trade_date", 1)).otherwise(F.col("trade_date")))
    older = v.pipeline.features.filter("feature_ready and day(feature_date) = 27")
    return SV.date_alignment(v.daily, v.inference).withColumn("variant", F.lit("sound")).unionByName(
        SV.date_alignment(moved, older).withColumn("variant", F.lit("moved")))


_READY = "SELECT * FROM features WHERE feature_ready"
_ML = {"sound": f"SELECT * FROM ({_READY}) WHERE feature_date = (SELECT max(feature_date) FROM features)", "moved": f"SELECT * FROM ({_READY}) WHERE day(feature_date) = 27"}
register("date_alignment", _dates, "variant daily_dates daily_date daily_outside_partition ml_dates ml_date ml_outside_partition dates_equal", price_sql("daily", " UNION ALL ".join(f"""
  SELECT '{v}' AS variant, daily_dates, daily_date, {'daily_moved' if v == 'moved' else 'CAST(0 AS BIGINT)'} AS daily_outside_partition, ml_dates, ml_date,
         CAST(0 AS BIGINT) AS ml_outside_partition, daily_dates = 1 AND ml_dates = 1 AND coalesce(daily_date = ml_date, false) AS dates_equal
  FROM (SELECT count(DISTINCT trade_date) AS daily_dates, min(trade_date) AS daily_date, count(*) FILTER ({_D} = '7') AS daily_moved FROM ({_DAY_SQL}))
  CROSS JOIN (SELECT count(DISTINCT feature_date) AS ml_dates, min(feature_date) AS ml_date FROM ({sql}))""" for v, sql in _ML.items()), "features"))

# --- cycles ---------------------------------------------------------------------------
cycle("cycle_action_counts", lambda c: HE.action_counts(_states(c)), "action run_dates", f"""
  SELECT CASE cycle_state {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in HE.ACTIONS.items())} END AS action, count(*) AS run_dates FROM ({_STATE_SQL}) GROUP BY 1""")

# --- lineage --------------------------------------------------------------------------
# the columns that hold one literal in each stage
_LITERALS = {
    "adjusted": {"adjusted_prices_version": C.ADJUSTED_PRICES_VERSION, "adjusted_prices_source": C.SILVER_SOURCE, "corporate_action_source": C.REGISTRY_SOURCE},
    "history": {"price_history_version": C.PRICE_HISTORY_VERSION, "price_history_source": C.ADJUSTED_SOURCE, "return_semantics": C.RETURN_SEMANTICS,
                "price_semantics": C.PRICE_SEMANTICS, "corporate_action_value_semantics": C.CA_VALUE_SEMANTICS},
    "quality": {"price_quality_version": C.PRICE_QUALITY_VERSION, "price_quality_source": C.ADJUSTED_SOURCE},
    "features": {"feature_version": C.FEATURE_VERSION, "feature_price_semantics": C.PRICE_SEMANTICS, "feature_return_semantics": C.FEATURE_RETURN_SEMANTICS,
                 "feature_corporate_action_policy": C.FEATURE_CA_POLICY},
    "training": {"training_dataset_version": C.TRAINING_VERSION, "target_return_semantics": C.RETURN_SEMANTICS, "source_feature_version": C.FEATURE_VERSION,
                 "ml_eligibility_version": C.ELIGIBILITY_VERSION, "eligibility_policy": C.ELIGIBILITY_POLICY, "training_sample_policy": C.TRAINING_POLICY},
}


def _lineage(p):
    """The literals of each stage; the n-th of a stage is spoiled in the rows of tickers that end in n."""
    parts = []
    for stage, literals in _LITERALS.items():
        rows = (p.stored_training if stage == "training" else getattr(p, stage)).select("ticker", *literals)
        spoiled = rows.withColumns({c: _put(str(n), c, F.lit(None) if n % 2 else F.lit("other")) for n, c in enumerate(literals)})
        parts.append(CH.expect_single(spoiled, literals, dataset=stage))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


final("lineage_checks", "weekly", _lineage, f"dataset {CHECK}", "training", _status(*[
    f"SELECT '{stage}' AS dataset, '{c.upper()}_IS_{v}' AS check_name, count(*) FILTER ({_D} = '{n}') AS violations FROM {stage}"
    for stage, literals in _LITERALS.items() for n, (c, v) in enumerate(literals.items())]))
final("event_reconciliation", "daily", lambda p: A.event_reconciliation(p.adjusted.filter(F.substring("ticker", -1, 1) != "5"), p.registry),
      "event_type decisions price_rows status", "registry", f"""
  SELECT event_type, count(*) AS decisions, count(*) FILTER ({_D} <> '5') AS price_rows, CASE WHEN count(*) FILTER ({_D} = '5') = 0 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM registry WHERE review_status = 'CONFIRMED' GROUP BY event_type""")


def _inspected(s, d):
    p = Pipeline.daily(s, d)
    orders = TB.read(s, d, "orders").select(F.col("o_custkey").cast("string").alias("ticker"), F.to_date("o_orderdate").alias("day"), "o_totalprice")
    return HE.inspect_table(p.panel, "panel", ("ticker", "trade_date"), ("close_price",)).unionByName(
        HE.inspect_table(p.candidates, "candidates", ("ticker", "event_date"), ("event_date", "reviewed_by"))).unionByName(
        HE.inspect_table(orders.withColumn("day", F.when(F.day("day") > 1, F.col("day"))), "orders", ("ticker", "day"), ("day", "o_totalprice")))


register("dataset_inspection", _inspected, "dataset rows tickers duplicate_rows required_nulls missing_columns schema_status", price_sql("daily", """
  SELECT *, CASE WHEN missing_columns = '' AND required_nulls = 0 THEN 'PASS' ELSE 'FAIL' END AS schema_status FROM (
    SELECT 'panel' AS dataset, count(*) AS rows, count(DISTINCT ticker) AS tickers, count(*) - count(DISTINCT (ticker, trade_date)) AS duplicate_rows,
           count(*) - count(close_price) AS required_nulls, '' AS missing_columns FROM panel
    UNION ALL SELECT 'candidates', count(*), count(DISTINCT ticker), count(*) - count(DISTINCT (ticker, event_date)), count(*) - count(event_date), 'reviewed_by' FROM candidates
    UNION ALL SELECT 'orders', count(*), count(DISTINCT o_custkey), count(*) - count(DISTINCT (o_custkey, d)), count(*) - count(d), ''
    FROM (SELECT o_custkey, CASE WHEN day(o_orderdate) > 1 THEN CAST(o_orderdate AS DATE) END AS d FROM orders))""", "candidates"))


# --- checks over spoiled stages ----------------------------------------------------------
def planted(key, kind, stage, check, rules, keys, plants, twice):
    """The checks of a stage in which values are replaced by the last digit of the ticker, and the rows of one digit are there twice.

    plants: per column the digits with the SQL of the value, read by both engines.
    """
    cases = {c: "CASE " + " ".join(f"WHEN {_D} = '{d}' THEN {v}" for d, v in wanted.items()) + f" ELSE {c} END" for c, wanted in plants.items()}

    def run(p):
        rows = getattr(p, stage)
        spoiled = rows.withColumns({c: F.expr(e) for c, e in cases.items()})
        return check(spoiled.unionByName(spoiled.filter(f"{_D} = '{twice}'")))
    replaced = ", ".join(f"{e} AS {c}" for c, e in cases.items())
    table = f"(SELECT * REPLACE ({replaced}) FROM {stage} UNION ALL SELECT * REPLACE ({replaced}) FROM {stage} WHERE {_D} = '{twice}')"
    final(key, kind, run, CHECK, stage, checks_sql(table, rules, keys))


_NAN = "CAST('NaN' AS DOUBLE)"
planted("adjusted_checks_planted", "weekly", "adjusted", A.adjusted_checks, ADJUSTED_RULES, "ticker, trade_date", {
    "structural_adjustment_factor": {"0": "-1.0"}, "daily_return_raw": {"1": _NAN}, "daily_return_adjusted_price": {"2": "1.0", "8": _NAN}, "daily_return_economic": {"3": _NAN},
    "cash_amount_per_unit_raw": {"4": "cash_amount_per_unit_raw + 1"}, "cash_flow_per_unit_adjusted": {"5": "cash_flow_per_unit_adjusted + 1"},
    "confirmed_event_type": {"6": "'SPLIT'"}}, "7")
planted("history_checks_planted", "weekly", "history", H.history_checks, HISTORY_RULES, "ticker, trade_date", {
    "observations_count": {"0": "1"}, "ma_5": {"1": "NULL"}, "ma_10": {"1": "NULL"}, "ma_20": {"1": "NULL"},
    **{f"return_{n}d_pct": {"2": f"return_{n}d_pct + 1"} for n in C.DEFAULT_WINDOWS}, "daily_return": {"3": "daily_return + 1"},
    **{c: {"4": f"{c} + 1"} for c in C.PRICES}}, "5")
planted("feature_checks_planted", "weekly", "features", FE.feature_checks, FEATURE_RULES, "ticker, feature_date", {
    **{c: {"0": _NAN} for c in C.feature_names() if c != "daily_return"}, "observations_count": {"1": "5"}, "daily_return": {"0": _NAN, "2": "NULL"}, "feature_date": {"3": "NULL"}}, "4")
planted("split_checks_planted", "weekly", "split", S.split_checks, SPLIT_RULES, "ticker, feature_date", {
    "feature_date": {"0": "validation_start", "2": "DATE '1999-01-01'", "3": "test_start"}, "target_date": {"1": "test_start"}, "ml_eligible": {"4": "false"}}, "5")
