"""Quality, freshness, completeness and run state of datasets."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from brickfolio.contracts import require_columns
from brickfolio.functions import columns as X

# fixed values: modes of the freshness rule
DATED_MODES = ("DATA_DATE", "TARGET_DATE")
UNDATED_MODES = ("EVENT_DRIVEN", "HISTORICAL_SPLIT", "HISTORICAL_EXPERIMENT")


@dataclass(frozen=True)
class DatasetSpec:
    """What a healthy dataset looks like."""

    name: str
    key: tuple[str, ...]
    date_column: str
    required: tuple[str, ...] = ()
    freshness_mode: str = "DATA_DATE"
    allow_empty: bool = False


def master_metrics(master: DataFrame) -> DataFrame:
    """One row of counts over the fund master."""
    resolved = X.flag(F.col("resolution_status") == "AUTO_RESOLVED")
    missing = {c: X.blank(c) for c in ("cnpj_classe", "primary_instrument_id", "ticker", "isin")}

    def repeated(test: Column, column: str, name: str) -> Column:
        per = master.filter(test).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return per.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))).scalar().alias(name)

    count = lambda test, name: F.count_if(test).alias(name)
    row = master.agg(
        F.count(F.lit(1)).alias("rows"), count(resolved, "resolved"), count(~resolved, "unresolved"),
        count(F.col("resolution_method") == "B3_UNDERLYING_REFERENCE", "structural_resolution"),
        count(F.col("resolution_method") == "B3_PRIMARY_SIGNATURE", "signature_resolution"),
        count(missing["cnpj_classe"], "missing_cnpj"),
        count(resolved & missing["primary_instrument_id"], "resolved_without_primary_id"),
        count(resolved & missing["ticker"], "resolved_without_ticker"),
        count(resolved & missing["isin"], "resolved_without_isin"),
        count(~resolved & ~missing["primary_instrument_id"], "unresolved_with_primary_id"),
        count(~resolved & ~missing["ticker"], "unresolved_with_ticker"),
        count(~resolved & ~missing["isin"], "unresolved_with_isin"))
    return row.select(
        "*", F.coalesce(X.ratio("resolved", "rows"), F.lit(0.0)).alias("resolution_rate"),
        repeated(~missing["cnpj_classe"], "cnpj_classe", "duplicate_cnpj_rows"),
        repeated(resolved & ~missing["primary_instrument_id"], "primary_instrument_id",
                 "duplicate_primary_instrument_id_rows"))


ZERO_CHECKS = {
    "missing_cnpj": "missing_cnpj", "duplicate_cnpj": "duplicate_cnpj_rows",
    "duplicate_primary_instrument_id": "duplicate_primary_instrument_id_rows",
    **{c: c for c in ("resolved_without_primary_id", "resolved_without_ticker", "resolved_without_isin",
                      "unresolved_with_primary_id", "unresolved_with_ticker", "unresolved_with_isin")},
}


def master_quality(master: DataFrame, required: tuple[str, ...] = (), min_rate: float = 0.90) -> DataFrame:
    """Twelve named checks; only the resolution rate may warn instead of fail."""
    absent = len(set(required) - set(master.columns))
    checks = [
        ("dataset_not_empty", F.col("rows"), F.col("rows") > 0, "FAIL"),
        ("required_columns", F.lit(absent).cast("bigint"), F.lit(absent == 0), "FAIL"),
        *[(name, F.col(c), F.col(c) == 0, "FAIL") for name, c in ZERO_CHECKS.items()],
        ("resolution_rate", F.col("resolved"), F.col("resolution_rate") >= min_rate, "WARN"),
    ]
    return master_metrics(master).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), value.cast("bigint").alias("measured"),
                 F.when(good, "PASS").otherwise(bad).alias("status"))
        for name, value, good, bad in checks])))


def worst_status(checks: DataFrame, *group: str) -> DataFrame:
    """FAIL beats WARN beats PASS, with the number of checks of each status."""
    s = F.col("status")
    return checks.groupBy(*group).agg(
        F.when(F.bool_or(s == "FAIL"), "FAIL").when(F.bool_or(s == "WARN"), "WARN").otherwise("PASS").alias("overall_status"),
        F.count(F.lit(1)).alias("checks"), F.count_if(s == "PASS").alias("passed"),
        F.count_if(s == "WARN").alias("warned"), F.count_if(s == "FAIL").alias("failed"))


def inspect(df: DataFrame, spec: DatasetSpec, reference: date, max_days: int) -> DataFrame:
    """One row of measurements and the status of one dataset.

    Grouping by the key first gives rows, key uniqueness and all counts from a
    single exchange with a partial step before it.
    """
    require_columns(df, (*spec.required, *spec.key, spec.date_column), spec.name)
    per_key = df.groupBy(*spec.key).agg(
        F.count(F.lit(1)).alias("n"), F.min(spec.date_column).alias("d0"), F.max(spec.date_column).alias("d1"),
        F.count_if(F.col(spec.date_column).isNull()).alias("bad"))
    row = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_dates"), F.min("d0").alias("min_date"),
        F.max("d1").alias("max_date"))
    age = F.datediff(F.lit(reference), F.col("max_date"))
    if spec.freshness_mode in UNDATED_MODES:
        fresh = F.lit("PASS")
    else:
        fresh = (F.when(F.col("max_date").isNull(), "PASS" if spec.allow_empty else "FAIL")
                 .when(age < 0, "FAIL").when(age <= max_days, "PASS").otherwise("FAIL"))
    healthy = (F.col("duplicate_rows") == 0) & (F.col("invalid_dates") == 0)
    if not spec.allow_empty:
        healthy = healthy & (F.col("rows") > 0)
    return row.select(
        F.lit(spec.name).alias("dataset"), "*", F.lit(spec.freshness_mode).alias("freshness_mode"),
        age.alias("freshness_days"), fresh.alias("freshness_status"),
        F.when(healthy, "PASS").otherwise("FAIL").alias("content_status"),
    ).withColumn("status", F.when(
        (F.col("freshness_status") == "PASS") & (F.col("content_status") == "PASS"), "PASS").otherwise("FAIL"))


def inspect_table(df: DataFrame, name: str, key: tuple[str, ...], required: tuple[str, ...], ticker: str = "ticker") -> DataFrame:
    """One row: rows, distinct tickers, repeated keys, and whether the required columns are there and filled. Keys and tickers are
    counted before they are gathered."""
    missing = sorted(set(required) - set(df.columns))
    per_key = df.groupBy(ticker, *[k for k in key if k != ticker]).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required if c not in missing])
    per_ticker = per_key.groupBy(ticker).agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("again"), *[F.sum(c).alias(c) for c in per_key.columns if c.startswith("null_")])
    nulls = sum((F.coalesce(F.sum(c), F.lit(0)) for c in per_ticker.columns if c.startswith("null_")), F.lit(0)).cast("bigint")
    return per_ticker.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(ticker).alias("tickers"), F.coalesce(F.sum("again"), F.lit(0)).alias("duplicate_rows"),
        nulls.alias("required_nulls")).select(
        F.lit(name).alias("dataset"), "*", F.lit(",".join(missing)).alias("missing_columns"),
        F.when(F.lit(not missing) & (F.col("required_nulls") == 0), "PASS").otherwise("FAIL").alias("schema_status"))


def dataset_health(datasets: list[tuple[DataFrame, DatasetSpec]], reference: date, max_days: int) -> DataFrame:
    return reduce(DataFrame.unionByName, [inspect(df, spec, reference, max_days) for df, spec in datasets])


def reconcile_keys(left: DataFrame, right: DataFrame, key: list[str], name: str) -> DataFrame:
    """Row counts and key sets of two datasets must agree; one full outer join of counted keys."""
    a = left.groupBy(*key).agg(F.count(F.lit(1)).alias("a"))
    b = right.groupBy(*key).agg(F.count(F.lit(1)).alias("b"))
    na, nb = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    return a.join(b, key, "full_outer").agg(
        F.coalesce(F.sum(na), F.lit(0)).alias("left_rows"), F.coalesce(F.sum(nb), F.lit(0)).alias("right_rows"),
        F.count_if(nb == 0).alias("only_left"), F.count_if(na == 0).alias("only_right"),
    ).select(F.lit(name).alias("relation"), "*").withColumn(
        "status", F.when((F.col("left_rows") == F.col("right_rows")) & (F.col("only_left") == 0)
                         & (F.col("only_right") == 0), "PASS").otherwise("FAIL"))


def reconcile_metrics(stored: DataFrame, computed: DataFrame, key: str, columns: list[str],
                      tolerance: float = 1e-12) -> DataFrame:
    """Stored summary values against recomputed ones, one row per (key, metric)."""
    a = stored.unpivot([key], columns, "metric", "stored_value")
    b = computed.unpivot([key], columns, "metric", "computed_value")
    return a.join(b, [key, "metric"], "full_outer").withColumn(
        "difference", F.abs(F.col("stored_value") - F.col("computed_value"))).withColumn(
        "status", F.when(F.col("difference") <= tolerance, "PASS").otherwise("FAIL"))


def with_injected_duplicate(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Fault injection: the row with the smallest key once more."""
    first = df.orderBy(*key).limit(1)
    return df.unionByName(first)


# --- run state ----------------------------------------------------------------

def execution_state(states: DataFrame, now: datetime, stale_minutes: int) -> DataFrame:
    """Classifies runs: ``output_exists``, ``status`` and ``started_at`` per run date."""
    s = F.upper(F.trim("status"))
    stale = F.col("started_at") <= F.lit(now).cast("timestamp") - F.make_dt_interval(mins=F.lit(stale_minutes))
    state = (
        F.when(F.col("output_exists"), "COMPLETE").when(F.col("status").isNull(), "NO_STATE")
        .when(s == "FAILED", "RETRY_ALLOWED").when(s == "SUCCEEDED", "INCONSISTENT_STATE")
        .when((s == "STARTED") & X.flag(stale), "RETRY_ALLOWED").when(s == "STARTED", "IN_PROGRESS")
        .otherwise("UNKNOWN_STATE"))
    return states.withColumn("execution_state", state)


def cycle_state(runs: DataFrame, inventory: DataFrame, sources: list[str], now: datetime,
                stale_minutes: int) -> DataFrame:
    """What each run date needs, from the objects of each layer and source.

    ``inventory`` has one row per object (run_date, layer, source). Its counts
    are pivoted by a fixed list of layer-source pairs, so one aggregate does it.
    """
    of = lambda layer, s: (F.col("layer") == layer) & (F.col("source") == s)
    layers = inventory.groupBy("run_date").agg(
        *[F.count_if(of(layer, s)).alias(f"{layer}_{s}") for layer in ("raw", "silver") for s in sources])
    joined = execution_state(runs, now, stale_minutes).join(layers, "run_date", "left")
    n = lambda layer, s: F.coalesce(F.col(f"{layer}_{s}"), F.lit(0))
    ambiguous = X.any_of([n("silver", s) > 1 for s in sources])
    complete = X.all_of([n("silver", s) == 1 for s in sources])
    rebuildable = X.all_of([(n("silver", s) == 1) | (n("raw", s) == 1) for s in sources])
    e = F.col("execution_state")
    state = (
        F.when(e == "COMPLETE", "COMPLETE").when(e == "IN_PROGRESS", "IN_PROGRESS")
        .when(e.isin("INCONSISTENT_STATE", "UNKNOWN_STATE") | ambiguous, "RECOVERY_BLOCKED")
        .when(complete, "GOLD_RETRY_REQUIRED").when(rebuildable, "RAW_REBUILD_REQUIRED").otherwise("RECOVERY_BLOCKED"))
    return joined.select("run_date", "execution_state", state.alias("cycle_state"))


def state_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("cycle_state").agg(F.count(F.lit(1)).alias("run_dates"))


# fixed values: what to do about a run date in each state
ACTIONS = {
    "COMPLETE": "NO_ACTION",
    "IN_PROGRESS": "WAIT_FOR_COMPLETION",
    "GOLD_RETRY_REQUIRED": "RETRY_GOLD",
    "RAW_REBUILD_REQUIRED": "REBUILD_SILVER_FROM_RAW",
    "RECOVERY_BLOCKED": "ALERT_AND_INVESTIGATE",
    "MISSING_CYCLE": "INVESTIGATE_MISSING_CYCLE",
}


def with_action(states: DataFrame) -> DataFrame:
    """Adds the action of each state; a state without one is an error."""
    action = F.lit(None).cast("string")
    for state, name in ACTIONS.items():
        action = F.when(F.col("cycle_state") == state, name).otherwise(action)
    unknown = F.raise_error(F.concat(F.lit("no action for the state "), F.coalesce("cycle_state", F.lit("null")))).cast("string")
    return states.withColumn("action", F.coalesce(action, unknown))


def action_counts(states: DataFrame) -> DataFrame:
    return with_action(states).groupBy("action").agg(F.count(F.lit(1)).alias("run_dates"))
