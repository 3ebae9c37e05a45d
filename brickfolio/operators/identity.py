"""Which traded instrument and ticker belong to which fund."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.operators.checks import duplicate_rows

REGISTER_REQUIRED = ("CNPJ_Classe", "Codigo_CVM", "Denominacao_Social", "Tipo_Classe", "Situacao")
_CHOSEN = ["primary_instrument_id", "ticker", "isin", "instrument_id_type", "listing_market", "asset", "corporate_name"]
MASTER_COLUMNS = ["cnpj_classe", "codigo_cvm", "denominacao_social", "situacao_cvm", "core_name", *_CHOSEN,
                  "resolution_method", "resolution_status", "resolution_evidence"]


def fund_classes(register: DataFrame) -> DataFrame:
    return register.filter(F.col("Tipo_Classe") == C.FUND_CLASS)


def prepare_funds(register: DataFrame) -> DataFrame:
    C.require_columns(register, REGISTER_REQUIRED, "register")
    return fund_classes(register).withColumns({
        "CNPJ_Classe": F.trim("CNPJ_Classe"), "Codigo_CVM": F.trim("Codigo_CVM"),
        "core_name": X.core_name("Denominacao_Social"),
    }).filter("core_name <> ''")


def prepare_instruments(instruments: DataFrame) -> DataFrame:
    text = ["instrument_id", "instrument_id_type", "listing_market", "ticker", "isin", "asset", "corporate_name",
            "security_category", "b3_market", "b3_segment", "instrument_type", "underlying_instrument_id"]
    C.require_columns(instruments, text + ["report_date"], "instruments")
    return instruments.withColumns({c: F.trim(c) for c in text}).withColumn(
        "core_name", X.core_name("corporate_name")).filter("core_name <> ''")


def name_bridge(funds: DataFrame, instruments: DataFrame) -> DataFrame:
    """Instruments joined to the funds whose core name belongs to one fund id only.

    One aggregate per name finds both the uniqueness (smallest id = largest id)
    and the fund row, so no semi-join follows.
    """
    owner = funds.groupBy("core_name").agg(
        F.min("CNPJ_Classe").alias("CNPJ_Classe"), F.max("CNPJ_Classe").alias("last_id"),
        F.min(F.struct("Codigo_CVM", "Denominacao_Social", "Situacao")).alias("fund"),
    ).filter(F.col("CNPJ_Classe") == F.col("last_id")).select("core_name", "CNPJ_Classe", "fund.*")
    return instruments.join(owner, "core_name", "inner").dropDuplicates(["instrument_id", "CNPJ_Classe"])


def mark_evidence(bridge: DataFrame, instruments: DataFrame, trades: DataFrame | None) -> DataFrame:
    """Three facts per candidate: named as underlying, primary signature, traded."""
    def members(df: DataFrame, column: str, mark: str) -> DataFrame:
        return df.filter(F.col(column).isNotNull()).select(F.col(column).alias("instrument_id")).distinct().withColumn(
            mark, F.lit(True))

    out = bridge.join(members(instruments, "underlying_instrument_id", "named"), "instrument_id", "left")
    out = out.join(members(trades, "instrument_id", "seen"), "instrument_id", "left") if trades is not None \
        else out.withColumn("seen", F.lit(False))
    signature = X.all_of([X.flag(F.col(c) == v) for c, v in C.PRIMARY_SIGNATURE.items()]
                         + [X.flag(F.col("ticker").endswith(C.PRIMARY_TICKER_SUFFIX))])
    return out.withColumns({
        "is_underlying_target": X.flag("named"), "matches_primary_signature": signature,
        "is_traded": X.flag("seen"),
    }).drop("named", "seen")


def resolve_primary(marked: DataFrame) -> DataFrame:
    """One row per fund: the single structural candidate, else the single signature candidate.

    The bridge holds each (instrument, fund) once, so counting rows counts
    candidates and the aggregate keeps one struct per kind, never the group.
    """
    structural, signature = F.col("is_underlying_target"), F.col("matches_primary_signature")
    row = F.struct(F.col("instrument_id").alias("primary_instrument_id"), *_CHOSEN[1:], "is_traded")
    grouped = marked.groupBy(F.col("CNPJ_Classe").alias("cnpj_classe")).agg(
        F.min(F.struct("Codigo_CVM", "Denominacao_Social", "Situacao", "core_name")).alias("fund"),
        F.count_if(structural).alias("structural_candidates"), F.count_if(signature).alias("signature_candidates"),
        F.min(F.when(structural, row)).alias("structural"), F.min(F.when(signature, row)).alias("signature"))
    by_structure = F.col("structural_candidates") == 1
    by_signature = (F.col("structural_candidates") == 0) & (F.col("signature_candidates") == 1)
    chosen = F.when(by_structure, F.col("structural")).when(by_signature, F.col("signature"))
    picked = grouped.withColumn("chosen", chosen)
    traded = F.when(F.col("chosen.is_traded"), "_AND_TRADED").otherwise("_ONLY")
    return picked.select(
        "cnpj_classe", F.col("fund.Codigo_CVM").alias("codigo_cvm"),
        F.col("fund.Denominacao_Social").alias("denominacao_social"), F.col("fund.Situacao").alias("situacao_cvm"),
        F.col("fund.core_name").alias("core_name"), *[F.col(f"chosen.{c}").alias(c) for c in _CHOSEN],
        F.when(by_structure, "B3_UNDERLYING_REFERENCE").when(by_signature, "B3_PRIMARY_SIGNATURE")
        .alias("resolution_method"),
        F.when(by_structure | by_signature, "AUTO_RESOLVED").otherwise("UNRESOLVED").alias("resolution_status"),
        F.when(by_structure, F.concat(F.lit("STRUCTURAL"), traded))
        .when(by_signature, F.concat(F.lit("SIGNATURE"), traded)).alias("resolution_evidence"))


def fund_master(register: DataFrame, instruments: DataFrame, trades: DataFrame | None = None) -> DataFrame:
    prepared = prepare_instruments(instruments)
    bridge = name_bridge(prepare_funds(register), prepared)
    reference = prepared.agg(F.max("report_date")).scalar()
    return resolve_primary(mark_evidence(bridge, prepared, trades)).withColumn("reference_date", reference)


# --- mapping source -----------------------------------------------------------

def join_sources(funds: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Inner join on the id, and the unmatched rows of each side."""
    return (funds.join(mapping, "cnpj", "inner"), funds.join(mapping, "cnpj", "left_anti"),
            mapping.join(funds, "cnpj", "left_anti"))


def source_quality(funds: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows, missing and repeated keys of both sources."""
    def profile(df: DataFrame, source: str, column: str) -> DataFrame:
        per_key = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        present = F.col(column).isNotNull()
        return per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("missing_keys"),
            F.count_if(present).alias("distinct_keys"),
            F.coalesce(F.sum(F.when(present & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("rows_in_repeated_keys"),
        ).select(F.lit(source).alias("source_name"), F.lit(column).alias("key_column"), "*")
    return profile(funds, "register", "cnpj").unionByName(profile(mapping, "mapping", "cnpj")).unionByName(
        profile(mapping, "mapping", "ticker"))


def join_coverage(funds: DataFrame, mapping: DataFrame) -> DataFrame:
    """How many ids of each side the other side knows; both sides reduced to ids first."""
    f = funds.select("cnpj").distinct().withColumn("f", F.lit(True))
    m = mapping.select("cnpj").distinct().withColumn("m", F.lit(True))
    in_f, in_m = F.col("f").isNotNull(), F.col("m").isNotNull()
    return f.join(m, "cnpj", "full_outer").agg(
        F.count_if(in_f).alias("register_ids"), F.count_if(in_m).alias("mapping_ids"),
        F.count_if(in_f & in_m).alias("matched_ids"),
    ).withColumns({
        "register_match_rate": X.ratio("matched_ids", "register_ids"),
        "mapping_match_rate": X.ratio("matched_ids", "mapping_ids"),
    })


def id_conflicts(funds: DataFrame) -> DataFrame:
    """All rows whose id occurs more than once."""
    return duplicate_rows(funds, "cnpj")


def without_conflicts(funds: DataFrame) -> DataFrame:
    return funds.join(id_conflicts(funds).select("cnpj").distinct(), "cnpj", "left_anti")


# --- market evidence ------------------------------------------------------------

def latest_sessions(panel: DataFrame, n: int) -> DataFrame:
    """Rows of the last n sessions. The date list has one row per day at most."""
    dates = panel.select("trade_date").distinct().orderBy(F.desc("trade_date")).limit(n)
    return panel.join(F.broadcast(dates), "trade_date", "left_semi")


def market_evidence(trades: DataFrame) -> DataFrame:
    """Sessions and dates per ticker; a ticker's date list is bounded by the session window."""
    seen = trades.select(X.upper_trim("ticker").alias("ticker"), "trade_date").filter("ticker <> ''").distinct()
    return seen.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("market_evidence_days"),
        F.array_join(F.array_sort(F.collect_list(F.col("trade_date").cast("string"))), ",").alias("market_evidence_dates"))


def confidence(days: Column, window: Column) -> Column:
    share = days / window
    return F.when(days == 0, "NO_EVIDENCE").when(share >= 0.8, "HIGH").when(share >= 0.4, "MEDIUM").otherwise("LOW")


def ticker_history(funds: DataFrame, mapping: DataFrame, evidence: DataFrame, window: int) -> DataFrame:
    return funds.join(mapping, "cnpj", "inner").join(evidence, "ticker", "left").withColumns({
        "market_evidence_days": F.coalesce("market_evidence_days", F.lit(0)),
        "market_evidence_dates": F.coalesce("market_evidence_dates", F.lit("")),
        "market_evidence_window": F.lit(window),
    }).withColumns({
        "market_evidence_ratio": F.col("market_evidence_days") / F.lit(window),
        "market_evidence_confidence": confidence(F.col("market_evidence_days"), F.lit(window)),
    })


def resolve_current(history: DataFrame) -> DataFrame:
    active = F.col("market_evidence_days") > 0
    known = F.struct("ticker", "market_evidence_days")
    grouped = history.groupBy("cnpj").agg(
        F.min(F.struct("Codigo_CVM", "Denominacao_Social", "Situacao")).alias("fund"),
        F.min("ticker").alias("first_ticker"), F.max("ticker").alias("last_ticker"),
        F.count_if(active).alias("active_tickers"), F.min(known).alias("first"),
        F.min(F.when(active, known)).alias("active"), F.max("market_evidence_window").alias("market_evidence_window"))
    single = F.col("first_ticker") == F.col("last_ticker")
    chosen = F.when(single, F.col("first")).when(F.col("active_tickers") == 1, F.col("active"))
    days = F.coalesce(F.col("chosen.market_evidence_days"), F.lit(0))
    return grouped.withColumn("chosen", chosen).select(
        "cnpj", F.col("fund.Codigo_CVM").alias("codigo_cvm"),
        F.col("fund.Denominacao_Social").alias("denominacao_social"), F.col("fund.Situacao").alias("situacao_cvm"),
        F.col("chosen.ticker").alias("ticker_current_candidate"),
        F.when(single, "SINGLE_TICKER").when(F.col("active_tickers") == 1, "RESOLVED_BY_B3")
        .when(F.col("active_tickers") == 0, "NO_MARKET_EVIDENCE").otherwise("MULTIPLE_ACTIVE_CANDIDATES")
        .alias("ticker_resolution_status"),
        days.alias("market_evidence_days"), "market_evidence_window",
        confidence(days, F.col("market_evidence_window")).alias("market_evidence_confidence"))


def mark_current(history: DataFrame, current: DataFrame) -> DataFrame:
    chosen = current.select("cnpj", "ticker_current_candidate", "ticker_resolution_status")
    return history.join(chosen, "cnpj", "left").withColumn(
        "is_current_candidate", X.flag(F.col("ticker") == F.col("ticker_current_candidate")))


def ambiguity_summary(history: DataFrame) -> DataFrame:
    """Ids with several tickers and whether the market decides between them."""
    per_ticker = history.groupBy("cnpj", "ticker").agg(F.max("market_evidence_days").alias("days"))
    active = F.col("days") > 0
    n = F.col("tickers_with_market_evidence")
    return per_ticker.groupBy("cnpj").agg(
        F.count(F.lit(1)).alias("candidate_tickers"), F.count_if(active).alias("tickers_with_market_evidence"),
        F.min(F.when(active, F.col("ticker"))).alias("first_active"),
    ).filter("candidate_tickers > 1").withColumns({
        "resolution_status": F.when(n == 0, "NO_MARKET_EVIDENCE").when(n == 1, "RESOLVED")
        .otherwise("MULTIPLE_ACTIVE_CANDIDATES"),
        "current_ticker_candidate": F.when(n == 1, F.col("first_active")),
    }).drop("first_active")


def coverage(history: DataFrame) -> DataFrame:
    days, window = F.col("market_evidence_days"), F.col("market_evidence_window")
    return history.select("ticker", "market_evidence_days", "market_evidence_window").distinct().agg(
        F.count(F.lit(1)).alias("tickers"), F.count_if(days > 0).alias("seen_at_least_once"),
        F.count_if(days == window).alias("seen_every_session"),
    ).withColumn("coverage_rate", X.ratio("seen_at_least_once", "tickers"))


# --- name profiles ----------------------------------------------------------------

def name_profile(funds: DataFrame, instruments: DataFrame) -> DataFrame:
    """Per core name: sizes of both sides and the match status."""
    market = instruments.groupBy("core_name").agg(
        F.count("instrument_id").alias("b3_rows"), *[
            F.countDistinct(c).alias(n) for c, n in (
                ("instrument_id", "b3_instrument_ids"), ("ticker", "b3_tickers"), ("isin", "b3_isins"),
                ("asset", "b3_assets"), ("corporate_name", "b3_corporate_names"))])
    return funds.groupBy("core_name").agg(
        F.count("CNPJ_Classe").alias("cvm_rows"), F.countDistinct("CNPJ_Classe").alias("cvm_cnpjs"),
        F.countDistinct("Codigo_CVM").alias("cvm_codes"),
    ).join(market, "core_name", "left").withColumn(
        "match_status", F.when(F.col("b3_rows").isNull(), "NO_B3_MATCH").when(F.col("cvm_cnpjs") == 1, "UNIQUE_MATCH")
        .otherwise("AMBIGUOUS_MATCH"))


PROFILE_ATTRIBUTES = ("instrument_type", "security_category", "b3_market", "b3_segment")


def pattern_profile(marked: DataFrame, master: DataFrame) -> DataFrame:
    """Candidate counts by attribute value and ticker ending, for resolved and unresolved funds."""
    status = master.select(F.col("cnpj_classe").alias("CNPJ_Classe"), "resolution_status")
    ending = F.nullif(F.regexp_extract("ticker", r"(\d+)$", 1), F.lit(""))
    counted = marked.join(status, "CNPJ_Classe").groupBy(
        "resolution_status", *PROFILE_ATTRIBUTES, ending.alias("ticker_suffix")).agg(F.count(F.lit(1)).alias("n"))
    return counted.unpivot(
        ["resolution_status", "n"], [*PROFILE_ATTRIBUTES, "ticker_suffix"], "attribute", "attribute_value"
    ).groupBy("resolution_status", "attribute", "attribute_value").agg(F.sum("n").alias("candidate_rows"))


def trade_only_profile(marked: DataFrame, master: DataFrame) -> DataFrame:
    """The profile of candidates whose only evidence is that they were traded, in funds that were not resolved."""
    alone = marked.filter(X.flag("is_traded") & ~X.flag("is_underlying_target") & ~X.flag("matches_primary_signature"))
    return pattern_profile(alone, master.filter(F.col("resolution_status") != "AUTO_RESOLVED"))


def silver_master_checks(master: DataFrame, dataset: str | None = None) -> DataFrame:
    """The silver master has rows, and every id is there and once; one pass over the ids, whatever their copies."""
    per_id = master.groupBy("cnpj").agg(F.count(F.lit(1)).alias("n"))
    totals = per_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("cnpj").isNull(), F.col("n"))), F.lit(0)).alias("absent"),
                        F.coalesce(F.sum(F.when(F.col("cnpj").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("again"))
    found = {"NOT_EMPTY": (F.col("rows") == 0).cast("bigint"), "ID_PRESENT": F.col("absent"), "ID_UNIQUE": F.col("again")}
    out = totals.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), v.cast("bigint").alias("violations")) for n, v in found.items()])))
    out = out.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
    return out if dataset is None else out.select(F.lit(dataset).alias("dataset"), *out.columns)
