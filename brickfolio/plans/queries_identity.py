"""Queries of identity resolution, the daily snapshot and text normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.operators import checks as CH, health as HE, identity as ID, snapshot as SN
from brickfolio.plans import tables as TB
from brickfolio.plans.catalog import register
from brickfolio.plans.oracle_price import price_sql
from brickfolio.plans.queries_price import CHECK, checks_sql
from brickfolio.plans.shape import select_list

WINDOW = 10
_STOP = ", ".join(f"'{t}'" for t in C.GENERIC_NAME_TOKENS)


def core_sql(text: str) -> str:
    clean = f"upper(regexp_replace(strip_accents({text}), '[^\\x00-\\x7F]', '', 'g'))"
    words = f"string_split(trim(regexp_replace({clean}, '[^A-Z0-9]+', ' ', 'g')), ' ')"
    return f"array_to_string(list_filter({words}, lambda w: w NOT IN ({_STOP})), ' ')"


_T = "CASE {k} WHEN 0 THEN '11' WHEN 1 THEN '12' ELSE '13' END"
PARTS = {
    "register": f"""
      SELECT lpad(CAST(CASE WHEN p_partkey % 50 = 1 THEN p_partkey - 1 ELSE p_partkey END AS VARCHAR), 14, '0') AS CNPJ_Classe,
             CAST(p_partkey AS VARCHAR) AS Codigo_CVM,
             CASE WHEN p_type = 'SMALL' THEN 'Outros' ELSE '{C.FUND_CLASS}' END AS Tipo_Classe,
             'Fundo de Investimento Imobiliário ' || p_name || ' ' || p_brand || ' ' || p_size || ' - FII' AS Denominacao_Social,
             CASE WHEN p_size % 10 = 0 THEN 'Cancelado' ELSE 'Em Funcionamento Normal' END AS Situacao,
             DATE '2001-01-01' + p_size AS Data_Registro, p_retailprice AS Patrimonio_Liquido FROM part""",
    "funds": f"SELECT *, {core_sql('Denominacao_Social')} AS core_name FROM register WHERE Tipo_Classe = '{C.FUND_CLASS}'",
    "silver": "SELECT CNPJ_Classe AS cnpj, Codigo_CVM, Denominacao_Social, Situacao FROM funds",
    "listed": """
      SELECT l_partkey, l_suppkey % 3 AS kind, CAST(max(l_shipdate) AS DATE) AS report_date FROM lineitem GROUP BY 1, 2""",
    "instruments0": f"""
      SELECT 'I' || l_partkey || '-' || kind AS instrument_id, '8' AS instrument_id_type, 'BVMF' AS listing_market,
             'P' || l_partkey || {_T.format(k="kind")} AS ticker, 'BR' || l_partkey || kind AS isin, 'A' || l_partkey AS asset,
             'FDO INV IMOB ' || upper(p_name) || ' ' || p_brand || ' ' || p_size AS corporate_name,
             CASE WHEN kind = 0 OR l_partkey % 5 = 0 THEN '6' ELSE '1' END AS security_category, '10' AS b3_market,
             '1' AS b3_segment, CASE WHEN kind = 2 THEN 'OptnOnEqtsInf' ELSE 'EqtyInf' END AS instrument_type,
             CASE WHEN kind = 2 AND l_partkey % 4 <= 1 THEN 'I' || l_partkey || '-0'
                  WHEN kind = 2 AND l_partkey % 4 = 2 THEN 'I' || l_partkey || '-1'
                  WHEN kind = 1 AND l_partkey % 16 = 2 THEN 'I' || l_partkey || '-0' END AS underlying_instrument_id,
             report_date
      FROM listed JOIN part ON p_partkey = l_partkey""",
    "instruments": f"SELECT *, {core_sql('corporate_name')} AS core_name FROM instruments0",
    "bridge": """
      SELECT i.*, o.CNPJ_Classe, f.Codigo_CVM, f.Denominacao_Social, f.Situacao FROM instruments i
      JOIN (SELECT core_name, min(CNPJ_Classe) AS CNPJ_Classe FROM funds GROUP BY 1 HAVING count(DISTINCT CNPJ_Classe) = 1) o
        USING (core_name)
      JOIN (SELECT CNPJ_Classe, core_name, s.a AS Codigo_CVM, s.b AS Denominacao_Social, s.c AS Situacao
            FROM (SELECT CNPJ_Classe, core_name, min({'a': Codigo_CVM, 'b': Denominacao_Social, 'c': Situacao}) AS s
                  FROM funds GROUP BY 1, 2)) f
        USING (CNPJ_Classe, core_name)""",
    "traded": "SELECT DISTINCT CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN '' ELSE 'U' END || 'I' || l_partkey || '-' || (l_suppkey % 3) AS id FROM lineitem",
    "marked": f"""
      SELECT *, instrument_id IN (SELECT underlying_instrument_id FROM instruments WHERE underlying_instrument_id IS NOT NULL)
               AS is_underlying_target,
             instrument_type = 'EqtyInf' AND security_category = '6' AND b3_market = '10' AND b3_segment = '1'
               AND ticker LIKE '%11' AS matches_primary_signature,
             instrument_id IN (SELECT id FROM traded) AS is_traded FROM bridge""",
    "counted": """
      SELECT CNPJ_Classe, min({'a': Codigo_CVM, 'b': Denominacao_Social, 'c': Situacao, 'd': core_name}) AS fund,
             count(*) FILTER (is_underlying_target) AS ns, count(*) FILTER (matches_primary_signature) AS ng,
             min(instrument_id) FILTER (is_underlying_target) AS sid, min(instrument_id) FILTER (matches_primary_signature) AS gid
      FROM marked GROUP BY 1""",
    "master": """
      SELECT c.CNPJ_Classe AS cnpj_classe, fund.a AS codigo_cvm, fund.b AS denominacao_social, fund.c AS situacao_cvm,
             fund.d AS core_name, m.instrument_id AS primary_instrument_id, m.ticker, m.isin, m.instrument_id_type,
             m.listing_market, m.asset, m.corporate_name,
             CASE WHEN ns = 1 THEN 'B3_UNDERLYING_REFERENCE' WHEN ns = 0 AND ng = 1 THEN 'B3_PRIMARY_SIGNATURE' END
               AS resolution_method,
             CASE WHEN ns = 1 OR (ns = 0 AND ng = 1) THEN 'AUTO_RESOLVED' ELSE 'UNRESOLVED' END AS resolution_status,
             CASE WHEN ns = 1 THEN 'STRUCTURAL' WHEN ns = 0 AND ng = 1 THEN 'SIGNATURE' END
               || CASE WHEN m.is_traded THEN '_AND_TRADED' ELSE '_ONLY' END AS resolution_evidence,
             (SELECT max(report_date) FROM instruments) AS reference_date
      FROM counted c LEFT JOIN marked m ON m.CNPJ_Classe = c.CNPJ_Classe
        AND m.instrument_id = CASE WHEN ns = 1 THEN sid WHEN ns = 0 AND ng = 1 THEN gid END""",
    "mapping": f"""
      SELECT DISTINCT CASE WHEN known THEN '' ELSE 'U' END || 'P' || l_partkey || {_T.format(k="(l_suppkey % 3)")} AS ticker,
             lpad(CAST(CASE WHEN known THEN l_partkey ELSE l_partkey + 50000000 END AS VARCHAR), 14, '0') AS cnpj,
             'F ' || l_partkey AS fund_name, 'Ativo' AS category_status, 'mapping' AS source
      FROM (SELECT *, l_linenumber = 7 AND l_returnflag = 'R' AS known FROM lineitem)""",
    "seen": f"""
      SELECT DISTINCT 'P' || l_partkey || {_T.format(k="(l_suppkey % 3)")} AS ticker, CAST(date_trunc('week', l_shipdate) AS DATE) AS trade_date
      FROM lineitem""",
    "evidence": f"""
      SELECT ticker, count(*) AS market_evidence_days,
             string_agg(CAST(trade_date AS VARCHAR), ',' ORDER BY trade_date) AS market_evidence_dates
      FROM seen WHERE trade_date IN (SELECT DISTINCT trade_date FROM seen ORDER BY trade_date DESC LIMIT {WINDOW}) GROUP BY 1""",
    "clean": "SELECT * FROM silver WHERE cnpj NOT IN (SELECT cnpj FROM silver GROUP BY 1 HAVING count(*) > 1)",
    "history": f"""
      SELECT *, CASE WHEN market_evidence_days = 0 THEN 'NO_EVIDENCE' WHEN market_evidence_ratio >= 0.8 THEN 'HIGH'
                     WHEN market_evidence_ratio >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS market_evidence_confidence
      FROM (SELECT f.*, m.ticker, m.fund_name, m.category_status, m.source,
                   coalesce(e.market_evidence_days, 0) AS market_evidence_days,
                   coalesce(e.market_evidence_dates, '') AS market_evidence_dates, {WINDOW} AS market_evidence_window,
                   coalesce(e.market_evidence_days, 0) / {WINDOW}::DOUBLE AS market_evidence_ratio
            FROM clean f JOIN mapping m USING (cnpj) LEFT JOIN evidence e USING (ticker))""",
    "current": f"""
      SELECT *, CASE WHEN market_evidence_days = 0 THEN 'NO_EVIDENCE'
                     WHEN market_evidence_days / {WINDOW}::DOUBLE >= 0.8 THEN 'HIGH'
                     WHEN market_evidence_days / {WINDOW}::DOUBLE >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS market_evidence_confidence
      FROM (SELECT cnpj, min(Codigo_CVM) AS codigo_cvm, min(Denominacao_Social) AS denominacao_social,
                   min(Situacao) AS situacao_cvm,
                   CASE WHEN count(DISTINCT ticker) = 1 THEN min(ticker)
                        WHEN count(*) FILTER (market_evidence_days > 0) = 1
                        THEN min(ticker) FILTER (market_evidence_days > 0) END AS ticker_current_candidate,
                   CASE WHEN count(DISTINCT ticker) = 1 THEN 'SINGLE_TICKER'
                        WHEN count(*) FILTER (market_evidence_days > 0) = 1 THEN 'RESOLVED_BY_B3'
                        WHEN count(*) FILTER (market_evidence_days > 0) = 0 THEN 'NO_MARKET_EVIDENCE'
                        ELSE 'MULTIPLE_ACTIVE_CANDIDATES' END AS ticker_resolution_status,
                   CASE WHEN count(DISTINCT ticker) = 1 OR count(*) FILTER (market_evidence_days > 0) = 1
                        THEN max(market_evidence_days) ELSE 0 END AS market_evidence_days, {WINDOW} AS market_evidence_window
            FROM history GROUP BY cnpj)""",
}
_ORDER = list(PARTS)


def identity_sql(final: str, last: str) -> str:
    names = _ORDER[: _ORDER.index(last) + 1]
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in names) + "\n" + final


def query(key, build, columns, last, sql=None):
    cols = columns.split() if isinstance(columns, str) else list(columns)
    register(key, build, cols, identity_sql(f"SELECT {select_list(cols)} FROM ({sql or f'SELECT * FROM {last}'})", last))


class Identity:
    """The identity tables of one scale factor."""

    def __init__(self, spark, sf_dir):
        self.register = TB.fund_register(spark, sf_dir)
        self.instruments = TB.instruments(spark, sf_dir)
        self.trades = TB.traded_instruments(spark, sf_dir)
        self.mapping = TB.mapping(spark, sf_dir)
        self.silver = TB.silver_funds(self.register)
        self.sightings = TB.part_trades(spark, sf_dir)

    @property
    def bridge(self):
        return ID.name_bridge(ID.prepare_funds(self.register), ID.prepare_instruments(self.instruments))

    @property
    def marked(self):
        return ID.mark_evidence(self.bridge, ID.prepare_instruments(self.instruments), self.trades)

    @property
    def master(self):
        return ID.fund_master(self.register, self.instruments, self.trades)

    @property
    def evidence(self):
        return ID.market_evidence(ID.latest_sessions(self.sightings, WINDOW))

    @property
    def history(self):
        return ID.ticker_history(ID.without_conflicts(self.silver), self.mapping, self.evidence, WINDOW)


def on(build):
    return lambda s, d: build(Identity(s, d))


# --- text -----------------------------------------------------------------------
_RAW_ID = "substr(t, 1, 2) || '.' || substr(t, 3, 3) || '.' || substr(t, 6, 3) || '/' || substr(t, 9, 4) || '-' || substr(t, 13)"


def _raw_ids(spark, sf_dir):
    k = F.col("c_custkey")
    t = F.lpad(k.cast("string"), 14, "0")
    dotted = F.concat(F.substring(t, 1, 2), F.lit("."), F.substring(t, 3, 3), F.lit("."), F.substring(t, 6, 3),
                      F.lit("/"), F.substring(t, 9, 4), F.lit("-"), F.substring(t, 13, 2))
    raw = F.when(k % 7 == 0, F.concat(F.lit("X"), k.cast("string"))).when(k % 11 == 0, F.lit(None)).otherwise(dotted)
    return TB.read(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw_id")).withColumn("tax_id", X.tax_id("raw_id"))


register("normalize_id", _raw_ids, "c_custkey raw_id tax_id", f"""
  SELECT c_custkey, raw_id, CASE WHEN length(regexp_replace(raw_id, '\\D', '', 'g')) = 14
                                 THEN regexp_replace(raw_id, '\\D', '', 'g') END AS tax_id
  FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'X' || c_custkey WHEN c_custkey % 11 = 0 THEN NULL
                               ELSE {_RAW_ID} END AS raw_id
        FROM (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS t FROM customer))""")
register("core_name", lambda s, d: TB.read(s, d, "documents").select(
    "doc_id", X.core_name("text").alias("core_name")), "doc_id core_name",
         f"SELECT doc_id, {core_sql('text')} AS core_name FROM documents")

# --- register, master -------------------------------------------------------------
query("class_filter", on(lambda i: ID.fund_classes(i.register)),
      "CNPJ_Classe Codigo_CVM Tipo_Classe Denominacao_Social Situacao", "funds")
query("typed_register", on(lambda i: ID.fund_classes(i.register).withColumns({
    "Data_Registro": X.to_day("Data_Registro"), "Patrimonio_Liquido": X.to_double("Patrimonio_Liquido").alias("x")})
    .withColumnRenamed("Patrimonio_Liquido", "net_value")),
    "CNPJ_Classe Codigo_CVM Denominacao_Social Situacao Data_Registro net_value", "funds",
    "SELECT *, Patrimonio_Liquido AS net_value FROM funds")
_BRIDGE = "instrument_id ticker isin core_name CNPJ_Classe Codigo_CVM Denominacao_Social Situacao"
query("master_bridge", on(lambda i: i.bridge), _BRIDGE, "bridge")
query("master_evidence", on(lambda i: i.marked),
      "instrument_id ticker CNPJ_Classe is_underlying_target matches_primary_signature is_traded", "marked")
query("master_resolve", on(lambda i: ID.resolve_primary(i.marked)), ID.MASTER_COLUMNS, "master")
query("fii_master", on(lambda i: i.master), ID.MASTER_COLUMNS + ["reference_date"], "master")
_JOIN = "cnpj Codigo_CVM Denominacao_Social Situacao ticker fund_name category_status source"
query("master_join", on(lambda i: ID.join_sources(i.silver, i.mapping)[0]), _JOIN, "mapping",
      "SELECT * FROM silver JOIN mapping USING (cnpj)")
query("master_left_unmatched", on(lambda i: ID.join_sources(i.silver, i.mapping)[1]),
      "cnpj Codigo_CVM Denominacao_Social Situacao", "mapping",
      "SELECT * FROM silver WHERE cnpj NOT IN (SELECT cnpj FROM mapping)")
query("master_right_unmatched", on(lambda i: ID.join_sources(i.silver, i.mapping)[2]),
      "cnpj ticker fund_name category_status source", "mapping",
      "SELECT * FROM mapping WHERE cnpj NOT IN (SELECT cnpj FROM silver)")
register("mapping_scan", lambda s, d: TB.mapping(s, d).withColumns(
    {"ticker": X.upper_trim("ticker"), "cnpj": X.tax_id("cnpj")}), "ticker cnpj fund_name category_status source",
    identity_sql("SELECT * FROM mapping", "mapping"))


def _profile_sql(table, source, key):
    return f"""SELECT '{source}' AS source_name, '{key}' AS key_column, CAST(sum(n) AS BIGINT) AS rows,
      CAST(coalesce(sum(n) FILTER ({key} IS NULL), 0) AS BIGINT) AS missing_keys, count(*) FILTER ({key} IS NOT NULL) AS distinct_keys,
      CAST(coalesce(sum(n) FILTER ({key} IS NOT NULL AND n > 1), 0) AS BIGINT) AS rows_in_repeated_keys
      FROM (SELECT {key}, count(*) AS n FROM {table} GROUP BY 1)"""


query("source_quality", on(lambda i: ID.source_quality(i.silver, i.mapping)),
      "source_name key_column rows missing_keys distinct_keys rows_in_repeated_keys", "mapping",
      " UNION ALL ".join((_profile_sql("silver", "register", "cnpj"), _profile_sql("mapping", "mapping", "cnpj"),
                          _profile_sql("mapping", "mapping", "ticker"))))
query("join_coverage", on(lambda i: ID.join_coverage(i.silver, i.mapping)),
      "register_ids mapping_ids matched_ids register_match_rate mapping_match_rate", "mapping", """
  SELECT *, matched_ids / register_ids AS register_match_rate, matched_ids / mapping_ids AS mapping_match_rate
  FROM (SELECT (SELECT count(DISTINCT cnpj) FROM silver) AS register_ids,
               (SELECT count(DISTINCT cnpj) FROM mapping) AS mapping_ids,
               (SELECT count(DISTINCT cnpj) FROM silver JOIN mapping USING (cnpj)) AS matched_ids)""")
query("duplicate_keys", on(lambda i: CH.duplicate_rows(i.mapping, "cnpj")), "cnpj ticker copies", "mapping",
      "SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY cnpj) AS copies FROM mapping) WHERE copies > 1")
query("id_conflicts", on(lambda i: ID.id_conflicts(i.silver)), "cnpj Codigo_CVM Denominacao_Social Situacao copies", "silver",
      "SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY cnpj) AS copies FROM silver) WHERE copies > 1")
query("market_evidence", on(lambda i: i.evidence), "ticker market_evidence_days market_evidence_dates", "evidence")
_HISTORY = ("cnpj Codigo_CVM Denominacao_Social Situacao ticker fund_name category_status source market_evidence_days "
            "market_evidence_dates market_evidence_window market_evidence_ratio market_evidence_confidence")
query("ticker_history", on(lambda i: i.history), _HISTORY, "history")
query("resolve_current", on(lambda i: ID.resolve_current(i.history)),
      "cnpj codigo_cvm denominacao_social situacao_cvm ticker_current_candidate ticker_resolution_status "
      "market_evidence_days market_evidence_window market_evidence_confidence", "current")
query("mark_current", on(lambda i: ID.mark_current(i.history, ID.resolve_current(i.history))),
      "cnpj ticker ticker_current_candidate ticker_resolution_status is_current_candidate", "current", """
  SELECT h.cnpj, h.ticker, c.ticker_current_candidate, c.ticker_resolution_status,
         coalesce(h.ticker = c.ticker_current_candidate, false) AS is_current_candidate
  FROM history h LEFT JOIN current c USING (cnpj)""")
query("ambiguity_summary", on(lambda i: ID.ambiguity_summary(i.history)),
      "cnpj candidate_tickers tickers_with_market_evidence resolution_status current_ticker_candidate", "history", """
  SELECT cnpj, count(DISTINCT ticker) AS candidate_tickers,
         count(*) FILTER (market_evidence_days > 0) AS tickers_with_market_evidence,
         CASE count(*) FILTER (market_evidence_days > 0) WHEN 0 THEN 'NO_MARKET_EVIDENCE' WHEN 1 THEN 'RESOLVED'
              ELSE 'MULTIPLE_ACTIVE_CANDIDATES' END AS resolution_status,
         CASE WHEN count(*) FILTER (market_evidence_days > 0) = 1 THEN min(ticker) FILTER (market_evidence_days > 0) END
           AS current_ticker_candidate
  FROM history GROUP BY cnpj HAVING count(DISTINCT ticker) > 1""")
query("coverage", on(lambda i: ID.coverage(i.history)), "tickers seen_at_least_once seen_every_session coverage_rate",
      "history", f"""
  SELECT count(*) AS tickers, count(*) FILTER (market_evidence_days > 0) AS seen_at_least_once,
         count(*) FILTER (market_evidence_days = {WINDOW}) AS seen_every_session,
         count(*) FILTER (market_evidence_days > 0) / count(*) AS coverage_rate
  FROM (SELECT DISTINCT ticker, market_evidence_days FROM history)""")
_PROFILE = "core_name cvm_rows cvm_cnpjs cvm_codes b3_rows b3_instrument_ids b3_tickers b3_isins b3_assets b3_corporate_names"
_PROFILE_SQL = """
  SELECT c.*, b.* EXCLUDE (core_name), CASE WHEN b.b3_rows IS NULL THEN 'NO_B3_MATCH' WHEN cvm_cnpjs = 1 THEN 'UNIQUE_MATCH'
                                            ELSE 'AMBIGUOUS_MATCH' END AS match_status
  FROM (SELECT core_name, count(*) AS cvm_rows, count(DISTINCT CNPJ_Classe) AS cvm_cnpjs,
               count(DISTINCT Codigo_CVM) AS cvm_codes FROM funds GROUP BY 1) c
  LEFT JOIN (SELECT core_name, count(*) AS b3_rows, count(DISTINCT instrument_id) AS b3_instrument_ids,
                    count(DISTINCT ticker) AS b3_tickers, count(DISTINCT isin) AS b3_isins, count(DISTINCT asset) AS b3_assets,
                    count(DISTINCT corporate_name) AS b3_corporate_names FROM instruments GROUP BY 1) b USING (core_name)"""


def _profiled(i):
    return ID.name_profile(ID.prepare_funds(i.register), ID.prepare_instruments(i.instruments))


query("name_profile", on(_profiled), _PROFILE, "instruments", _PROFILE_SQL)
query("match_status", on(_profiled), "core_name match_status", "instruments", _PROFILE_SQL)
query("pattern_profile", on(lambda i: ID.pattern_profile(i.marked, i.master)),
      "resolution_status attribute attribute_value candidate_rows", "master", " UNION ALL ".join(
          f"SELECT resolution_status, '{a}' AS attribute, {e} AS attribute_value, count(*) AS candidate_rows "
          "FROM marked m JOIN master r ON r.cnpj_classe = m.CNPJ_Classe GROUP BY 1, 2, 3"
          for a, e in [(c, f"m.{c}") for c in ID.PROFILE_ATTRIBUTES] + [("ticker_suffix", "regexp_extract(m.ticker, '(\\d+)$', 1)")]))

# --- master quality ------------------------------------------------------------------
_METRIC = {
    "missing_cnpj": "count(*) FILTER (cnpj_classe IS NULL)",
    "duplicate_cnpj": "count(*) - count(DISTINCT cnpj_classe)",
    "duplicate_primary_instrument_id": "count(primary_instrument_id) - count(DISTINCT primary_instrument_id)",
    "resolved_without_primary_id": "count(*) FILTER (ok AND primary_instrument_id IS NULL)",
    "resolved_without_ticker": "count(*) FILTER (ok AND ticker IS NULL)",
    "resolved_without_isin": "count(*) FILTER (ok AND isin IS NULL)",
    "unresolved_with_primary_id": "count(*) FILTER (NOT ok AND primary_instrument_id IS NOT NULL)",
    "unresolved_with_ticker": "count(*) FILTER (NOT ok AND ticker IS NOT NULL)",
    "unresolved_with_isin": "count(*) FILTER (NOT ok AND isin IS NOT NULL)",
}
_QUALITY = " UNION ALL ".join(
    ["SELECT 'dataset_not_empty' AS check_name, count(*) AS measured, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM m",
     "SELECT 'required_columns', CAST(0 AS BIGINT), 'PASS'"]
    + [f"SELECT '{n}', CAST({e} AS BIGINT), CASE WHEN {e} = 0 THEN 'PASS' ELSE 'FAIL' END FROM m" for n, e in _METRIC.items()]
    + ["SELECT 'resolution_rate', count(*) FILTER (ok), CASE WHEN avg(ok::INT) >= 0.9 THEN 'PASS' ELSE 'WARN' END FROM m"])
_QUALITY = f"WITH m AS (SELECT *, resolution_status = 'AUTO_RESOLVED' AS ok FROM master) {_QUALITY}"
query("master_quality", on(lambda i: HE.master_quality(i.master, tuple(ID.MASTER_COLUMNS))), "check_name measured status",
      "master", _QUALITY)
query("health_summary", on(lambda i: HE.worst_status(HE.master_quality(i.master))),
      "overall_status checks passed warned failed", "master", f"""
  SELECT CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'PASS' END AS overall_status,
         count(*) AS checks, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'WARN') AS warned,
         count(*) FILTER (status = 'FAIL') AS failed FROM ({_QUALITY})""")

# --- daily prices and snapshot ----------------------------------------------------------
_MASTER = """SELECT CASE WHEN c_acctbal > 0 THEN 'FD' ELSE 'FX' END || c_custkey AS ticker, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS cnpj, CAST(c_custkey AS VARCHAR) AS codigo_cvm,
                    c_name AS denominacao_social, c_mktsegment AS situacao_cvm FROM customer"""
_DAILY = f"""SELECT p.* EXCLUDE (cnpj, codigo_cvm, ticker_resolution_status, market_evidence_confidence), m.cnpj, m.codigo_cvm,
                    'RESOLVED_BY_B3' AS ticker_resolution_status, 'HIGH' AS market_evidence_confidence, 'b3' AS source,
                    'events.parquet' AS source_file_name FROM panel p JOIN ({_MASTER}) m USING (ticker)"""


def snap(key, build, columns, sql):
    cols = columns.split() if isinstance(columns, str) else list(columns)
    register(key, lambda s, d: build(TB.daily_panel(s, d), TB.price_master(s, d)), cols,
             price_sql("daily", f"SELECT {select_list(cols)} FROM ({sql})", "panel"))


def _daily(panel, master):
    return SN.daily_prices(panel, master, "events.parquet")


_PRICE = [f.name for f in C.PANEL_SCHEMA] + ["source", "source_file_name"]
snap("daily_prices", _daily, _PRICE, _DAILY)
# a price floor and a narrower range plant violations for the checks to count
_DENT = ("SELECT * REPLACE (CASE WHEN low_price < 1 THEN 0.0::DOUBLE ELSE low_price END AS low_price, "
         "CASE WHEN high_price > 100 THEN 100.0::DOUBLE ELSE high_price END AS high_price) FROM (" + _DAILY + ")")


def _dented(p, m):
    return _daily(p, m).withColumns({
        "low_price": F.when(F.col("low_price") < 1, 0.0).otherwise(F.col("low_price")),
        "high_price": F.when(F.col("high_price") > 100, 100.0).otherwise(F.col("high_price"))})


snap("price_checks", lambda p, m: SN.price_checks(_dented(p, m)), CHECK, checks_sql(f"({_DENT})", {
    **{f"{n.upper()}_PRESENT": f"{n} IS NULL" for n in ("trade_date", "ticker", "cnpj", "close_price")},
    **{f"{n.upper()}_POSITIVE": f"{n} <= 0" for n in C.PRICES},
    "CLOSE_INSIDE_RANGE": "close_price < low_price OR close_price > high_price",
    "TRADES_NOT_NEGATIVE": "trades_quantity < 0"}, "ticker, trade_date"))
_SNAP = f"""
  SELECT p.trade_date, p.ticker, p.cnpj, p.codigo_cvm, m.denominacao_social, m.situacao_cvm, p.instrument_id, open_price, low_price,
         high_price, average_price, close_price, trades_quantity, close_price - open_price AS intraday_variation,
         (close_price / nullif(open_price, 0) - 1) * 100 AS intraday_variation_pct, high_price - low_price AS price_range,
         (high_price - low_price) / nullif(low_price, 0) * 100 AS price_range_pct,
         CASE WHEN m.cnpj IS NOT NULL THEN 'RESOLVED_BY_B3' END AS ticker_resolution_status,
         CASE WHEN m.cnpj IS NOT NULL THEN 'HIGH' END AS market_evidence_confidence
  FROM panel p LEFT JOIN ({_MASTER}) m ON m.cnpj = p.cnpj AND m.codigo_cvm = p.codigo_cvm"""
snap("daily_snapshot", SN.daily_snapshot, SN.SNAPSHOT_COLUMNS, _SNAP)
snap("snapshot_checks", lambda p, m: SN.snapshot_checks(SN.daily_snapshot(p, m)), CHECK, checks_sql(f"({_SNAP})", {
    f"{n.upper()}_PRESENT": f"{n} IS NULL" for n in (
        "trade_date", "ticker", "cnpj", "codigo_cvm", "denominacao_social", "close_price", "intraday_variation",
        "intraday_variation_pct", "price_range", "price_range_pct")}, "ticker, trade_date"))
