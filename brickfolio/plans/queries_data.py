"""Queries of ingestion, publication, serving, completeness and the saved SQL."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F, types as T

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.operators import (
    calendar as K, checks as CH, features as FE, health as HE, identity as ID, publish as P, serving as SV, snapshot as SN,
    walkforward as WF,
)
from brickfolio.plans import raw as RAW, saved_sql as SQL, tables as TB
from brickfolio.plans.catalog import register
from brickfolio.plans.oracle_price import price_sql
from brickfolio.plans.pipeline import Pipeline
from brickfolio.plans.queries_identity import WINDOW, _MASTER, _SNAP, Identity, core_sql, identity_sql  # noqa: F401
from brickfolio.plans.queries_price import CHECK, PANEL_COLUMNS, _dummy_metrics, checks_sql, final
from brickfolio.plans.shape import select_list
from brickfolio.session import scratch_path
from brickfolio.sources import archives as AR, pages as PG, partitions as PT, reports as R
from brickfolio.streaming.raw_to_silver import raw_to_silver, stream_raw_to_silver


def panel_query(key, build, columns, sql="SELECT * FROM panel"):
    cols = columns.split() if isinstance(columns, str) else list(columns)
    register(key, build, cols, price_sql("daily", f"SELECT {select_list(cols)} FROM ({sql})", "panel"))


# --- reports and archives --------------------------------------------------------
_TRADE = "trade_date ticker instrument_id instrument_id_type market open_price low_price high_price average_price close_price trades_quantity"
_TRADE_SQL = "SELECT *, '8' AS instrument_id_type, 'BVMF' AS market FROM panel"


def _trades(s, d):
    return R.parse_trades(RAW.trade_records(TB.daily_panel(s, d)).select("record"))


panel_query("xml_trades_scan", lambda s, d: R.typed_trades(_trades(s, d)), _TRADE, _TRADE_SQL)
panel_query("zip_xml_ingest", lambda s, d: R.typed_trades(R.parse_trades(
    AR.xml_records(RAW.trade_archives(TB.daily_panel(s, d)), "PriceReport"))), _TRADE, _TRADE_SQL)


# a field of each kind is spoiled so that the typing rules show: bad date, bad number, missing count
def _spoiled_trades(s, d):
    n = F.col("trades_quantity").cast("bigint")
    return R.typed_trades(_trades(s, d).withColumns({
        "trade_date": F.when(n == 5, F.concat("trade_date", F.lit("x"))).otherwise(F.col("trade_date")),
        "close_price": F.when(n == 4, F.lit("n/a")).when(n == 3, F.lit("NaN")).otherwise(F.col("close_price")),
        "trades_quantity": F.when(n == 2, F.lit("2.5x")).otherwise(F.col("trades_quantity"))}))


panel_query("typed_trades", _spoiled_trades, "trade_date ticker close_price trades_quantity", """
  SELECT ticker, CASE WHEN trades_quantity <> 5 THEN trade_date END AS trade_date,
         CASE WHEN trades_quantity NOT IN (3, 4) THEN close_price END AS close_price,
         CASE WHEN trades_quantity <> 2 THEN trades_quantity END AS trades_quantity FROM panel""")
_INSTRUMENT = ("report_date update_type instrument_id instrument_id_type listing_market asset b3_market b3_segment "
               "instrument_type security_category ticker isin corporate_name underlying_instrument_id "
               "underlying_instrument_id_type underlying_market")
_INSTRUMENT_SQL = """
  SELECT *, 'NEWI' AS update_type, CASE WHEN underlying_instrument_id IS NOT NULL THEN '8' END AS underlying_instrument_id_type,
         CASE WHEN underlying_instrument_id IS NOT NULL THEN 'BVMF' END AS underlying_market
  FROM instruments0 WHERE NOT (ticker LIKE '%13' AND underlying_instrument_id IS NULL)"""


def _instrument_rows(s, d):
    return R.parse_instruments(RAW.instrument_records(TB.instruments(s, d)))


register("xml_instruments_scan", lambda s, d: _instrument_rows(s, d).withColumn("report_date", X.to_day("report_date"))
         .withColumn("corporate_name", F.trim("corporate_name")), _INSTRUMENT,
         identity_sql(f"SELECT {select_list(_INSTRUMENT.split())} FROM ({_INSTRUMENT_SQL})", "instruments0"))
register("typed_instruments", lambda s, d: R.typed_instruments(_instrument_rows(s, d)), _INSTRUMENT + " round_lot trading_start_date",
         identity_sql(f"SELECT {_INSTRUMENT.replace(' ', ', ')}, CAST(NULL AS DOUBLE) AS round_lot, CAST(NULL AS DATE) AS "
                      f"trading_start_date FROM ({_INSTRUMENT_SQL})", "instruments0"))
register("latest_snapshot_dedup", lambda s, d: AR.latest_snapshot(TB.read(s, d, "lineitem").select(
    F.to_date("l_shipdate").alias("report_date"), F.concat(F.lit("IN_"), F.col("l_linenumber").cast("string"), F.lit(".xml"))
    .alias("source_xml"), F.col("l_suppkey").alias("instrument"), "l_returnflag")),
         "report_date source_xml instrument l_returnflag", """
  SELECT DISTINCT report_date, source_xml, instrument, l_returnflag FROM (
    SELECT *, max(source_xml) OVER (PARTITION BY report_date) AS last_xml FROM (
      SELECT CAST(l_shipdate AS DATE) AS report_date, 'IN_' || l_linenumber || '.xml' AS source_xml, l_suppkey AS instrument,
             l_returnflag FROM lineitem)) WHERE source_xml = last_xml""")
_REG = ("path CNPJ_Classe Codigo_CVM Tipo_Classe Denominacao_Social Situacao Data_Registro Patrimonio_Liquido")
register("csv_register_scan", lambda s, d: AR.register_rows(
    AR.members(RAW.register_archives(s, d)).select("path", "content"), list(RAW.REGISTER_TEXT))
    .withColumn("Patrimonio_Liquido", X.to_double("Patrimonio_Liquido")).withColumnRenamed("Patrimonio_Liquido", "net_value"),
    _REG.replace("Patrimonio_Liquido", "net_value"), identity_sql(
        f"SELECT 'register_' || (p // {RAW.PER_FILE}) AS path, CNPJ_Classe, Codigo_CVM, Tipo_Classe, Denominacao_Social, Situacao, "
        f"CAST(Data_Registro AS VARCHAR) AS Data_Registro, {select_list(['net_value'])} "
        "FROM (SELECT *, CAST(Codigo_CVM AS BIGINT) AS p, Patrimonio_Liquido AS net_value FROM register)", "register"))


def _encoded(s, d):
    latin = F.col("text").rlike("^[\\x00-\\x7F\\xA0-\\xFF]*$")
    body = F.when(latin & (F.col("lang") != "en"), F.encode("text", "ISO-8859-1")).otherwise(
        F.encode(F.concat(F.lit("﻿"), "text"), "UTF-8"))
    return TB.read(s, d, "documents").select("doc_id", body.alias("body")).select("doc_id", AR.decoded("body").alias("text"))


register("decode_fallback", _encoded, "doc_id text", "SELECT doc_id, text FROM documents")
register("archive_fingerprint", lambda s, d: AR.archive_fingerprint(RAW.register_archives(s, d, western=False)),
         "path members content_sha256 last_member_sha256", identity_sql(f"""
  SELECT path, CAST(1 AS BIGINT) AS members, sha256('registro_classe.csv:' || digest) AS content_sha256, digest AS last_member_sha256
  FROM (SELECT 'register_' || part AS path,
               sha256('{";".join(RAW.REGISTER_TEXT)}' || chr(10) || string_agg(line, chr(10) ORDER BY line)) AS digest
        FROM (SELECT CAST(Codigo_CVM AS BIGINT) // {RAW.PER_FILE} AS part,
                     concat_ws(';', CNPJ_Classe, Codigo_CVM, Tipo_Classe, Denominacao_Social, Situacao,
                               CAST(Data_Registro AS VARCHAR), CAST(Patrimonio_Liquido AS VARCHAR)) AS line FROM register)
        GROUP BY part)""", "register"))
_PAGE_SQL = r"""
  SELECT page_id, CASE WHEN has THEN 'FUND' || page_id || '11' END AS ticker,
         CASE WHEN has AND page_id % 9 <> 4 THEN lpad(CAST(page_id AS VARCHAR), 14, '0') END AS cnpj,
         CASE WHEN has THEN 'F ' || page_id || ' S/A' END AS fund_name, CASE WHEN has THEN 'ATIVO' END AS category_status,
         CASE WHEN NOT has THEN 'META_NOT_FOUND' WHEN page_id % 9 = 4 THEN 'CNPJ_NOT_FOUND' END AS reject_reason
  FROM (SELECT page_id, page_id % 13 <> 5 AS has FROM pages)"""
register("html_field_extract", lambda s, d: PG.page_fields(RAW.fund_pages(s, d)),
         "page_id ticker cnpj fund_name category_status reject_reason", _PAGE_SQL)
register("html_rejects", lambda s, d: PG.good_and_rejected(RAW.fund_pages(s, d))[1], "page_id reject_reason",
         f"SELECT page_id, reject_reason FROM ({_PAGE_SQL}) WHERE reject_reason IS NOT NULL")
register("html_link_extract", lambda s, d: PG.page_links(
    TB.read(s, d, "pages").select(F.replace("html", F.lit('href="/'), F.lit('href="/funds/')).alias("html")), pattern="^[A-Z0-9]+$"),
    "ticker", r"""
  SELECT DISTINCT upper(regexp_extract(href, '/funds/([a-zA-Z0-9]+)', 1)) AS ticker
  FROM (SELECT unnest(regexp_extract_all(replace(html, 'href="/', 'href="/funds/'),
                      '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']+)["'']', 1)) AS href FROM pages)
  WHERE regexp_extract(href, '/funds/([a-zA-Z0-9]+)', 1) <> ''""")

# --- partitions -------------------------------------------------------------------
_TYPES = {"trade_date": "date", **{c: "double" for c in C.PRICES}, "trades_quantity": "bigint"}
panel_query("schema_contract", lambda s, d: PT.schema_contract(TB.daily_panel(s, d), C.PANEL_SCHEMA),
            "column_name expected_type actual_type null_rows status", " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, '{_TYPES.get(c, 'string')}' AS expected_type, '{_TYPES.get(c, 'string')}' AS actual_type, "
                f"count(*) - count({c}) AS null_rows, 'PASS' AS status FROM panel" for c in PANEL_COLUMNS))
panel_query("latest_partition", lambda s, d: PT.latest_partition(TB.daily_panel(s, d), "trade_date"), PANEL_COLUMNS,
            "SELECT * FROM panel WHERE trade_date = (SELECT max(trade_date) FROM panel)")
panel_query("asof_partition", lambda s, d: PT.latest_partition(TB.daily_panel(s, d), "trade_date", date(2024, 1, 15)),
            PANEL_COLUMNS, "SELECT * FROM panel WHERE trade_date = (SELECT max(trade_date) FROM panel WHERE trade_date <= DATE '2024-01-15')")
panel_query("raw_to_silver", lambda s, d: raw_to_silver(TB.daily_panel(s, d), scratch_path(s, "silver")), PANEL_COLUMNS)


def _stream(s, d):
    # each day is spread over many files, which arrive in two runs
    events = TB.read(s, d, "events")
    source, target, mark = (scratch_path(s, n) for n in ("stream-source", "stream", "stream-checkpoint"))
    late = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    for part in (~late, late):
        events.where(part).repartition(120).write.mode("append").parquet(source)
        out = stream_raw_to_silver(s, source, events.schema, TB.panel_from_events, target, mark, day="ts")
    return out


panel_query("stream_raw_to_silver", _stream, PANEL_COLUMNS)


def _published(s, d):
    rows = P.with_date_parts(TB.daily_panel(s, d), "trade_date").drop("day")
    return P.publish_partitioned(rows, scratch_path(s, "published"), ["year", "month"], ["trade_date", "ticker"])


panel_query("publish_partitioned", _published, PANEL_COLUMNS + ["year", "month"],
            "SELECT *, CAST(year(trade_date) AS INT) AS year, CAST(month(trade_date) AS INT) AS month FROM panel")
panel_query("publish_single", lambda s, d: P.publish_single(
    TB.daily_panel(s, d), scratch_path(s, "single"), ["trade_date", "ticker"]), PANEL_COLUMNS)

# --- fingerprints -------------------------------------------------------------------
_ORDER_COLUMNS = ["o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]


def _orders(s, d):
    return TB.read(s, d, "orders").select(*_ORDER_COLUMNS, F.year("o_orderdate").alias("year"))


def _print_sql(where=""):
    types = {"o_custkey": "bigint", "o_orderkey": "bigint", "o_orderpriority": "string", "o_orderstatus": "string", "o_totalprice": "double", "year": "int"}
    text = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-;')" for c in sorted(types))
    schema = ",".join(f"{c} {types[c]}" for c in sorted(types))
    return f"""
      SELECT year, rows, sha256(concat_ws('#', '{schema}', rows, x1, x2, s1, s2)) AS content_sha256
      FROM (SELECT year, count(*) AS rows, bit_xor(h1) AS x1, bit_xor(h2) AS x2, sum(h1) AS s1, sum(h2) AS s2
            FROM (SELECT year, CAST('0x' || substr(m, 1, 15) AS BIGINT) AS h1, CAST('0x' || substr(m, 16, 15) AS BIGINT) AS h2
                  FROM (SELECT year, md5({text}) AS m
                        FROM (SELECT *, CAST(year(o_orderdate) AS INT) AS year FROM orders {where}))) GROUP BY year)"""


register("content_fingerprint", lambda s, d: P.content_fingerprint(_orders(s, d), ["year"]), "year rows content_sha256", _print_sql())


def _decision(s, d):
    old = _orders(s, d).filter("year < 1999").withColumn(
        "o_orderstatus", F.when(F.col("year") == 1996, "X").otherwise(F.col("o_orderstatus")))
    return P.publish_decision(P.content_fingerprint(_orders(s, d), ["year"]), P.content_fingerprint(old, ["year"]), ["year"])


register("publish_decision", _decision, "year rows content_sha256 action", f"""
  SELECT *, CASE WHEN year >= 1999 THEN 'UPLOAD' WHEN year = 1996 THEN 'BLOCK' ELSE 'SKIP_REPACKAGED' END AS action
  FROM ({_print_sql()})""")


def _manifests(s, d):
    rows = TB.read(s, d, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("o_custkey").alias("ticker_count"),
        F.to_date(F.max("o_orderdate")).alias("trade_date"))
    return P.manifest_fingerprint(rows.withColumns({"status": F.lit("READY"), "generated_at": F.current_timestamp()}))


register("manifest_fingerprint", _manifests, "year row_count ticker_count trade_date status manifest_sha256", """
  SELECT *, sha256('{"row_count":' || row_count || ',"status":"READY","ticker_count":' || ticker_count || ',"trade_date":"'
                   || trade_date || '","year":' || year || '}') AS manifest_sha256
  FROM (SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS row_count, count(DISTINCT o_custkey) AS ticker_count,
               CAST(max(o_orderdate) AS DATE) AS trade_date, 'READY' AS status FROM orders GROUP BY 1)""")


# --- serving ---------------------------------------------------------------------------
class Serving:
    """Daily snapshot and inference rows of the last session."""

    def __init__(self, spark, sf_dir):
        self.pipeline = Pipeline.daily(spark, sf_dir)
        master = TB.price_master(spark, sf_dir)
        self.snapshot = SN.daily_snapshot(self.pipeline.panel, master)
        self.daily = PT.latest_partition(self.snapshot, "trade_date").filter("denominacao_social is not null")
        self.inference = SV.inference_dataset(self.pipeline.features)
        self.records = SV.context_records(self.daily, self.inference)


_FN = C.feature_names()
_INF = ["feature_date", "ticker", "feature_version", "source_price_history_version", *_FN]
_INF_SQL = "SELECT * FROM features WHERE feature_ready AND feature_date = (SELECT max(feature_date) FROM features)"
_DAY_SQL = f"SELECT * FROM ({_SNAP}) WHERE denominacao_social IS NOT NULL AND trade_date = (SELECT max(trade_date) FROM panel)"


def serve(key, build, columns, sql):
    cols = columns.split() if isinstance(columns, str) else list(columns)
    register(key, lambda s, d: build(Serving(s, d)), cols,
             price_sql("daily", f"SELECT {select_list(cols)} FROM ({sql})", "features"))


serve("inference_dataset", lambda v: v.inference, _INF, _INF_SQL)
serve("serving_checks", lambda v: SV.serving_checks(v.inference, v.daily), CHECK, checks_sql(f"({_INF_SQL})", {
    "TICKER_PRESENT": "ticker IS NULL", "DATE_PRESENT": "feature_date IS NULL",
    "DATE_IS_SERVING_DATE": "feature_date <> (SELECT max(trade_date) FROM panel)"}, "ticker, feature_date"))
serve("snapshot_manifest", lambda v: SV.manifest(v.daily, "fii_daily_snapshot", "trade_date"),
      "dataset status row_count ticker_count business_date single_date", f"""
  SELECT 'fii_daily_snapshot' AS dataset, 'READY' AS status, count(*) AS row_count, count(DISTINCT ticker) AS ticker_count,
         max(trade_date) AS business_date, min(trade_date) = max(trade_date) AS single_date FROM ({_DAY_SQL})""")
serve("source_alignment", lambda v: SV.source_alignment(v.daily, v.inference),
      "shared_tickers only_daily only_ml repeated_tickers aligned", f"""
  SELECT *, only_daily = 0 AND only_ml = 0 AND repeated_tickers = 0 AS aligned
  FROM (SELECT count(*) FILTER (a.ticker IS NOT NULL AND b.ticker IS NOT NULL) AS shared_tickers,
               count(*) FILTER (b.ticker IS NULL) AS only_daily, count(*) FILTER (a.ticker IS NULL) AS only_ml,
               CAST(0 AS BIGINT) AS repeated_tickers
        FROM ({_DAY_SQL}) a FULL OUTER JOIN ({_INF_SQL}) b ON a.ticker = b.ticker)""")
_FLAT = (["context_version", "ticker"] + [f"i_{c}" for c in SV.IDENTITY] + ["trade_date", "close_price", "price_range",
         "feature_date", "feature_version"] + _FN)


def _flat(records):
    r = F.col
    return records.select(
        "context_version", "ticker", *[r(f"identity.{c}").alias(f"i_{c}") for c in SV.IDENTITY],
        *[r(f"market_state.{c}").alias(c) for c in ("trade_date", "close_price", "price_range")],
        r("ml_state.feature_date").alias("feature_date"), r("ml_state.feature_version").alias("feature_version"),
        *[F.try_element_at("ml_state.features", F.lit(n)).alias(n) for n in _FN])


_FLAT_SQL = f"""
  SELECT 'v1' AS context_version, d.ticker, d.cnpj AS i_cnpj, d.codigo_cvm AS i_codigo_cvm,
         d.denominacao_social AS i_denominacao_social, d.situacao_cvm AS i_situacao_cvm, d.trade_date, d.close_price,
         d.price_range, m.feature_date, m.feature_version, {", ".join("m." + n for n in _FN)}
  FROM ({_DAY_SQL}) d JOIN ({_INF_SQL}) m USING (ticker)"""
serve("context_records", lambda v: _flat(v.records), _FLAT, _FLAT_SQL)
serve("context_jsonl", lambda v: _flat(SV.write_context(v.records, scratch_path(v.daily.sparkSession, "context"))), _FLAT, _FLAT_SQL)
serve("context_checks", lambda v: SV.context_checks(v.records), CHECK, checks_sql(f"({_FLAT_SQL})", {
    f"{s.upper()}_PRESENT": "ticker IS NULL" for s in ("identity", "market_state", "ml_state", "provenance")}, "ticker"))
serve("retrieve_by_key", lambda v: _flat(SV.retrieve(v.records, " fd1 ")), _FLAT, f"SELECT * FROM ({_FLAT_SQL}) WHERE ticker = 'FD1'")
serve("product_status", lambda v: SV.product_status(
    SV.manifest(v.daily, "daily", "trade_date").unionByName(SV.manifest(v.inference, "ml", "feature_date"))),
      "layers first_date last_date min_tickers max_tickers dates_aligned counts_aligned all_ready status", f"""
  SELECT *, CASE WHEN dates_aligned AND counts_aligned THEN 'READY' ELSE 'NOT_ALIGNED' END AS status
  FROM (SELECT count(*) AS layers, min(d) AS first_date, max(d) AS last_date, min(n) AS min_tickers, max(n) AS max_tickers,
               min(d) = max(d) AS dates_aligned, min(n) = max(n) AS counts_aligned, true AS all_ready
        FROM (SELECT max(trade_date) AS d, count(DISTINCT ticker) AS n FROM ({_DAY_SQL})
              UNION ALL SELECT max(feature_date), count(DISTINCT ticker) FROM ({_INF_SQL})))""")

# --- health ----------------------------------------------------------------------------
_REF, _MAX = date(2024, 2, 2), 3
_KEY = ("ticker", "trade_date")


def _health(s, d):
    p = Pipeline.daily(s, d)
    orders = TB.read(s, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return HE.dataset_health([
        (p.panel, HE.DatasetSpec("panel", _KEY, "trade_date", ("close_price",))),
        (p.candidates, HE.DatasetSpec("candidates", ("ticker", "event_date"), "event_date", (), "EVENT_DRIVEN", True)),
        (p.quality, HE.DatasetSpec("quality", _KEY, "trade_date")),
        (orders, HE.DatasetSpec("orders", ("o_custkey", "day"), "day")),
    ], _REF, _MAX)


_HEALTH_COLUMNS = ("dataset rows duplicate_rows invalid_dates min_date max_date freshness_mode freshness_days freshness_status "
                   "content_status status")
_HEALTH_SQL = """
  SELECT *, CASE WHEN freshness_status = 'PASS' AND content_status = 'PASS' THEN 'PASS' ELSE 'FAIL' END AS status
  FROM (SELECT *, CASE WHEN freshness_mode = 'EVENT_DRIVEN' OR freshness_days BETWEEN 0 AND 3 THEN 'PASS' ELSE 'FAIL' END AS freshness_status,
               CASE WHEN duplicate_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS content_status
        FROM (SELECT dataset, mode AS freshness_mode, count(*) AS rows, CAST(count(*) - count(DISTINCT k) AS BIGINT) AS duplicate_rows,
                     CAST(0 AS BIGINT) AS invalid_dates, min(d) AS min_date, max(d) AS max_date,
                     CAST(DATE '2024-02-02' - max(d) AS INT) AS freshness_days
              FROM (SELECT 'panel' AS dataset, 'DATA_DATE' AS mode, (ticker, CAST(trade_date AS VARCHAR)) AS k, trade_date AS d FROM panel
                    UNION ALL SELECT 'candidates', 'EVENT_DRIVEN', (ticker, CAST(event_date AS VARCHAR)), event_date FROM candidates
                    UNION ALL SELECT 'quality', 'DATA_DATE', (ticker, CAST(trade_date AS VARCHAR)), trade_date FROM quality
                    UNION ALL SELECT 'orders', 'DATA_DATE', (CAST(o_custkey AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR)),
                                     CAST(o_orderdate AS DATE) FROM orders)
              GROUP BY 1, 2))"""


def health(key, build, columns):
    cols = columns.split()
    register(key, build, cols, price_sql("daily", f"SELECT {select_list(cols)} FROM ({_HEALTH_SQL})", "quality"))


health("dataset_health", _health, _HEALTH_COLUMNS)
health("freshness", _health, "dataset freshness_mode freshness_days max_date freshness_status")


def _reconcile(s, d):
    p = Pipeline.daily(s, d)
    priced = SN.daily_prices(p.panel, TB.price_master(s, d))
    return HE.reconcile_keys(p.panel, p.quality, list(_KEY), "panel_quality").unionByName(
        HE.reconcile_keys(p.panel, priced, list(_KEY), "panel_prices"))


_REC = """SELECT '{n}' AS relation, (SELECT count(*) FROM panel) AS left_rows, (SELECT count(*) FROM {t}) AS right_rows,
  (SELECT count(*) FROM (SELECT ticker, trade_date FROM panel EXCEPT SELECT ticker, trade_date FROM {t})) AS only_left,
  (SELECT count(*) FROM (SELECT ticker, trade_date FROM {t} EXCEPT SELECT ticker, trade_date FROM panel)) AS only_right"""
register("reconcile_datasets", _reconcile, "relation left_rows right_rows only_left only_right status", price_sql("daily", f"""
  SELECT *, CASE WHEN left_rows = right_rows AND only_left = 0 AND only_right = 0 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM ({_REC.format(n="panel_quality", t="quality")} UNION ALL
        {_REC.format(n="panel_prices", t=f"(SELECT p.* FROM panel p JOIN ({_MASTER}) m USING (ticker))")})""", "quality"))


def _reconcile_metrics(p):
    metrics = _dummy_metrics(p)
    again = metrics.groupBy("model").agg(*[
        (F.sum(m) / F.count(m)).alias(f"{m}_mean") for m in ("mae", "rmse", "r2")])
    return HE.reconcile_metrics(WF.model_summary(metrics), again, "model", ["mae_mean", "rmse_mean", "r2_mean"])


final("reconcile_metrics", "weekly", _reconcile_metrics, "model metric stored_value computed_value status", "metrics",
      " UNION ALL ".join(
          f"SELECT model, '{m}_mean' AS metric, avg({m}) AS stored_value, avg({m}) AS computed_value, 'PASS' AS status "
          "FROM metrics GROUP BY model" for m in ("mae", "rmse", "r2")))
final("fault_injection", "daily", lambda p: FE.feature_checks(HE.with_injected_duplicate(p.features, ("ticker", "feature_date"))),
      CHECK, "features", """
  SELECT * FROM (SELECT 'KEY_UNIQUE' AS check_name, CAST(1 AS BIGINT) AS violations, 'FAIL' AS status
    UNION ALL SELECT unnest(['FEATURE_DATE_PRESENT', 'TICKER_PRESENT', 'READY_HAS_FULL_WINDOW', 'READY_HAS_RETURN', """
      + ", ".join(f"'{n.upper()}_FINITE'" for n in _FN) + """]), 0, 'PASS') WHERE (SELECT count(*) FROM features) > 0""")
_LINEAGE = {"price_history_version": C.PRICE_HISTORY_VERSION, "price_history_source": C.ADJUSTED_SOURCE,
            "return_semantics": C.RETURN_SEMANTICS, "price_semantics": "RAW_PRICE",
            "adjusted_prices_version": C.ADJUSTED_PRICES_VERSION}
final("contract_checks", "daily", lambda p: CH.expect_single(p.history, _LINEAGE), CHECK, "history",
      checks_sql("history", {f"{c.upper()}_IS_{v}": f"{c} IS DISTINCT FROM '{v}'" for c, v in _LINEAGE.items()}))

# --- calendar and cycles -------------------------------------------------------------------
_PER_DAY = """
  SELECT CAST(o_orderdate AS DATE) AS day, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent,
         count(*) FILTER (o_orderstatus = 'P') AS pending, count(*) FILTER (o_orderstatus = 'F') AS filled FROM orders GROUP BY 1"""
_CAL = f"""per_day AS ({_PER_DAY}),
  days AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM per_day),
  cal AS (SELECT day, status, status = 'TRADING_DAY' AS is_trading_day, status = 'TRADING_DAY' AND listed AS special,
                 max(CASE WHEN status = 'TRADING_DAY' THEN day END) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                   AS previous_trading_day
          FROM (SELECT d.day, coalesce(p.pending = 0, false) AS listed,
                       CASE WHEN isodow(d.day) >= 6 THEN 'WEEKEND' WHEN p.urgent = 0 THEN 'B3_HOLIDAY' ELSE 'TRADING_DAY' END AS status
                FROM days d LEFT JOIN per_day p USING (day))),
  expected AS (SELECT d.day AS run_date FROM days d WHERE isodow(d.day) BETWEEN 2 AND 6
               AND d.day NOT IN (SELECT day FROM per_day WHERE urgent = 0)),
  observed AS (SELECT day AS run_date FROM per_day WHERE filled > 0)"""


class Calendar:
    """Days, holidays, special sessions and observed runs of the order dates."""

    def __init__(self, spark, sf_dir):
        self.orders = TB.read(spark, sf_dir, "orders")
        day = F.to_date("o_orderdate")
        per_day = self.orders.groupBy(day.alias("day")).agg(
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
            F.count_if(F.col("o_orderstatus") == "P").alias("pending"),
            F.count_if(F.col("o_orderstatus") == "F").alias("filled"))
        self.days = K.days_of(self.orders, "o_orderdate")
        self.holidays = per_day.filter("urgent = 0").select("day")
        self.special = per_day.filter("pending = 0").select("day")
        self.observed = per_day.filter("filled > 0").select(F.col("day").alias("run_date"))
        self.calendar = K.trading_calendar(self.days, self.holidays, self.special)
        self.expected = K.expected_cycles(self.days, [1, 2, 3, 4, 5], self.holidays)


def cycle(key, build, columns, sql):
    register(key, lambda s, d: build(Calendar(s, d)), columns, f"WITH {_CAL} SELECT {columns.replace(' ', ', ')} FROM ({sql})")


cycle("trading_calendar", lambda c: c.calendar, "day status is_trading_day special previous_trading_day", "SELECT * FROM cal")
cycle("expected_cycles", lambda c: c.expected, "run_date", "SELECT * FROM expected")
cycle("missing_cycles", lambda c: K.missing_cycles(c.expected, c.observed), "run_date", "SELECT * FROM expected EXCEPT SELECT * FROM observed")
cycle("cycle_assessment", lambda c: K.assess_cycles(c.expected, c.observed),
      "expected_count observed_expected_count missing_count unexpected_count first_missing status", """
  SELECT *, CASE WHEN missing_count = 0 THEN 'COMPLETE' ELSE 'GAPS_DETECTED' END AS status
  FROM (SELECT count(*) FILTER (e.run_date IS NOT NULL) AS expected_count,
               count(*) FILTER (e.run_date IS NOT NULL AND o.run_date IS NOT NULL) AS observed_expected_count,
               count(*) FILTER (o.run_date IS NULL) AS missing_count, count(*) FILTER (e.run_date IS NULL) AS unexpected_count,
               min(e.run_date) FILTER (o.run_date IS NULL) AS first_missing
        FROM expected e FULL OUTER JOIN observed o ON e.run_date = o.run_date)""")


def _inventory(c):
    """One object per order date, status and urgency: 'F' is sound, 'P' has a wrong file date; others lie outside the calendar's years."""
    day = F.to_date("o_orderdate")
    stray = (F.col("o_orderpriority") == "5-LOW") | (F.col("o_orderstatus") == "O")
    objects = c.orders.select(F.when(stray, F.add_months(day, 1200)).otherwise(day).alias("day"), "o_orderstatus").distinct()
    file_day = F.when(F.col("o_orderstatus") == "P", F.date_add("day", 1)).otherwise(F.col("day"))
    key = F.concat(F.lit("raw/b3/year="), F.date_format("day", "yyyy"), F.lit("/month="), F.date_format("day", "MM"), F.lit("/day="),
                   F.date_format("day", "dd"), F.lit("/b3_download_"), F.date_format(file_day, "yyyyMMdd"), F.lit(".zip"))
    return objects.select(key.alias("key"))


cycle("history_audit", lambda c: K.history_audit(c.calendar, _inventory(c)), "day audit_status objects duplicate_day", """
  SELECT day, CASE WHEN coalesce(i.good, 0) = 0 AND coalesce(i.bad, 0) > 0 THEN 'INVALID'
                     WHEN c.is_trading_day AND coalesce(i.good, 0) > 0 THEN 'EXPECTED_AND_PRESENT'
                     WHEN c.is_trading_day THEN 'EXPECTED_BUT_MISSING'
                     WHEN coalesce(i.good, 0) > 0 THEN 'UNEXPECTED_PRESENT' ELSE 'NON_TRADING_DAY' END AS audit_status,
         coalesce(i.good, 0) AS objects, coalesce(i.good, 0) > 1 AS duplicate_day
  FROM cal c FULL JOIN (SELECT day, count(*) FILTER (o_orderstatus <> 'P') AS good, count(*) FILTER (o_orderstatus = 'P') AS bad
                        FROM (SELECT DISTINCT CAST(o_orderdate + CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'O' THEN INTERVAL 100 YEAR
                                                                      ELSE INTERVAL 0 YEAR END AS DATE) AS day, o_orderstatus FROM orders) GROUP BY 1) i USING (day)""")

_NOW = datetime(2001, 7, 30, 12, 0)
_SOURCES = ["b3", "instruments", "cvm"]


def _states(c):
    day = F.to_date("o_orderdate").alias("run_date")
    status = F.element_at(F.array(*[F.lit(v) for v in ("STARTED", "FAILED", "SUCCEEDED", "STARTED", "PAUSED")]),
                          F.substring("p", 1, 1).cast("int"))
    runs = c.orders.groupBy(day).agg(
        F.min("o_orderpriority").alias("p"), F.max("o_totalprice").alias("top"), F.count(F.lit(1)).alias("n")).select(
        "run_date", (F.col("top") > 480000).alias("output_exists"), F.when(F.col("n") > 3, status).alias("status"),
        F.col("run_date").cast("timestamp").alias("started_at"))
    source = F.element_at(F.array(*[F.lit(v) for v in [*_SOURCES, "other", "other"]]), F.substring("o_orderpriority", 1, 1).cast("int"))
    inventory = c.orders.select(
        day, F.when(F.col("o_orderstatus") == "F", "silver").otherwise("raw").alias("layer"), source.alias("source"))
    return HE.cycle_state(runs, inventory, _SOURCES, _NOW, 240)


_STATE_SQL = f"""
  SELECT run_date, e AS execution_state,
         CASE WHEN e = 'COMPLETE' THEN 'COMPLETE' WHEN e = 'IN_PROGRESS' THEN 'IN_PROGRESS'
              WHEN e IN ('INCONSISTENT_STATE', 'UNKNOWN_STATE') OR greatest(s1, s2, s3) > 1 THEN 'RECOVERY_BLOCKED'
              WHEN s1 = 1 AND s2 = 1 AND s3 = 1 THEN 'GOLD_RETRY_REQUIRED'
              WHEN (s1 = 1 OR r1 = 1) AND (s2 = 1 OR r2 = 1) AND (s3 = 1 OR r3 = 1) THEN 'RAW_REBUILD_REQUIRED'
              ELSE 'RECOVERY_BLOCKED' END AS cycle_state
  FROM (SELECT *, CASE WHEN top > 480000 THEN 'COMPLETE' WHEN n <= 3 THEN 'NO_STATE' WHEN p = '2' THEN 'RETRY_ALLOWED'
                       WHEN p = '3' THEN 'INCONSISTENT_STATE' WHEN p = '5' THEN 'UNKNOWN_STATE'
                       WHEN run_date <= TIMESTAMP '2001-07-30 08:00:00' THEN 'RETRY_ALLOWED' ELSE 'IN_PROGRESS' END AS e
        FROM (SELECT CAST(o_orderdate AS DATE) AS run_date, min(substr(o_orderpriority, 1, 1)) AS p, max(o_totalprice) AS top, count(*) AS n,
                     {", ".join(f"count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority LIKE '{i}%') AS s{i}, count(*) FILTER (o_orderstatus <> 'F' AND o_orderpriority LIKE '{i}%') AS r{i}" for i in (1, 2, 3))}
              FROM orders GROUP BY 1))"""
cycle("cycle_state", _states, "run_date execution_state cycle_state", _STATE_SQL)
cycle("cycle_state_counts", lambda c: HE.state_counts(_states(c)), "cycle_state run_dates",
      f"SELECT cycle_state, count(*) AS run_dates FROM ({_STATE_SQL}) GROUP BY 1")


# --- saved SQL ------------------------------------------------------------------------------
def _published_table(s, d, stage, table, partition):
    """The stage's table, published under its partition column and read back; each call publishes the tables as they are now."""
    path = scratch_path(s, f"published-{stage}")
    rows, given = table()
    P.publish_partitioned(rows, path, [partition], ["ticker"], given)
    return s.read.parquet(path)


def _saved(name):
    stage, columns, _, day = SQL.SAVED[name]
    kind = "weekly" if stage in ("eligibility", "training", "split") else "daily"

    def build(s, d):
        def table():
            p = getattr(Pipeline, kind)(s, d)
            rows = SN.daily_snapshot(p.panel, TB.price_master(s, d)) if stage == "snapshot" else getattr(p, stage)
            return rows, p.given.get(stage)
        view = f"saved_{stage}"
        _published_table(s, d, stage, table, "split_name" if stage == "split" else day).createOrReplaceTempView(view)
        return s.sql(SQL.statement(name, view))

    if stage == "snapshot":
        body = SQL.statement(name, f"({_SNAP})")
        oracle = price_sql(kind, f"SELECT {select_list(columns.split())} FROM ({body})", "panel")
    else:
        oracle = price_sql(kind, f"SELECT {select_list(columns.split())} FROM ({SQL.statement(name, stage)})", stage)
    register(name, build, columns, oracle)


for _name in SQL.SAVED:
    _saved(_name)


def _saved_walk_forward(s, d):
    _dummy_metrics(Pipeline.weekly(s, d)).createOrReplaceTempView("saved_fold_metrics")
    return s.sql("SELECT fold_id, model, mae, rmse, r2, directional_accuracy FROM saved_fold_metrics ORDER BY fold_id, model")


register("sql_walk_forward", _saved_walk_forward, "fold_id model mae rmse r2 directional_accuracy", price_sql(
    "weekly", f"SELECT {select_list('fold_id model mae rmse r2 directional_accuracy'.split())} FROM metrics", "metrics"))
