"""Price and instrument reports: XML records to typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brickfolio.functions import columns as X

# fixed values: report fields and the columns they become
TRADE_FIELDS = {
    "trade_date": "Dt", "ticker": "TckrSymb", "instrument_id": "Id", "instrument_id_type": "Prtry", "market": "MktIdrCd",
    "open_price": "FrstPric", "low_price": "MinPric", "high_price": "MaxPric", "average_price": "TradAvrgPric",
    "close_price": "LastPric", "trades_quantity": "RglrTxsQty",
}
# block of the record -> its fields
INSTRUMENT_BLOCKS = {
    "RptParams": {"report_date": "Dt", "update_type": "UpdTp"},
    "FinInstrmId": {"instrument_id": "Id", "instrument_id_type": "Prtry", "listing_market": "MktIdrCd"},
    "FinInstrmAttrCmon": {"asset": "Asst", "asset_description": "AsstDesc", "b3_market": "Mkt", "b3_segment": "Sgmt",
                          "instrument_description": "Desc"},
}
INSTRUMENT_FIELDS = {
    "security_category": "SctyCtgy", "ticker": "TckrSymb", "isin": "ISIN", "distribution_id": "DstrbtnId",
    "cfi_code": "CFICd", "specification_code": "SpcfctnCd", "corporate_name": "CrpnNm", "payment_type": "PmtTp",
    "round_lot": "AllcnRndLot", "price_factor": "PricFctr", "trading_start_date": "TradgStartDt",
    "trading_end_date": "TradgEndDt", "corporate_action_start_date": "CorpActnStartDt",
    "ex_distribution_number": "EXDstrbtnNb", "custody_treatment_type": "CtdyTrtmntTp", "trading_currency": "TradgCcy",
    "market_capitalization": "MktCptlstn", "last_price": "LastPric", "first_price": "FrstPric",
    "settlement_days": "DaysToSttlm", "rights_issue_price": "RghtsIssePric",
}
UNDERLYING_FIELDS = {"underlying_instrument_id": "Id", "underlying_instrument_id_type": "Prtry", "underlying_market": "MktIdrCd"}
TRADE_DOUBLES = ("open_price", "low_price", "high_price", "average_price", "close_price")
INSTRUMENT_DATES = ("report_date", "trading_start_date", "trading_end_date", "corporate_action_start_date")
INSTRUMENT_DOUBLES = ("round_lot", "price_factor", "market_capitalization", "last_price", "first_price",
                      "settlement_days", "rights_issue_price")


_XML = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}
_IDENT = "struct<OthrId: struct<Id: string, Tp: struct<Prtry: string>>, PlcOfListg: struct<MktIdrCd: string>>"
_QUOTES = "struct<" + ", ".join(f"{t}: string" for t in ("FrstPric", "MinPric", "MaxPric", "TradAvrgPric", "LastPric", "RglrTxsQty")) + ">"
TRADE_XML = (f"TradDt struct<Dt: string>, SctyId struct<TckrSymb: string>, FinInstrmId {_IDENT}, FinInstrmAttrbts {_QUOTES}")
_BLOCK = "struct<" + ", ".join(f"{t}: string" for t in INSTRUMENT_FIELDS.values()) + f", UndrlygInstrmId: {_IDENT}>"
INSTRUMENT_XML = (
    f"RptParams struct<RptDtAndTm: struct<Dt: string>, UpdTp: string>, FinInstrmId {_IDENT}, "
    "FinInstrmAttrCmon struct<Asst: string, AsstDesc: string, Mkt: string, Sgmt: string, Desc: string>, "
    f"InstrmInf struct<InstrumentBlock: {_BLOCK}>")
_FIRST_CHILD = r"<(?:[\w.-]+:)?InstrmInf(?:\s[^>]*)?>\s*<(?:[\w.-]+:)?([\w.-]+)"


def _ident(block: Column, names: tuple[str, str, str]) -> list[Column]:
    return [block["OthrId"]["Id"].alias(names[0]), block["OthrId"]["Tp"]["Prtry"].alias(names[1]),
            block["PlcOfListg"]["MktIdrCd"].alias(names[2])]


def _trade_columns(r: Column) -> list[Column]:
    quotes = r["FinInstrmAttrbts"]
    return [r["TradDt"]["Dt"].alias("trade_date"), r["SctyId"]["TckrSymb"].alias("ticker"),
            *_ident(r["FinInstrmId"], ("instrument_id", "instrument_id_type", "market")),
            *[quotes[TRADE_FIELDS[c]].alias(c) for c in (*TRADE_DOUBLES, "trades_quantity")]]


def parse_trades(records: DataFrame) -> DataFrame:
    """``record`` texts of PriceReport elements to rows of text fields; each record is parsed once."""
    parsed = records.withColumn("r", F.from_xml("record", F.lit(TRADE_XML), _XML))
    return parsed.select(*[c for c in records.columns if c != "record"], *_trade_columns(F.col("r")))


def parse_instruments(records: DataFrame) -> DataFrame:
    """``record`` texts of Instrm elements; records without an instrument block are dropped, but for rows with an ``error``.

    The block is the first child of InstrmInf and its tag name is the type of the
    instrument, so the tag is read first and then given one name for all types.
    """
    kind = F.nullif(F.regexp_extract("record", _FIRST_CHILD, 1), F.lit(""))
    failed = F.col("error").isNotNull() if "error" in records.columns else F.lit(False)
    tagged = records.withColumn("instrument_type", kind).filter(F.col("instrument_type").isNotNull() | failed)
    uniform = F.regexp_replace(
        F.col("record"), F.concat(F.lit(r"<(/?)((?:[\w.-]+:)?)"), F.col("instrument_type"), F.lit(r"(?=[\s>/])")),
        F.lit("<$1$2InstrumentBlock"))
    r, block = F.col("r"), F.col("r.InstrmInf.InstrumentBlock")
    common = F.col("r.FinInstrmAttrCmon")
    return tagged.withColumn("r", F.from_xml(uniform, F.lit(INSTRUMENT_XML), _XML)).select(
        *[c for c in records.columns if c != "record"],
        r["RptParams"]["RptDtAndTm"]["Dt"].alias("report_date"), r["RptParams"]["UpdTp"].alias("update_type"),
        *_ident(r["FinInstrmId"], ("instrument_id", "instrument_id_type", "listing_market")),
        *[common[tag].alias(c) for c, tag in INSTRUMENT_BLOCKS["FinInstrmAttrCmon"].items()], "instrument_type",
        *[block[tag].alias(c) for c, tag in INSTRUMENT_FIELDS.items()],
        *_ident(block["UndrlygInstrmId"], tuple(UNDERLYING_FIELDS)))


def typed_trades(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "trade_date": X.to_day("trade_date"), **{c: X.to_double(c) for c in TRADE_DOUBLES},
        "trades_quantity": X.to_long("trades_quantity")})


def typed_instruments(rows: DataFrame) -> DataFrame:
    text = [c for c in rows.columns if c not in (*INSTRUMENT_DATES, *INSTRUMENT_DOUBLES, "error")]
    return rows.withColumns({
        **{c: F.trim(c) for c in text}, **{c: X.to_day(c) for c in INSTRUMENT_DATES if c in rows.columns},
        **{c: X.to_double(c) for c in INSTRUMENT_DOUBLES if c in rows.columns}})


def read_price_reports(spark: SparkSession, path: str) -> DataFrame:
    """Loose XML report files through the XML source: one row per PriceReport."""
    rows = spark.read.format("xml").options(rowTag="PriceReport", **_XML).schema(TRADE_XML).load(path)
    return rows.select(F.struct("*").alias("r")).select(*_trade_columns(F.col("r")))
