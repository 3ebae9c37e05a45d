"""The platform's input tables, derived by Spark from the benchmark tables.

The benchmark has no fund data, so each input is mapped from a table that grows
with the scale factor. The oracle SQL applies the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brickfolio import contracts as C
from brickfolio.session import configure


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _panel(rows: DataFrame, entity: str) -> DataFrame:
    """Fill the identity columns of a panel keyed by a numeric entity."""
    e = F.col(entity).cast("string")
    return rows.withColumns({
        "ticker": F.concat(F.lit("FD"), e), "cnpj": F.lpad(e, 14, "0"), "codigo_cvm": e,
        "instrument_id": F.concat(F.lit("I"), e),
        "ticker_resolution_status": F.lit("SINGLE_TICKER"),
        "market_evidence_confidence": F.when(F.col("trades_quantity") >= 3, "HIGH").otherwise("LOW"),
    }).select([f.name for f in C.PANEL_SCHEMA])


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: one row per user and day.

    The order key of the first and last value is one decimal, so the aggregate
    keeps fixed-width buffers and stays a hash aggregate with a partial step.
    """
    return panel_from_events(read(spark, sf_dir, "events"))


def panel_from_events(events: DataFrame) -> DataFrame:
    order = (
        F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(20,0)") * F.lit(10 ** 15).cast("decimal(16,0)")
        + F.col("event_id").cast("decimal(20,0)"))
    rows = events.groupBy("user_id", F.to_date("ts").alias("trade_date")).agg(
        F.min_by("value", order).alias("open_price"), F.min("value").alias("low_price"),
        F.max("value").alias("high_price"), F.avg("value").alias("average_price"),
        F.max_by("value", order).alias("close_price"), F.count(F.lit(1)).alias("trades_quantity"))
    return _panel(rows, "user_id")


def weekly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: one row per supplier and week, for the jobs that need a long history."""
    items = read(spark, sf_dir, "lineitem")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    rows = items.groupBy(
        "l_suppkey", F.to_date(F.date_trunc("week", "l_shipdate")).alias("trade_date")
    ).agg(
        F.avg(unit).alias("open_price"), F.min(unit).alias("low_price"), F.max(unit).alias("high_price"),
        F.avg(unit).alias("average_price"),
        (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("close_price"),
        F.count(F.lit(1)).alias("trades_quantity"))
    return _panel(rows, "l_suppkey")


def registry(candidates: DataFrame) -> DataFrame:
    """Decisions by arithmetic on ticker and date; one class in 97 stays undecided."""
    number = F.substring("ticker", 3, 20).cast("bigint")
    h = (number * 31 + F.unix_date("event_date") * 17) % 97
    before, day = F.col("price_before"), F.col("event_date")
    confirmed, amortized = h <= 3, h.isin(2, 3)
    cash = F.when(h == 2, before * 0.05).when(h == 3, before * 0.03)
    in_kind = F.when(h == 2, 0.0).when(h == 3, before * 0.02)

    def only(test: Column, value) -> Column:
        return F.when(test, value)

    columns = {
        "review_status": only(confirmed, "CONFIRMED").when(h == 4, "REJECTED").otherwise("NOT_APPLICABLE"),
        "event_type": F.when(h == 0, "SPLIT").when(h == 1, "REVERSE_SPLIT").when(amortized, "AMORTIZATION")
        .otherwise("OTHER"),
        "quantity_multiplier": F.when(h == 0, 2.0).when(h == 1, 0.5),
        "price_adjustment_factor": F.when(h == 0, 0.5).when(h == 1, 2.0),
        "cash_amount_per_unit": cash, "in_kind_amount_per_unit": in_kind,
        "total_economic_value_per_unit": cash + in_kind,
        "in_kind_asset_ticker": only(h == 3, "FD999"), "in_kind_quantity_per_unit": only(h == 3, F.lit(0.5)),
        "corporate_action_record_date": only(confirmed, F.date_sub(day, 2)),
        "corporate_action_effective_date": only(confirmed, day),
        "cash_payment_date": only(amortized, F.date_add(day, 10)),
        "in_kind_delivery_date": only(h == 3, F.date_add(day, 12)),
        "first_post_event_trade_date": only(confirmed, day),
        "confirmation_source": only(confirmed, "NOTICE"), "confirmation_date": only(confirmed, F.date_add(day, 1)),
        "governance_review_date": F.date_add(day, 3), "review_notes": F.lit("reviewed"),
    }
    return candidates.filter(h != 5).select(
        "ticker", "event_date", *[columns[f.name].cast(f.dataType).alias(f.name)
                                  for f in C.REGISTRY_SCHEMA if f.name in columns])


# --- identity ---------------------------------------------------------------

def _padded(number: Column) -> Column:
    return F.lpad(number.cast("string"), 14, "0")


def fund_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part: one fund class per part; every 50th pair of parts shares an id."""
    k = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        _padded(F.when(k % 50 == 1, k - 1).otherwise(k)).alias("CNPJ_Classe"),
        F.col("p_partkey").cast("string").alias("Codigo_CVM"),
        F.when(F.col("p_type") == "SMALL", "Outros").otherwise(C.FUND_CLASS).alias("Tipo_Classe"),
        F.concat(F.lit("Fundo de Investimento Imobiliário "), "p_name", F.lit(" "), "p_brand", F.lit(" "),
                 F.col("p_size").cast("string"), F.lit(" - FII")).alias("Denominacao_Social"),
        F.when(F.col("p_size") % 10 == 0, "Cancelado").otherwise("Em Funcionamento Normal").alias("Situacao"),
        F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd").alias("Data_Registro"),
        F.col("p_retailprice").cast("string").alias("Patrimonio_Liquido"))


def silver_funds(register: DataFrame) -> DataFrame:
    """Fund classes keyed by normalised id."""
    return register.filter(F.col("Tipo_Classe") == C.FUND_CLASS).select(
        F.col("CNPJ_Classe").alias("cnpj"), "Codigo_CVM", "Denominacao_Social", "Situacao")


def _ticker(part: Column, kind: Column) -> Column:
    return F.concat(F.lit("P"), part.cast("string"), F.element_at(F.array(F.lit("11"), F.lit("12"), F.lit("13")),
                                                                    (kind + 1).cast("int")))


def _instrument(part: Column, kind: Column) -> Column:
    return F.concat(F.lit("I"), part.cast("string"), F.lit("-"), kind.cast("string"))


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x part: up to three instruments per part; some name another as underlying."""
    kind = F.col("kind")
    listed = read(spark, sf_dir, "lineitem").groupBy("l_partkey", (F.col("l_suppkey") % 3).alias("kind")).agg(
        F.to_date(F.max("l_shipdate")).alias("report_date"))
    rows = listed.join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    k = F.col("l_partkey")
    refers = (
        F.when((kind == 2) & (k % 4 <= 1), _instrument(k, F.lit(0)))
        .when((kind == 2) & (k % 4 == 2), _instrument(k, F.lit(1)))
        .when((kind == 1) & (k % 16 == 2), _instrument(k, F.lit(0))))
    return rows.select(
        _instrument(k, kind).alias("instrument_id"), F.lit("8").alias("instrument_id_type"),
        F.lit("BVMF").alias("listing_market"), _ticker(k, kind).alias("ticker"),
        F.concat(F.lit("BR"), k.cast("string"), kind.cast("string")).alias("isin"),
        F.concat(F.lit("A"), k.cast("string")).alias("asset"),
        F.concat(F.lit(" FDO INV IMOB "), F.upper("p_name"), F.lit(" "), "p_brand", F.lit(" "),
                 F.col("p_size").cast("string")).alias("corporate_name"),
        F.when((kind == 0) | (k % 5 == 0), "6").otherwise("1").alias("security_category"),
        F.lit("10").alias("b3_market"), F.lit("1").alias("b3_segment"),
        F.when(kind == 2, "OptnOnEqtsInf").otherwise("EqtyInf").alias("instrument_type"),
        refers.alias("underlying_instrument_id"), "report_date")


def traded_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: the instruments of trades; those of other lines are on no list of instruments."""
    listed = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 2)
    own = _instrument(F.col("l_partkey"), F.col("l_suppkey") % 3)
    return read(spark, sf_dir, "lineitem").select(F.when(listed, own).otherwise(F.concat(F.lit("U"), own)).alias("instrument_id"))


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: tickers of a part, one row each; a part of the lines names a ticker and a fund that nothing else knows."""
    known = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")
    k = F.col("l_partkey")
    own = _ticker(k, F.col("l_suppkey") % 3)
    return read(spark, sf_dir, "lineitem").select(
        F.when(known, own).otherwise(F.concat(F.lit("U"), own)).alias("ticker"), _padded(F.when(known, k).otherwise(k + 50_000_000)).alias("cnpj"),
        F.concat(F.lit("F "), k.cast("string")).alias("fund_name"), F.lit("Ativo").alias("category_status"),
        F.lit("mapping").alias("source")).distinct()


def part_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: sessions (weeks) in which a part's ticker was seen."""
    return read(spark, sf_dir, "lineitem").select(
        F.lower(_ticker(F.col("l_partkey"), F.col("l_suppkey") % 3)).alias("ticker"),
        F.to_date(F.date_trunc("week", "l_shipdate")).alias("trade_date"))


def price_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer: the funds, of which those with a balance are behind the tickers of the daily panel."""
    k = F.col("c_custkey").cast("string")
    return read(spark, sf_dir, "customer").select(
        F.concat(F.when(F.col("c_acctbal") > 0, "FD").otherwise("FX"), k).alias("ticker"), F.lpad(k, 14, "0").alias("cnpj"), k.alias("codigo_cvm"),
        F.col("c_name").alias("denominacao_social"), F.col("c_mktsegment").alias("situacao_cvm"),
        F.lit("RESOLVED_BY_B3").alias("ticker_resolution_status"), F.lit("HIGH").alias("market_evidence_confidence"))
