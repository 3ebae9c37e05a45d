"""Queries of raw files landed in silver, in a batch and as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from brickfolio.plans import raw as RAW, tables as TB
from brickfolio.plans.catalog import register
from brickfolio.plans.oracle_price import price_sql
from brickfolio.plans.queries_data import _INSTRUMENT, _INSTRUMENT_SQL, _TRADE, _TRADE_SQL
from brickfolio.plans.queries_identity import identity_sql
from brickfolio.plans.shape import select_list
from brickfolio.session import scratch_path, write_and_reread
from brickfolio.sources import archives as AR
from brickfolio.streaming import landing as L

REGISTER = L.register_kind(list(RAW.REGISTER_TEXT))


def _landed(s, folder, kind):
    target = scratch_path(s, "landed")
    L.land_files(AR.read_archives(s, folder, "*"), kind, target)
    return target


def _streamed(s, kind, *arrivals):
    """Files arrive in several runs of one stream."""
    folder, target, mark = (scratch_path(s, n) for n in ("arrivals", "streamed", "stream-mark"))
    for files in arrivals:
        for archives in files:
            RAW.write_files(archives, folder)
        out = L.stream_files(s, folder, kind, target, mark)
    return out


# --- trades ------------------------------------------------------------------------
def _trade_run(s, d):
    return _landed(s, RAW.write_files(RAW.spoiled_trade_archives(TB.daily_panel(s, d)), scratch_path(s, "raw-trades")), L.TRADES)


register("land_trades", lambda s, d: s.read.parquet(_trade_run(s, d)), _TRADE, price_sql(
    "daily", f"SELECT {select_list(_TRADE.split())} FROM ({_TRADE_SQL}) WHERE day(trade_date) % 10 NOT IN (3, 5, 7, 9)", "panel"))
_K = "day(trade_date) % 10"
register("landing_rejects", lambda s, d: L.rejected_files(s, _trade_run(s, d)).select(
    F.regexp_extract("path", "file=([^/]+)", 1).alias("file"), "rows", F.split_part("reason", F.lit(" "), F.lit(1)).alias("reason")), "file rows reason",
    price_sql("daily", f"""
  SELECT 'b3_download_' || strftime(trade_date + CASE WHEN k = 3 THEN 1 ELSE 0 END, '%Y%m%d') || '_' || part
           || CASE k WHEN 3 THEN 'w' WHEN 7 THEN '_cut' ELSE '' END || '.zip' AS file,
         CASE k WHEN 3 THEN n WHEN 5 THEN n + 1 ELSE 0 END AS rows,
         CASE k WHEN 3 THEN 'DATE_NOT_OF_FILE' WHEN 5 THEN 'SEVERAL_DATES' WHEN 7 THEN 'UNREADABLE' ELSE 'NO_ROWS' END AS reason
  FROM (SELECT trade_date, CAST(codigo_cvm AS BIGINT) // {RAW.PER_FILE} AS part, {_K} AS k, count(*) AS n FROM panel
        WHERE {_K} IN (3, 5, 7, 9) GROUP BY 1, 2, 3)""", "panel"))


# --- instruments -------------------------------------------------------------------
_ROWS = f"{_INSTRUMENT} file_day"
_ROWS_SQL = identity_sql(f"SELECT {select_list(_INSTRUMENT.split())}, last_day(report_date) AS file_day FROM ({_INSTRUMENT_SQL})", "instruments0")
register("land_instruments", lambda s, d: s.read.parquet(_landed(
    s, RAW.write_files(RAW.instrument_archives(TB.instruments(s, d), "v1"), scratch_path(s, "raw-instruments")), L.INSTRUMENTS)), _ROWS, _ROWS_SQL)


def _stream_instruments(s, d):
    rows = write_and_reread(TB.instruments(s, d), "instruments")  # four deliveries are made of them
    return _streamed(
        s, L.INSTRUMENTS,
        [RAW.instrument_archives(rows, "v1", odd=False), RAW.instrument_archives(rows, "v1", odd=True, asset="OLD")],
        # a newer snapshot of the odd months, and a late file of an older one of the even months
        [RAW.instrument_archives(rows, "v2", odd=True), RAW.instrument_archives(rows, "v0", odd=False, asset="OLDER")])


register("stream_instruments", _stream_instruments, _ROWS, _ROWS_SQL)


# --- register ----------------------------------------------------------------------
def _register(s, d):
    broken = F.replace("Denominacao_Social", F.lit(" - FII"), F.lit("\n- FII"))
    return TB.fund_register(s, d).withColumn("Denominacao_Social", F.when(F.col("Codigo_CVM").cast("int") % 7 == 3, broken).otherwise(F.col("Denominacao_Social")))


_REG = "CNPJ_Classe Codigo_CVM Tipo_Classe Denominacao_Social Situacao Data_Registro file_day"
_REG_SQL = identity_sql("""
  SELECT CNPJ_Classe, Codigo_CVM, Tipo_Classe, CASE WHEN CAST(Codigo_CVM AS INT) % 7 = 3 THEN replace(Denominacao_Social, ' - FII', chr(10) || '- FII')
         ELSE Denominacao_Social END AS Denominacao_Social, Situacao, CAST(Data_Registro AS VARCHAR) AS Data_Registro, Data_Registro AS file_day
  FROM register""", "register")
register("land_register", lambda s, d: s.read.parquet(_landed(
    s, RAW.write_files(RAW.register_snapshots(_register(s, d), "v1"), scratch_path(s, "raw-register")), REGISTER)), _REG, _REG_SQL)


def _stream_register(s, d):
    rows = _register(s, d)
    return _streamed(
        s, REGISTER,
        [RAW.register_snapshots(rows, "v1", odd=False), RAW.register_snapshots(rows, "v1", odd=True, situation="OLD")],
        [RAW.register_snapshots(rows, "v2", odd=True), RAW.register_snapshots(rows, "v0", odd=False, situation="OLDER")])


register("stream_register", _stream_register, _REG, _REG_SQL)
