"""Raw files for the ingestion queries, made by Spark out of the benchmark tables."""

from __future__ import annotations

import io
import shutil
import tempfile
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brickfolio.plans import tables as TB
from brickfolio.sources import reports as R

PER_FILE = 500


def _tag(name: str, value: Column) -> Column:
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>"))


def _wrap(name: str, *inner: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name}>"))


def _ident(number: Column) -> Column:
    return F.concat(_wrap("OthrId", _tag("Id", number), _wrap("Tp", _tag("Prtry", F.lit("8")))),
                    _wrap("PlcOfListg", _tag("MktIdrCd", F.lit("BVMF"))))


def trade_records(panel: DataFrame) -> DataFrame:
    quotes = [_tag(R.TRADE_FIELDS[c], F.col(c)) for c in (*R.TRADE_DOUBLES, "trades_quantity")]
    record = _wrap(
        "PriceReport", _wrap("TradDt", _tag("Dt", F.col("trade_date"))), _wrap("SctyId", _tag("TckrSymb", F.col("ticker"))),
        _wrap("FinInstrmId", _ident(F.col("instrument_id"))), _wrap("FinInstrmAttrbts", *quotes))
    return panel.select("trade_date", F.col("codigo_cvm").cast("bigint").alias("number"), record.alias("record"))


def instrument_records(instruments: DataFrame, *kept: str) -> DataFrame:
    block = F.concat(*[
        _tag(R.INSTRUMENT_FIELDS[c], F.col(c)) for c in ("security_category", "ticker", "isin", "corporate_name")])
    under = F.when(F.col("underlying_instrument_id").isNotNull(),
                   _wrap("UndrlygInstrmId", _ident(F.col("underlying_instrument_id")))).otherwise("")
    kind = F.col("instrument_type")
    # one kind in five carries no instrument block and must be dropped
    inner = F.when(F.col("ticker").endswith("13") & F.col("underlying_instrument_id").isNull(), "").otherwise(
        F.concat(F.lit("<"), kind, F.lit(">"), block, under, F.lit("</"), kind, F.lit(">")))
    record = _wrap(
        "Instrm", _wrap("RptParams", _wrap("RptDtAndTm", _tag("Dt", F.col("report_date"))), _tag("UpdTp", F.lit("NEWI"))),
        _wrap("FinInstrmId", _ident(F.col("instrument_id"))),
        _wrap("FinInstrmAttrCmon", _tag("Asst", F.col("asset")), _tag("Mkt", F.col("b3_market")), _tag("Sgmt", F.col("b3_segment"))),
        _wrap("InstrmInf", inner))
    return instruments.select(*kept, record.alias("record"))


def _zip(batches):
    def pack(files: dict[str, bytes]) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, data in files.items():
                z.writestr(name, data)
        return out.getvalue()

    for batch in batches:
        paths, blobs = [], []
        for row in batch.to_pylist():
            inner = pack({m["member"]: m["body"] for m in row["members"]})
            paths.append(row["path"])
            blobs.append(pack({row["inner"]: inner}) if row["inner"] else inner)
        yield pa.RecordBatch.from_pydict({"path": paths, "content": blobs}, schema=pa.schema(
            [("path", pa.string()), ("content", pa.binary())]))


def _zipped(files: DataFrame, inner: str | Column | None = None) -> DataFrame:
    """``path`` with ``member`` and ``body``, or ``members`` of both, to archives, inside another one if ``inner`` names it; each
    file is bounded by ``PER_FILE`` records."""
    members = F.col("members") if "members" in files.columns else F.array(F.struct("member", "body"))
    name = F.lit(inner).cast("string") if inner is None or isinstance(inner, str) else inner
    return files.select("path", members.alias("members"), name.alias("inner")).mapInArrow(_zip, "path string, content binary")


def _packed(batches):
    """Texts of a batch by day, joined and compressed, with the least record of each. A null record leaves no text, as in an aggregate."""
    for batch in batches:
        texts: dict[str, list[str]] = {}
        least: dict[str, str] = {}
        for day, text, record in zip(*(batch.column(c).to_pylist() for c in ("day", "text", "record"))):
            own = texts.setdefault(day, [])
            if text is not None:
                own.append(text)
                least[day] = min(record, least.get(day, record))
        yield pa.record_batch([
            pa.array(list(texts), pa.string()), pa.array([least.get(d) for d in texts], pa.string()),
            pa.array([zlib.compress("".join(t).encode(), 1) for t in texts.values()], pa.binary())], ["day", "older", "piece"])


def _unpacked_zip(version: str):
    """(day, older, pieces) to archives of one archive of two XML files: the older record, and the pieces one after another, of which one at a
    time is unpacked."""
    def write(inner: zipfile.ZipFile, name: str, pieces) -> None:
        with inner.open(zipfile.ZipInfo(name), "w", force_zip64=True) as out:
            out.write(b'<?xml version="1.0"?><Document>')
            for piece in pieces:
                out.write(piece)
            out.write(b"</Document>")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                day, older = batch.column("day")[k].as_py(), batch.column("older")[k].as_py()
                if day is None:
                    # without a day there is no name
                    yield pa.record_batch([pa.nulls(1, pa.string()), pa.nulls(1, pa.binary())], ["path", "content"])
                    continue
                outer = io.BytesIO()
                with tempfile.TemporaryFile() as blob:
                    with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as inner:
                        write(inner, "BVBG.028.02_1.xml", [older.encode()])
                        write(inner, "BVBG.028.02_2.xml", (zlib.decompress(p.as_buffer()) for p in batch.column("pieces")[k].values))
                    blob.seek(0)
                    with zipfile.ZipFile(outer, "w", zipfile.ZIP_STORED) as z, z.open(zipfile.ZipInfo(f"IN{day}.zip"), "w", force_zip64=True) as stored:
                        shutil.copyfileobj(blob, stored, 1 << 20)
                # the archive's own memory, not a copy of it
                size = outer.getbuffer().nbytes
                content = pa.Array.from_buffers(pa.binary(), 1, [None, pa.array([0, size], pa.int32()).buffers()[1], pa.py_buffer(outer.getbuffer())])
                yield pa.record_batch([pa.array([f"b3_instruments_{day}_{version}.zip"]), content], ["path", "content"])
    return run


def write_files(archives: DataFrame, folder: str, mode: str = "append") -> str:
    """Archives as files, each in a folder of its name; extra columns become folders above it.

    Spark has no writer of plain bytes: its text writer leaves them as they are and adds a line end, which an archive may have behind it.
    """
    above = [c for c in archives.columns if c not in ("path", "content")]
    (archives.select(F.col("content").cast("string").alias("value"), *above, F.col("path").alias("file"))
     .write.mode(mode).option("maxRecordsPerFile", 1).partitionBy(*above, "file").text(folder))
    return folder


def _document(text: Column) -> Column:
    return F.encode(F.concat(F.lit('<?xml version="1.0"?><Document>'), text, F.lit("</Document>")), "UTF-8")


def trade_archives(panel: DataFrame) -> DataFrame:
    """Archives of price reports, at most ``PER_FILE`` tickers of one day each."""
    part = F.floor(F.col("number") / PER_FILE)
    files = trade_records(panel).groupBy("trade_date", part.alias("part")).agg(
        F.array_join(F.array_sort(F.collect_list("record")), "").alias("text"))
    name = F.concat(F.date_format("trade_date", "yyyyMMdd"), F.lit("_"), F.col("part").cast("string"))
    return _zipped(files.select(
        F.concat(F.lit("b3_download_"), name, F.lit(".zip")).alias("path"), F.concat(F.lit("PR_"), name, F.lit(".xml")).alias("member"),
        _document(F.col("text")).alias("body")), "SPRE.zip")


REGISTER_TEXT = ("CNPJ_Classe", "Codigo_CVM", "Tipo_Classe", "Denominacao_Social", "Situacao", "Data_Registro", "Patrimonio_Liquido")


def register_files(spark, sf_dir, western: bool = True) -> DataFrame:
    """Register files of at most ``PER_FILE`` lines; ``western`` puts every other one in the Western code page."""
    rows = TB.fund_register(spark, sf_dir).withColumn("part", F.floor(F.col("Codigo_CVM").cast("bigint") / PER_FILE))
    line = F.concat_ws(";", *REGISTER_TEXT)
    text = rows.groupBy("part").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("lines")).select(
        "part", F.concat(F.lit(";".join(REGISTER_TEXT) + "\n"), "lines").alias("text"))
    if not western:
        return text.select(F.concat(F.lit("register_"), F.col("part").cast("string")).alias("path"),
                           F.encode("text", "UTF-8").alias("body"))
    body = F.when(F.col("part") % 2 == 0, F.encode(F.concat(F.lit("﻿"), "text"), "UTF-8")).otherwise(
        F.encode("text", "ISO-8859-1"))
    return text.select(F.concat(F.lit("register_"), F.col("part").cast("string")).alias("path"), body.alias("body"))


def register_archives(spark, sf_dir, western: bool = True) -> DataFrame:
    return _zipped(register_files(spark, sf_dir, western).withColumn("member", F.lit("registro_classe.csv")))


def fund_pages(spark, sf_dir) -> DataFrame:
    """pages with the data block of a fund page appended; some lack an id or the block."""
    k = F.col("page_id")
    number = F.lpad(k.cast("string"), 14, "0")
    cnpj = F.when(k % 9 == 4, F.lit("12")).otherwise(F.concat(F.substring(number, 1, 8), F.lit(r"\/"), F.substring(number, 9, 6)))
    meta = F.concat(
        F.lit('<script>window.meta = {"Codigo": "fund'), k.cast("string"), F.lit('11", "extra": {"note": "a } \\" b", "n": {"x": 1}}, "name": "F '),
        k.cast("string"), F.lit(' S\\/A", "cnpj":"'), cnpj, F.lit('", "categorystatus": "ATIVO"};</script>'))
    return TB.read(spark, sf_dir, "pages").select(
        "page_id", F.concat("html", F.when(k % 13 == 5, F.lit("")).otherwise(meta)).alias("html"))


def spoiled_trade_archives(panel: DataFrame) -> DataFrame:
    """Archives of price reports, some of them bad: by the day of the month one has another day in its name, one a record of another
    day, one is cut off, and one holds no report."""
    part, k = F.floor(F.col("number") / PER_FILE), F.day("trade_date") % 10
    files = trade_records(panel).groupBy("trade_date", part.alias("part")).agg(
        F.array_join(F.array_sort(F.collect_list("record")), "").alias("text"), F.max("record").alias("last"))
    stray = F.regexp_replace("last", "<Dt>[^<]*</Dt>", "<Dt>1999-12-31</Dt>")
    text = F.when(k == 5, F.concat("text", stray)).when(k == 9, F.lit("")).otherwise(F.col("text"))
    named = F.when(k == 3, F.date_add("trade_date", 1)).otherwise(F.col("trade_date"))
    name = F.concat(F.date_format(named, "yyyyMMdd"), F.lit("_"), F.col("part").cast("string"), F.when(k == 3, "w").otherwise(""))
    packed = _zipped(files.select(
        F.concat(F.lit("b3_download_"), name, F.when(k == 7, "_cut").otherwise(""), F.lit(".zip")).alias("path"),
        F.concat(F.lit("PR_"), name, F.lit(".xml")).alias("member"), _document(text).alias("body")), "SPRE.zip")
    return packed.withColumn("content", F.when(F.contains("path", F.lit("_cut")), F.substring("content", 1, 60)).otherwise(F.col("content")))


def instrument_archives(instruments: DataFrame, version: str, odd: bool | None = None, asset: str | None = None) -> DataFrame:
    """One archive per month of report dates, of odd or even months or all. The first XML file inside is an older one; the last has some records twice."""
    month = F.last_day("report_date")
    rows = instruments if odd is None else instruments.filter(F.month("report_date") % 2 == int(odd))
    if asset:
        rows = rows.withColumn("asset", F.lit(asset))
    # a month has any number of records: they are packed where they lie, and an archive is made of the packed pieces
    record = instrument_records(rows.withColumn("day", F.date_format(month, "yyMMdd")), "day")
    twice = F.when(F.contains("record", F.lit("EqtyInf")), F.concat("record", "record")).otherwise(F.col("record"))
    pieces = record.select("day", twice.alias("text"), "record").mapInArrow(_packed, "day string, older string, piece binary")
    files = pieces.groupBy("day").agg(F.min("older").alias("older"), F.collect_list("piece").alias("pieces"))
    return files.mapInArrow(_unpacked_zip(version), "path string, content binary")


def register_snapshots(register: DataFrame, version: str, odd: bool | None = None, situation: str | None = None) -> DataFrame:
    """One register per day of registration (year, month, day, path, content). Some names hold a line end, inside quotes."""
    rows = register if odd is None else register.filter(F.day("Data_Registro") % 2 == int(odd))
    if situation:
        rows = rows.withColumn("Situacao", F.lit(situation))
    line = F.concat_ws(";", *[F.concat(F.lit('"'), F.col(c), F.lit('"')) if c == "Denominacao_Social" else F.col(c) for c in REGISTER_TEXT])
    files = rows.groupBy("Data_Registro").agg(F.array_join(F.array_sort(F.collect_list(line)), "\r\n").alias("lines"))
    body = F.encode(F.concat(F.lit(";".join(REGISTER_TEXT) + "\r\n"), F.col("lines"), F.lit("\r\n")), "ISO-8859-1")
    named = files.select(F.concat(F.lit(f"registro_fundo_classe_{version}_"), F.col("Data_Registro"), F.lit(".zip")).alias("path"),
                         F.lit("registro_classe.csv").alias("member"), body.alias("body"))
    day = F.to_date(F.regexp_extract("path", "([0-9-]{10})[.]zip", 1))
    return _zipped(named).withColumns({"year": F.year(day), "month": F.month(day), "day": F.day(day)})


def text_files(lines: DataFrame, group: str, header: str) -> DataFrame:
    """``line`` by ``group`` to delimited files (path, content) with a header each; a group is bounded by ``PER_FILE`` lines."""
    files = lines.groupBy(group).agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("lines"))
    return files.select(F.concat(F.lit("part_"), F.col(group).cast("string"), F.lit(".csv")).alias("path"),
                        F.encode(F.concat(F.lit(header + "\n"), "lines"), "UTF-8").alias("content"))
