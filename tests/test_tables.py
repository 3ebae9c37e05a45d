"""Identity, sources, publication, health and serving."""

import io
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.operators import calendar as K, health as HE, identity as ID, publish as P
from brickfolio.sources import archives as AR, pages as PG, partitions as PT, reports as R
from brickfolio.streaming.raw_to_silver import stream_raw_to_silver
from conftest import day


def test_core_name_folds_accents_and_drops_generic_words(spark):
    names = ["Fundo de Investimento Imobiliário São João – RESP. LIM", "FII", None, "ﬁno Ⅷ ½ ção", "Ａｂｃ 10%"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(X.core_name("n")).collect()] == ["SAO JOAO", "", "", "FINO VIII 12 CAO", "ABC 10"]


def test_tax_id(spark):
    df = spark.createDataFrame([("12.345.678/0001-90",), ("123",), (None,)], "n string")
    assert [r[0] for r in df.select(X.tax_id("n")).collect()] == ["12345678000190", None, None]


@pytest.fixture(scope="module")
def market(spark):
    funds = [("1", "c1", "Alfa FII"), ("2", "c2", "Beta FII"), ("3", "c3", "Gama"), ("4", "c4", "Delta"), ("5", "c5", "Same"),
             ("6", "c6", "SAME fii"), ("7", "c7", "Fundo de FII")]
    register = spark.createDataFrame([(i, c, n, C.FUND_CLASS, "ok") for i, c, n in funds],
                                     "CNPJ_Classe string, Codigo_CVM string, Denominacao_Social string, Tipo_Classe string, Situacao string")

    def instrument(i, ticker, name, kind="EqtyInf", category="6", under=None):
        return (i, "8", "BVMF", ticker, "BR" + i, "A", name, category, "10", "1", kind, under, date(2024, 1, 5))

    rows = [
        instrument("a1", "ALFA11", "ALFA"), instrument("a2", "ALFA12", "ALFA", under="a1", category="1"),
        instrument("b1", "BETA11", "BETA"), instrument("b2", "BETA13", "BETA", category="1"),
        instrument("g1", "GAMA11", "GAMA"), instrument("g2", "GAMA11", "GAMA"),
        instrument("d1", "DELT11", "DELTA", under="d2"), instrument("d2", "DELT12", "DELTA", under="d1"),
        instrument("s1", "SAME11", "SAME")]
    schema = ("instrument_id string, instrument_id_type string, listing_market string, ticker string, isin string, asset string, "
              "corporate_name string, security_category string, b3_market string, b3_segment string, instrument_type string, "
              "underlying_instrument_id string, report_date date")
    return register, spark.createDataFrame(rows, schema)


def test_resolution_rules(spark, market):
    trades = spark.createDataFrame([("b1",), (None,)], "instrument_id string")
    got = {r.cnpj_classe: r for r in ID.fund_master(*market, trades).collect()}
    assert (got["1"].ticker, got["1"].resolution_evidence) == ("ALFA11", "STRUCTURAL_ONLY")
    assert (got["2"].ticker, got["2"].resolution_evidence) == ("BETA11", "SIGNATURE_AND_TRADED")
    assert got["3"].resolution_status == "UNRESOLVED"            # two signatures
    assert got["4"].resolution_status == "UNRESOLVED"            # two structural candidates
    assert set(got) == {"1", "2", "3", "4"}                      # shared and empty names have no bridge
    assert got["1"].reference_date == date(2024, 1, 5)
    no_trades = {r.cnpj_classe: r for r in ID.fund_master(*market).collect()}
    assert no_trades["2"].resolution_evidence == "SIGNATURE_ONLY"


def test_master_quality_finds_one_broken_rule(spark, market):
    master = ID.fund_master(*market)
    status = {r.check_name: r.status for r in HE.master_quality(master, tuple(ID.MASTER_COLUMNS)).collect()}
    assert status["resolution_rate"] == "WARN" and "FAIL" not in status.values() and len(status) == 12
    broken = master.withColumn("ticker", F.when(F.col("cnpj_classe") == "1", " ").otherwise(F.col("ticker")))
    assert [r.check_name for r in HE.master_quality(broken).filter("status = 'FAIL'").collect()] == ["resolved_without_ticker"]
    twice = master.unionByName(master.filter("cnpj_classe = '3'"))
    assert [(r.check_name, r.measured) for r in HE.master_quality(twice).filter("status = 'FAIL'").collect()] == [("duplicate_cnpj", 2)]


def zipped(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in files.items():
            z.writestr(name, data)
    return out.getvalue()


PRICE = ('<b:PriceReport xmlns:b="urn:x"><b:TradDt><b:Dt>2024-01-02</b:Dt></b:TradDt><b:SctyId><b:TckrSymb>{t}</b:TckrSymb></b:SctyId>'
         '<b:FinInstrmAttrbts><b:LastPric>{p}</b:LastPric><b:RglrTxsQty>7</b:RglrTxsQty></b:FinInstrmAttrbts></b:PriceReport>')


def test_nested_archive_to_typed_rows(spark, tmp_path):
    body = '<?xml version="1.0"?><b:Doc xmlns:b="urn:x">' + "".join(PRICE.format(t=f"T{i}", p=i) for i in range(4500)) + "</b:Doc>"
    (tmp_path / "b3_download_20240102.zip").write_bytes(zipped({"SPRE240102.zip": zipped({"PR.xml": body, "readme.txt": "no"})}))
    got = R.typed_trades(R.parse_trades(AR.xml_records(AR.read_archives(spark, str(tmp_path)), "PriceReport")))
    assert got.count() == 4500
    row = got.filter("ticker = 'T12'").first()
    assert (row.trade_date, row.close_price, row.trades_quantity, row.open_price) == (date(2024, 1, 2), 12.0, 7, None)


def test_loose_xml_reports(spark, tmp_path):
    (tmp_path / "r.xml").write_text("<Doc>" + PRICE.format(t="AAAA11", p="9.5").replace("b:", "").replace(' xmlns:b="urn:x"', "") + "</Doc>")
    (row,) = R.typed_trades(R.read_price_reports(spark, str(tmp_path / "r.xml"))).collect()
    assert (row.ticker, row.close_price) == ("AAAA11", 9.5)


def test_unknown_instrument_kinds_and_missing_blocks(spark):
    ident = "<FinInstrmId><OthrId><Id>{i}</Id><Tp><Prtry>8</Prtry></Tp></OthrId></FinInstrmId>"
    records = ["<Instrm>" + ident.format(i=1) + "<InstrmInf><OddInf><TckrSymb>X11</TckrSymb><UndrlygInstrmId><OthrId><Id>9</Id></OthrId>"
               "</UndrlygInstrmId></OddInf></InstrmInf></Instrm>",
               "<Instrm>" + ident.format(i=2) + "<InstrmInf></InstrmInf></Instrm>", "<Instrm>" + ident.format(i=3) + "</Instrm>"]
    (row,) = R.parse_instruments(spark.createDataFrame([(r,) for r in records], "record string")).collect()
    assert (row.instrument_id, row.instrument_type, row.ticker, row.underlying_instrument_id) == ("1", "OddInf", "X11", "9")


def test_encodings_and_register_rows(spark):
    text = "A;B\nção;1\n“x”;2\n"
    files = spark.createDataFrame([("u", text.encode("utf-8-sig")), ("w", text.encode("cp1252")), ("l", b"A;B\n\x81\xe7;3\n")],
                                  "path string, content binary")
    got = {(r.path, r.B): r.A for r in AR.register_rows(files, ["A", "B"]).collect()}
    assert got == {("u", "1"): "ção", ("u", "2"): "“x”", ("w", "1"): "ção", ("w", "2"): "“x”", ("l", "3"): "\x81ç"}


def test_registers_follow_their_own_header(spark):
    files = spark.createDataFrame([("x", b"B;A\nb1;a1\n"), ("y", b"C; A ;B;D\nc2;\"a;2\";b2;d2\n\n")], "path string, content binary")
    assert {(r.path, r.A, r.B) for r in AR.register_rows(files, ["A", "B"]).collect()} == {("x", "a1", "b1"), ("y", "a;2", "b2")}
    with pytest.raises(Exception, match="no column C in x"):
        AR.register_rows(files, ["A", "C"]).collect()


def test_register_records_end_outside_quotes(spark):
    import io as _io

    import pandas as pd

    text = ('A;B;C\r\n1;"line\nbreak; ""quoted""";x\r\n2;in"side;""\n\n"3";"a\r\nb"tail;"last"\n4;;"unclosed? no"\n5;p;q')
    wide = ";".join(f"H{k}" for k in range(300)) + "\n" + ";".join(str(k) for k in range(300)) + "\n"
    files = spark.createDataFrame([("q", text.encode()), ("n", b"C;A\n1;2\r\n3;4")], "path string, content binary")
    want = pd.read_csv(_io.StringIO(text, newline=""), sep=";", dtype=str, lineterminator=None)
    rows = [tuple(None if v != v else v for v in r) for r in want.itertuples(index=False)]
    got = AR.register_rows(files.filter("path = 'q'"), ["A", "B", "C"]).collect()
    assert sorted((r.A, r.B, r.C) for r in got) == sorted(rows)
    assert [(r.A, r.C) for r in AR.register_rows(files.filter("path = 'n'"), ["A", "C"]).collect()] == [("2", "1"), ("4", "3")]
    (row,) = AR.register_rows(spark.createDataFrame([("w", wide.encode())], "path string, content binary"), ["H299", "H0"]).collect()
    assert (row.H299, row.H0) == ("299", "0")


def test_xml_records_in_their_declared_encoding_and_without_content(spark):
    def pack(text, encoding):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("r.xml", text.encode(encoding))
        return out.getvalue()
    body = '<?xml version="1.0" encoding="{e}"?><D><R/><R k="1"/><R><n>a\u00e7\u00e3o</n></R><R></R></D>'
    df = spark.createDataFrame([(e, pack(body.format(e=e), e)) for e in ("utf-8", "ISO-8859-1")], "path string, content binary")
    for path in ("utf-8", "ISO-8859-1"):
        got = sorted(r.record for r in AR.xml_records(df, "R").where(F.col("path") == path).collect())
        assert got == sorted(["<R/>", '<R k="1"/>', "<R><n>a\u00e7\u00e3o</n></R>", "<R></R>"])


def test_archive_fingerprint_ignores_packing(spark):
    def pack(method, names):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", method) as z:
            for n in names:
                z.writestr(n, n * 3)
        return out.getvalue()
    df = spark.createDataFrame([("a", pack(zipfile.ZIP_STORED, ["x", "y"])), ("b", pack(zipfile.ZIP_DEFLATED, ["y", "x"])),
                                ("c", pack(zipfile.ZIP_STORED, ["x", "z"]))], "path string, content binary")
    got = {r.path: r.content_sha256 for r in AR.archive_fingerprint(df).collect()}
    assert got["a"] == got["b"] != got["c"]


def test_page_fields_and_links(spark):
    pages = [("<script>meta = {\"a\": {\"b\": \"}\"}, \"codigo\": \"abcd11\", \"CNPJ\": \"12.345.678\\/0001-90\", \"name\": \"N\"}</script>"
              "<a class=x href='/funds/abcd11'>1</a><a href=\"/funds/efgh11?x\">2</a><a href='/other'>3</a>",),
             ("<p>nothing</p>",), ("meta: {\"codigo\": \"zzzz11\"}",)]
    df = spark.createDataFrame(pages, "html string")
    good, bad = PG.good_and_rejected(df)
    (row,) = good.collect()
    assert (row.ticker, row.cnpj, row.fund_name) == ("ABCD11", "12345678000190", "N")
    assert sorted(r.reject_reason for r in bad.collect()) == ["CNPJ_NOT_FOUND", "META_NOT_FOUND"]
    assert sorted(r.ticker for r in PG.page_links(df).collect()) == ["ABCD11", "EFGH11"]


def test_meta_objects_of_any_depth_and_case(spark):
    deep = '{"a": ' * 9 + '{"codigo": "abcd11", "b": "\\"}"}' + "}" * 9
    pages = [("META = {" + '"x": ' + deep + ', "cnpj": "12345678000190"} tail {"codigo": "zzzz11"}',), ('meta = {"codigo": "abcd11"',)]
    good, bad = PG.good_and_rejected(spark.createDataFrame(pages, "html string"))
    assert [(r.ticker, r.cnpj) for r in good.collect()] == [("ABCD11", "12345678000190")]
    assert [r.reject_reason for r in bad.collect()] == ["META_NOT_FOUND"]


def test_registry_from_csv(spark, tmp_path):
    header = ",".join(f.name for f in C.REGISTRY_SCHEMA)
    cells = {"ticker": " abcd11 ", "event_date": "2024-01-02", "review_status": "confirmed", "quantity_multiplier": "x", "confirmation_date": "02/01/2024"}
    (tmp_path / "r.csv").write_text(header + "\n" + ",".join(cells.get(f.name, "") for f in C.REGISTRY_SCHEMA) + "\n")
    (row,) = PT.read_registry(spark, str(tmp_path / "r.csv")).collect()
    assert (row.ticker, row.event_date, row.review_status) == ("ABCD11", date(2024, 1, 2), "CONFIRMED")
    assert row.quantity_multiplier is None and row.confirmation_date is None
    assert PT.read_registry(spark, None).count() == 0


def test_fingerprint_ignores_order_and_clock_but_sees_values(spark):
    rows = [(i % 3, i, f"v{i}", datetime(2024, 1, 1)) for i in range(50)]
    schema = "part int, a long, b string, created_at timestamp"
    prints = lambda r: {x.part: x.content_sha256 for x in P.content_fingerprint(spark.createDataFrame(r, schema), ["part"]).collect()}
    base = prints(rows)
    assert prints([(p, a, b, datetime(2025, 5, 5)) for p, a, b, _ in reversed(rows)]) == base
    changed = prints([(p, a, "other" if a == 4 else b, c) for p, a, b, c in rows])
    assert changed[1] != base[1] and changed[0] == base[0] and changed[2] == base[2]
    assert prints(rows + rows[:1])[0] != base[0]


def test_fingerprints_of_different_rows_and_types_differ(spark):
    prints = [P.content_fingerprint(spark.createDataFrame([(1, *r)], f"p int, {schema}"), ["p"]).first().content_sha256 for r, schema in [
        (("a|b", "c"), "a string, b string"), (("a", "b|c"), "a string, b string"), ((None, "c"), "a string, b string"), (("-;", "c"), "a string, b string"),
        (("1", "c"), "a string, b string"), ((1, "c"), "a int, b string"), ((1, "c"), "a long, b string")]]
    assert len(set(prints)) == len(prints)


def test_failed_checks_stop_a_publish(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string")
    checks = spark.createDataFrame([("KEY_UNIQUE", 0, "PASS")], "check_name string, violations int, status string")
    assert P.publish_checked(rows, checks, str(tmp_path / "good"), ["p"], ["v"]).count() == 2
    with pytest.raises(C.ContractError, match="KEY_UNIQUE=3"):
        P.publish_checked(rows, checks.selectExpr("check_name", "3 as violations", "'FAIL' as status"), str(tmp_path / "bad"), ["p"], ["v"])
    assert not (tmp_path / "bad").exists()


def test_saved_sql_prunes_to_partitions(spark):
    from brickfolio.plans import load_catalog
    plan = load_catalog()[0]["sql_history"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan


def test_publish_decisions(spark):
    new = spark.createDataFrame([(1, "r1", "c1"), (2, "r2", "c2"), (3, "r3", "c3"), (4, "r4", "c4")], "p int, raw_sha256 string, content_sha256 string")
    old = spark.createDataFrame([(1, "r1", "zz"), (2, "xx", "c2"), (3, "xx", "zz")], new.schema)
    got = {r.p: r.action for r in P.publish_decision(new, old, ["p"]).collect()}
    assert got == {1: "SKIP_IDENTICAL", 2: "SKIP_REPACKAGED", 3: "BLOCK", 4: "UPLOAD"}
    forced = {r.p: r.action for r in P.publish_decision(new, old, ["p"], force=True).collect()}
    assert forced == {1: "NEW_VERSION", 2: "NEW_VERSION", 3: "NEW_VERSION", 4: "UPLOAD"}


def test_stream_takes_each_file_once_and_late_files_add_to_their_days(spark, panel, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("raw", "silver", "mark"))
    land = lambda: stream_raw_to_silver(
        spark, source, C.PANEL_SCHEMA, lambda b: b, target, mark, key=["ticker", "trade_date"])
    panel({"A": {0: 1.0, 1: 2.0}, "B": {0: 5.0, 1: 6.0}}).write.parquet(source)
    assert land().count() == 4
    assert land().count() == 4                                   # nothing new
    panel({"A": {1: 9.0, 2: 3.0}}).write.mode("append").parquet(source)
    got = {(r.ticker, r.trade_date): r.close_price for r in land().collect()}
    assert got == {("A", day(0)): 1.0, ("B", day(0)): 5.0, ("B", day(1)): 6.0, ("A", day(1)): 9.0, ("A", day(2)): 3.0}


def test_stream_loses_no_row_of_a_day_in_many_files(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("raw", "silver", "mark"))
    rows = spark.range(400).select(F.lit(day(0)).alias("trade_date"), F.concat(F.lit("T"), F.col("id") % 7).alias("ticker"), F.col("id").alias("n"))
    total = lambda r: r.groupBy("trade_date", "ticker").agg(F.sum("n").alias("n"))
    for part in (rows.where("n % 3 > 0"), rows.where("n % 3 = 0")):
        part.repartition(130).write.mode("append").parquet(source)
        out = stream_raw_to_silver(spark, source, rows.schema, total, target, mark)
    assert {(r.ticker, r.n) for r in out.collect()} == {(r.ticker, r.n) for r in total(rows).collect()}


def test_calendar_and_cycles(spark):
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 14),)], "d date")
    holidays = spark.createDataFrame([(date(2024, 1, 1),)], "day date")
    special = spark.createDataFrame([(date(2024, 1, 6),), (date(2024, 1, 2),)], "day date")
    got = {r.day.day: r for r in K.trading_calendar(K.days_of(days, "d"), holidays, special).collect()}
    assert (got[1].status, got[6].status, got[2].special, got[6].special) == ("B3_HOLIDAY", "WEEKEND", True, False)
    assert got[8].previous_trading_day == date(2024, 1, 5) and got[1].previous_trading_day is None
    expected = K.expected_cycles(K.days_of(days, "d"), [0, 1, 2, 3, 4], holidays)
    seen = spark.createDataFrame([(date(2024, 1, d),) for d in (2, 3, 4, 5, 8, 9, 10, 12, 13)], "run_date date")
    (row,) = K.assess_cycles(expected, seen).collect()
    assert (row.expected_count, row.missing_count, row.unexpected_count, row.first_missing, row.status) == (
        9, 1, 1, date(2024, 1, 11), "GAPS_DETECTED")


@pytest.mark.parametrize("output, status, hours, want", [
    (True, "FAILED", 0, "COMPLETE"), (False, None, 0, "NO_STATE"), (False, "failed", 0, "RETRY_ALLOWED"),
    (False, "SUCCEEDED", 0, "INCONSISTENT_STATE"), (False, "STARTED", 1, "IN_PROGRESS"), (False, "STARTED", 9, "RETRY_ALLOWED"),
    (False, "PAUSED", 0, "UNKNOWN_STATE")])
def test_execution_states(spark, output, status, hours, want):
    now = datetime(2024, 1, 2, 12)
    df = spark.createDataFrame([(day(1), output, status, datetime(2024, 1, 2, 12 - hours))],
                               "run_date date, output_exists boolean, status string, started_at timestamp")
    assert HE.execution_state(df, now, 120).first().execution_state == want


def test_freshness_and_reconciliation(spark, panel):
    p = panel({"A": {0: 1.0, 1: 2.0}})
    spec = HE.DatasetSpec("panel", ("ticker", "trade_date"), "trade_date")
    status = lambda ref: HE.inspect(p, spec, ref, 3).first().freshness_status
    assert (status(day(4)), status(day(5)), status(day(0))) == ("PASS", "FAIL", "FAIL")   # old, and in the future
    assert HE.reconcile_keys(p, p, ["ticker", "trade_date"], "x").first().status == "PASS"
    row = HE.reconcile_keys(p, p.limit(1), ["ticker", "trade_date"], "x").first()
    assert (row.only_left, row.only_right, row.status) == (1, 0, "FAIL")
