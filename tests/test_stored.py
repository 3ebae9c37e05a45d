"""Stored tables: pruning, verified and versioned publication, files with bad records."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F, types as T

from brickfolio.contracts import ContractError
from brickfolio.operators import diagnostics as DG, identity as ID, publish as P, splits as S
from brickfolio.operators.versions import VersionLog
from brickfolio.sources import stored as ST
from conftest import day


def scans(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]


@pytest.mark.parametrize("parts", [["year", "month", "day"], ["trade_date"]])
def test_the_latest_partition_is_read_alone(spark, tmp_path, parts):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(day(n), f"T{k}") for n in range(40) for k in range(3)], "trade_date date, ticker string")
    own = P.with_date_parts(rows, "trade_date") if len(parts) > 1 else rows
    own.write.partitionBy(*parts).parquet(path)
    column = None if len(parts) > 1 else "trade_date"
    for as_of, want in ((None, day(39)), (date(2024, 1, 10), date(2024, 1, 10)), (date(2030, 1, 1), day(39))):
        got = ST.latest_stored(spark, path, as_of, column)
        assert sorted((r.trade_date, r.ticker) for r in got.select("trade_date", "ticker").collect()) == [(want, f"T{k}") for k in range(3)]
        (scan,) = scans(got)
        assert "PartitionFilters: []" not in scan
        read = {r.f for r in got.select(F.input_file_name().alias("f")).distinct().collect()}
        everything = spark.read.parquet(path).inputFiles()
        assert 0 < len(read) <= 3 < len(everything)
    with pytest.raises(ContractError, match="no partition up to"):
        ST.latest_stored(spark, path, date(2020, 1, 1), column)


def test_a_publication_that_loses_or_changes_a_row_stops(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(k % 3, f"r{k}", None if k == 5 else float(k)) for k in range(30)], "p int, a string, b double").repartition(4)
    out = P.publish_verified(rows, str(tmp_path / "ok"), ["p"], ["a"])
    assert out.select(rows.columns).exceptAll(rows).count() == 0 and out.count() == 30
    assert P.publish_verified(rows, str(tmp_path / "ok"), ["p"], ["a"]).count() == 30
    assert P.publish_verified(rows, str(tmp_path / "single"), [], ["a"]).count() == 30
    assert P.publish_verified(rows.limit(0), str(tmp_path / "none"), ["p"], ["a"]).count() == 0
    real = type(spark.read).parquet
    for spoil in (lambda df: df.filter("a <> 'r7'"), lambda df: df.withColumn("b", F.when(F.col("a") == "r7", 0.5).otherwise(F.col("b"))),
                  lambda df: df.filter("a <> 'r7'").unionByName(df.filter("a = 'r8'"))):
        monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, spoil=spoil: spoil(real(self, *p)))
        with pytest.raises(ContractError, match="published rows are not the input"):
            P.publish_verified(rows, str(tmp_path / "bad"), ["p"], ["a"])


def test_versions_are_committed_once_each(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path / "log"))
    rows = spark.range(10).toDF("k")
    assert log.publish(rows, "t") == ("UPLOAD", 1)
    assert log.publish(rows.orderBy(F.desc("k")), "t") == ("SKIP_IDENTICAL", 1)
    with pytest.raises(ContractError, match="differs from version 1"):
        log.publish(rows.filter("k > 0"), "t")
    # four writers, each with rows of its own: every one gets a number, and no number is given twice
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(inheritable_thread_target(spark)(lambda n: log.publish(rows.filter(f"k <> {n}"), "t", force=True)), range(4)))
    assert sorted(v for _, v in got) == [2, 3, 4, 5] and {a for a, _ in got} == {"NEW_VERSION"}
    assert sorted(r.version for r in log.entries().collect()) == [1, 2, 3, 4, 5]
    assert log.read("t", 1).count() == 10 and log.read("t").count() == 9
    assert log.publish(rows, "u", raw_sha256="a") == ("UPLOAD", 6)
    assert log.publish(rows, "u", raw_sha256="a")[0] == "SKIP_IDENTICAL"
    assert log.publish(rows, "u", raw_sha256="b")[0] == "SKIP_REPACKAGED"
    with pytest.raises(ContractError, match="no such version"):
        log.read("t", 6)


def test_good_and_bad_records_of_one_scan(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text('k,d,x\n a ,2024-01-02,1.5\nb,2024-02-30,2\nc,2024-01-03,1e\n,2024-01-03,1\nd,2024-01-04\n"e,f", ,\ng,2024-01-05,NaN,9\n')
    (folder / "b.csv").write_text("k,d,x\nz,2024-01-06,3\n")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.DateType()), T.StructField("x", T.DoubleType())])
    checked = ST.read_checked_csv(spark, str(folder), schema, key=("k",), upper=("k",))
    assert sorted((r.k, r.d, r.x) for r in ST.good_records(checked).collect()) == [("A", date(2024, 1, 2), 1.5), ("E,F", None, None), ("Z", date(2024, 1, 6), 3.0)]
    bad = ST.rejected_records(checked)
    assert sorted(str((r.k, r.reject_reason)) for r in bad.collect()) == sorted(map(str, [
        ("B", "BAD_D"), ("C", "BAD_X"), (None, "MISSING_K"), ("D", "MALFORMED"), ("G", "MALFORMED")]))
    assert sorted(r.record for r in bad.select("record").where("record is not null").collect()) == ["d,2024-01-04", "g,2024-01-05,NaN,9"]


def test_sources_end_at_different_dates(spark, tmp_path):
    path = str(tmp_path / "objects")
    spark.createDataFrame([("a", date(2024, 1, n), n) for n in range(1, 9)] + [("b", date(2024, 1, 3), 0)], "source string, day date, n int").write.partitionBy("source", "day").parquet(path)
    got = {r.source: (r.partition_date.day, r.files) for r in ST.latest_objects(spark, path, "source", "day", date(2024, 1, 5)).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": 5, "b": 3} and all(v[1] >= 1 for v in got.values())


def test_splits_are_held_against_the_training_set(spark):
    schema = "ticker string, feature_date date, ml_eligible boolean, target_return_next_5d double"
    training = spark.createDataFrame([("A", day(n), n != 4, 0.0 if n == 2 else float(n)) for n in range(8)], schema)
    sides = {"train": training.filter(F.col("feature_date") < F.lit(day(3))), "test": training.filter(F.col("feature_date") > F.lit(day(5)))}
    count = lambda s: {r.check_name: r.violations for r in S.split_contract(s, training).collect() if r.violations}
    assert count(sides) == {}
    assert count({**sides, "test": sides["test"].unionByName(sides["train"].limit(1))}) == {"KEY_IN_ONE_SPLIT": 1}
    assert count({**sides, "test": training.filter(F.col("feature_date") == F.lit(day(4)))}) == {"ROW_ELIGIBLE": 1}
    spoiled = sides["train"].withColumn("target_return_next_5d", F.when(F.col("feature_date") == F.lit(day(2)), F.lit(-0.0)).otherwise(F.col("target_return_next_5d")))
    assert count({**sides, "train": spoiled}) == {"TARGET_UNCHANGED": 1}
    assert count({**sides, "train": sides["train"].withColumn("ticker", F.lit("B"))}) == {"KEY_IN_TRAINING": 3}


def test_extremes_keep_so_many_rows_a_split_in_each_task(spark):
    y = "target_return_next_5d"
    rows = spark.createDataFrame([(s, f"T{k:03}", day(k), day(k + 5), 1.0, 1.0, float(k % 40), 0.0, 0.0) for s in ("train", "test") for k in range(200)],
                                 f"split_name string, ticker string, feature_date date, target_date date, close_price double, target_price_next_5d double, {y} double, "
                                 "target_price_return_next_5d double, target_economic_vs_price_difference double")
    got = DG.extreme_rows(rows.repartition(4), 7, 3)
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
    first = [r.ticker for r in got.filter("split_name = 'test' and side = 'worst'").orderBy("position").collect()]
    assert first == ["T000", "T040", "T080", "T120", "T160", "T001", "T041"]
    assert got.count() == 20


def test_an_empty_master_fails(spark):
    rows = spark.createDataFrame([], "cnpj string")
    assert {r.check_name: r.violations for r in ID.silver_master_checks(rows).collect()} == {"NOT_EMPTY": 1, "ID_PRESENT": 0, "ID_UNIQUE": 0}


def test_the_adjusted_job_stops_at_decisions_without_effect(spark, panel, registry, tmp_path):
    from brickfolio.operators import adjusted as A

    prices = panel({"A": {0: 10.0, 1: 5.0, 2: 5.1}})
    decide = lambda n, factor=0.5: registry(dict(ticker="A", event_date=day(n), review_status="CONFIRMED", event_type="SPLIT",
                                                 quantity_multiplier=2.0, price_adjustment_factor=factor))
    assert A.publish_adjusted(prices, decide(1), str(tmp_path / "t")).count() == 3
    for bad, problem in ((decide(2), "without candidate"), (decide(7), "without price row"), (decide(1, 0.2), "RECIPROCAL=1")):
        with pytest.raises(ContractError, match=problem):
            A.publish_adjusted(prices, bad, str(tmp_path / "t"))


def test_the_adjusted_job_goes_on_after_a_close_of_zero(spark, panel, registry, tmp_path):
    from brickfolio.operators import adjusted as A

    none = registry()
    prices = panel({"A": {0: 10.0, 1: 0.0, 2: 0.0, 3: 5.0, 4: 5.1}})
    got = A.publish_adjusted(prices, none, str(tmp_path / "t")).orderBy("trade_date").collect()
    assert [r.close_price_raw for r in got] == [10.0, 0.0, 0.0, 5.0, 5.1]
    assert [r.daily_return_raw is None for r in got] == [True, False, True, True, False]
    with pytest.raises(ContractError, match="FINITE_DAILY_RETURN_RAW=2"):
        A.publish_adjusted(panel({"A": {0: 10.0, 1: float("inf"), 2: 5.0, 3: float("nan")}}), none, str(tmp_path / "u"))


def test_undated_rows_are_listed_and_states_without_an_action_stop(spark, tmp_path):
    from brickfolio.operators import health as HE
    from brickfolio.streaming.raw_to_silver import stream_raw_to_silver, undated_rows

    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    rows = spark.createDataFrame([("A", day(0)), ("B", None), ("C", day(1))], "ticker string, trade_date date")
    rows.write.parquet(source)
    out = stream_raw_to_silver(spark, source, rows.schema, lambda df: df, target, str(tmp_path / "mark"))
    assert sorted(r.ticker for r in out.collect()) == ["A", "C"]
    assert [r.ticker for r in undated_rows(spark, f"{target}-raw").collect()] == ["B"]
    states = spark.createDataFrame([("COMPLETE",), ("RECOVERY_BLOCKED",), ("COMPLETE",)], "cycle_state string")
    assert {r.action: r.run_dates for r in HE.action_counts(states).collect()} == {"NO_ACTION": 2, "ALERT_AND_INVESTIGATE": 1}
    with pytest.raises(Exception, match="no action for the state LOST"):
        HE.action_counts(spark.createDataFrame([("LOST",)], "cycle_state string")).collect()


def test_columns_of_one_value_are_neither_shuffled_nor_sorted(spark, tmp_path):
    rows = spark.createDataFrame([(k % 3, f"r{k}", float(k)) for k in range(30)], "p int, a string, b double").withColumns({"v": F.lit("v1"), "n": F.lit(5)})
    fixed = {"v": F.lit("v1"), "n": F.lit(5)}
    for parts in (["p"], []):
        out = P.publish_verified(rows, str(tmp_path / f"ok{len(parts)}"), parts, ["a"], fixed)
        assert sorted(map(str, out.select(rows.columns).collect())) == sorted(map(str, rows.collect()))
    with pytest.raises(ContractError, match="published rows are not the input"):
        P.publish_verified(rows, str(tmp_path / "bad"), ["p"], ["a"], {"v": F.lit("v2")})


def test_a_row_sum_tells_nulls_zeros_and_their_places_apart(spark):
    rows = [(None, "a", 0.0), ("a", None, 0.0), ("a", None, -0.0), ("a", None, None), (None, None, 0.0), ("", None, 0.0), (None, None, float("nan"))]
    sums = {str(spark.createDataFrame([r], "a string, b string, c double").transform(lambda df: df.agg(*P._multiset(df))).first()) for r in rows}
    assert len(sums) == len(rows)
    twice = spark.createDataFrame([rows[0], rows[0], rows[1]], "a string, b string, c double")
    other = spark.createDataFrame([rows[0], rows[1], rows[1]], "a string, b string, c double")
    assert twice.agg(*P._multiset(twice)).first() != other.agg(*P._multiset(other)).first()
