"""Queries of stored tables: partitions from their listing, verified and versioned publication, files with bad records, and contracts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F, types as T

from brickfolio import contracts as C
from brickfolio.operators import diagnostics as DG, discontinuities as D, identity as ID, publish as P, splits as S, training as TR
from brickfolio.operators.versions import VersionLog
from brickfolio.operators.walkforward import fold_metrics, majority_baseline, mean_predictions, summary_record
from brickfolio.plans import raw as RAW, tables as TB
from brickfolio.plans.catalog import register
from brickfolio.plans.oracle_price import price_sql
from brickfolio.plans.pipeline import Pipeline
from brickfolio.plans.queries_identity import identity_sql
from brickfolio.plans.queries_price import CHECK, PANEL_COLUMNS, _METRICS, final, twice
from brickfolio.plans.shape import select_list
from brickfolio.session import scratch_path, write_and_reread
from brickfolio.sources import partitions as PT, stored as ST

_DAY_PARTS = ["year", "month", "day"]


def panel_query(key, build, sql="SELECT * FROM panel"):
    register(key, build, PANEL_COLUMNS, price_sql("daily", f"SELECT {select_list(PANEL_COLUMNS)} FROM ({sql})", "panel"))


# --- partitions ----------------------------------------------------------------------
def _panel_folder(s, d):
    path = scratch_path(s, "panel")
    P.publish_verified(P.with_date_parts(TB.daily_panel(s, d), "trade_date"), path, _DAY_PARTS, ["ticker"])
    return path


panel_query("stored_panel", lambda s, d: PT.read_panel(s, _panel_folder(s, d)))
panel_query("stored_latest", lambda s, d: ST.latest_stored(s, _panel_folder(s, d)), "SELECT * FROM panel WHERE trade_date = (SELECT max(trade_date) FROM panel)")
panel_query("stored_asof", lambda s, d: ST.latest_stored(s, _panel_folder(s, d), date(2024, 1, 15)),
            "SELECT * FROM panel WHERE trade_date = (SELECT max(trade_date) FROM panel WHERE trade_date <= DATE '2024-01-15')")


def _objects(s, d):
    """Orders by source and month; some sources end earlier."""
    path = scratch_path(s, "objects")
    day, source = F.last_day("o_orderdate"), F.substring("o_orderpriority", 1, 1)
    rows = TB.read(s, d, "orders").select(source.alias("source"), day.alias("day"), "o_orderkey")
    early = F.add_months(F.lit(date(1995, 1, 31)), F.col("source").cast("int") * 6)
    rows.filter((F.col("source") == "5") | (F.col("day") <= early)).repartition("source", "day").write.partitionBy("source", "day").parquet(path)
    return ST.latest_objects(s, path, "source", "day", date(1997, 3, 15)).select(F.col("source").cast("string"), "partition_date", (F.col("bytes") > 0).alias("has_bytes"))


register("latest_objects", _objects, "source partition_date has_bytes", """
  SELECT source, max(day) AS partition_date, true AS has_bytes
  FROM (SELECT substr(o_orderpriority, 1, 1) AS source, last_day(CAST(o_orderdate AS DATE)) AS day FROM orders)
  WHERE day <= DATE '1997-03-15' AND (source = '5' OR day <= last_day(DATE '1995-01-31' + to_months(6 * CAST(source AS INT)))) GROUP BY source""")


# --- publication -----------------------------------------------------------------------
def published(key, kind, build, date_column, partition, columns, part, where=""):
    """A stage of the pipeline, published under date parts, verified and read back."""
    cols = [*columns, *partition]
    parts = {"year": f"CAST(year({date_column}) AS INT) AS year", "month": f"CAST(month({date_column}) AS INT) AS month"}

    def run(s, d):
        p = getattr(Pipeline, kind)(s, d)
        rows = P.with_date_parts(build(p), date_column).drop(*[c for c in _DAY_PARTS if c not in partition])
        return P.publish_verified(rows, scratch_path(s, key), partition, [date_column, "ticker"], p.given.get(part))
    register(key, run, cols, price_sql(kind, f"SELECT {', '.join([select_list(list(columns)), *[parts[c] for c in partition]])} FROM {part} {where}", part))


_FN = C.feature_names()
published("publish_features", "daily", lambda p: p.features, "feature_date", ["year", "month"], ["ticker", "feature_date", "feature_ready", *_FN], "features")
published("publish_training", "weekly", lambda p: p.training, "feature_date", ["year", "month"],
          ["ticker", "feature_date", "target_date", "ml_eligible", "target_return_next_5d", *_FN], "training")
published("publish_yearly", "daily", lambda p: p.adjusted, "trade_date", ["year"], ["ticker", "trade_date", "close_price_adjusted"], "adjusted")
published("publish_eligibility", "weekly", lambda p: p.eligibility, "feature_date", [], ["ticker", "feature_date", "target_date", "ml_eligible", "ml_ineligibility_reason"], "eligibility")
published("publish_discontinuities", "daily", lambda p: p.candidates, "event_date", [], ["ticker", "event_date", "daily_return", "classification", "confidence"], "candidates")


def _fold_publication(p):
    """Fold metrics as a table and their summary as a document; both as they are read back."""
    metrics = fold_metrics(mean_predictions(p.universe), majority_baseline(p.universe))
    spark = metrics.sparkSession
    stored = P.publish_verified(metrics, scratch_path(spark, "fold-metrics"), [], ["fold_id", "model"])
    document = P.write_document(summary_record(stored), scratch_path(spark, "fold-summary"))
    one = document.select("fold_count", "test_policy", F.inline(F.transform(F.map_entries("models"), lambda e: F.struct(e["key"].alias("model"), e["value"]["mae_mean"].alias("mae_mean")))))
    # a row per model
    return stored.join(F.broadcast(one), "model")


final("publish_fold_metrics", "weekly", _fold_publication, f"{_METRICS} fold_count test_policy mae_mean", "metrics", f"""
  SELECT *, count(*) OVER () AS fold_count, '{C.HOLDOUT_POLICY}' AS test_policy, avg(mae) OVER () AS mae_mean FROM metrics""")

# --- versions ---------------------------------------------------------------------------
_ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def _history(s, d):
    """A table published again and again: by its content, by its bytes, and by two writers at once."""
    log = VersionLog(s, scratch_path(s, "versions"))
    rows = TB.read(s, d, "orders").select(*_ORDER)
    changed, again = rows.filter("o_orderstatus <> 'P'"), rows.filter("o_orderstatus = 'P'")
    steps = [("1 first", "silver", rows, None, False), ("2 same rows in another order", "silver", rows.orderBy(F.desc("o_orderkey")), None, False),
             ("3 other rows, forced", "silver", changed, None, True), ("4 another table", "raw", rows, "a", False),
             ("5 same bytes", "raw", rows, "a", False), ("6 same rows, packed anew", "raw", rows, "b", False)]
    out = [(name, *log.publish(df, key, raw, force)) for name, key, df, raw, force in steps]
    with ThreadPoolExecutor(2) as pool:
        both = list(pool.map(inheritable_thread_target(s)(lambda _: log.publish(again, "silver", None, True)), range(2)))
    out += [(f"{7 + k} one of two writers", *pair) for k, pair in enumerate(sorted(both))]
    table = s.createDataFrame(out, "step string, action string, version int")
    kept = log.entries().select(F.col("version"), F.col("rows").alias("version_rows"))
    # a row per version on the right
    return table.join(F.broadcast(kept), "version")


register("version_history", _history, "step action version version_rows", """
  SELECT step, action, CAST(version AS INT) AS version, CASE version WHEN 2 THEN changed WHEN 4 THEN again ELSE everything END AS version_rows
  FROM (VALUES ('1 first', 'UPLOAD', 1), ('2 same rows in another order', 'SKIP_IDENTICAL', 1), ('3 other rows, forced', 'NEW_VERSION', 2),
               ('4 another table', 'UPLOAD', 3), ('5 same bytes', 'SKIP_IDENTICAL', 3), ('6 same rows, packed anew', 'SKIP_REPACKAGED', 3),
               ('7 one of two writers', 'NEW_VERSION', 4), ('8 one of two writers', 'SKIP_IDENTICAL', 4)) AS t(step, action, version),
       (SELECT count(*) AS everything, count(*) FILTER (o_orderstatus <> 'P') AS changed, count(*) FILTER (o_orderstatus = 'P') AS again FROM orders)""")

# --- files with bad records ----------------------------------------------------------------
_MAPPING = ["ticker", "cnpj", "fund_name", "category_status", "source"]
_MAPPING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in _MAPPING])


def _mapping_files(s, d):
    """The mapping as delimited files: every eleventh fund lacks a field, another has no ticker."""
    rows = TB.mapping(s, d).withColumn("k", F.regexp_extract("fund_name", "([0-9]+)", 1).cast("int"))
    ticker = F.when(F.col("k") % 11 == 5, "  ").otherwise(F.concat(F.lit(" "), F.lower("ticker")))
    line = F.when(F.col("k") % 11 == 3, F.concat_ws(",", ticker, "cnpj", "fund_name", "category_status")).otherwise(
        F.concat_ws(",", ticker, "cnpj", "fund_name", "category_status", "source"))
    files = RAW.text_files(rows.select(line.alias("line"), F.floor(F.col("k") / 100).alias("part")), "part", ",".join(_MAPPING))
    return ST.read_checked_csv(s, RAW.write_files(files, scratch_path(s, "mapping")), _MAPPING_SCHEMA, key=("ticker", "cnpj"), upper=("ticker",))


_K = "CAST(regexp_extract(fund_name, '([0-9]+)', 1) AS INT) % 11"
register("mapping_csv", lambda s, d: ST.good_records(_mapping_files(s, d)), " ".join(_MAPPING),
         identity_sql(f"SELECT * FROM mapping WHERE {_K} NOT IN (3, 5)", "mapping"))
register("mapping_rejects", lambda s, d: ST.rejected_records(_mapping_files(s, d)).select("fund_name", "cnpj", "reject_reason", F.col("record").isNotNull().alias("has_record")),
         "fund_name cnpj reject_reason has_record", identity_sql(f"""
  SELECT fund_name, cnpj, CASE WHEN {_K} = 3 THEN 'MALFORMED' ELSE 'MISSING_TICKER' END AS reject_reason, {_K} = 3 AS has_record
  FROM mapping WHERE {_K} IN (3, 5)""", "mapping"))
_REGISTRY = [f.name for f in C.REGISTRY_SCHEMA]


def _registry_files(p):
    """The registry as delimited files; by the last digit of the ticker a date or a factor is spoiled."""
    digit = F.substring("ticker", -1, 1)
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _REGISTRY}
    text["event_date"] = F.when(digit == "7", F.lit("31/12/2024")).otherwise(text["event_date"])
    text["price_adjustment_factor"] = F.when(digit == "4", F.lit("0,5")).otherwise(text["price_adjustment_factor"])
    quoted = [F.concat(F.lit('"'), c, F.lit('"')) if n == "price_adjustment_factor" else c for n, c in text.items()]
    lines = p.registry.select(F.concat_ws(",", *quoted).alias("line"), digit.alias("part"))
    s = p.registry.sparkSession
    files = RAW.text_files(lines, "part", ",".join(_REGISTRY))
    return ST.read_checked_csv(s, RAW.write_files(files, scratch_path(s, "registry")), C.REGISTRY_SCHEMA, key=("ticker", "event_date"),
                               upper=("ticker", "review_status", "event_type"))


_DIGIT = "right(ticker, 1)"
final("registry_csv", "daily", lambda p: ST.good_records(_registry_files(p)), _REGISTRY, "registry", f"SELECT * FROM registry WHERE {_DIGIT} NOT IN ('4', '7')")
final("registry_rejects", "daily", lambda p: ST.rejected_records(_registry_files(p)), "ticker reject_reason", "registry",
      f"SELECT ticker, CASE WHEN {_DIGIT} = '4' THEN 'BAD_PRICE_ADJUSTMENT_FACTOR' ELSE 'BAD_EVENT_DATE' END AS reject_reason FROM registry WHERE {_DIGIT} IN ('4', '7')")
_STORED = ["ticker", "event_date", "price_before", "price_after", "daily_return", "classification", "review_status"]
_STORED_SCHEMA = T.StructType([T.StructField(c, T.DateType() if c == "event_date" else T.DoubleType() if c in ("price_before", "price_after", "daily_return")
                                             else T.StringType()) for c in _STORED])


def _stored_candidates(p):
    """The candidate table as stored text columns, some dates and numbers spoiled."""
    digit = F.substring("ticker", -1, 1)
    rows = p.candidates.select(*[F.col(c).cast("string").alias(c) for c in _STORED]).withColumns({
        "event_date": F.when(digit == "2", F.lit("2024-02-30")).otherwise(F.col("event_date")),
        "price_after": F.when(digit == "6", F.lit("n/a")).otherwise(F.col("price_after"))})
    return ST.typed_or_rejected(write_and_reread(rows, "candidates"), _STORED_SCHEMA, ("ticker", "event_date"), ("ticker",))


final("candidates_scan", "daily", lambda p: ST.good_records(_stored_candidates(p)), _STORED, "candidates", f"SELECT * FROM candidates WHERE {_DIGIT} NOT IN ('2', '6')")
final("candidates_rejects", "daily", lambda p: ST.rejected_records(_stored_candidates(p)), "ticker price_before reject_reason", "candidates",
      f"SELECT ticker, price_before, CASE WHEN {_DIGIT} = '2' THEN 'BAD_EVENT_DATE' ELSE 'BAD_PRICE_AFTER' END AS reject_reason FROM candidates WHERE {_DIGIT} IN ('2', '6')")

# --- contracts -----------------------------------------------------------------------------
_SIDES = ["train", "validation", "test"]


def _spoiled_splits(p):
    """The stored splits against the stored training set, with a violation of each rule, by the day of the month."""
    split = write_and_reread(p.sample_split.select("split_name", "ticker", "feature_date", "ml_eligible", "target_return_next_5d"), "splits")
    day = F.day("feature_date")
    split = split.withColumns({
        "ticker": F.when((F.col("split_name") == "train") & (day == 3), F.concat(F.lit("X"), "ticker")).otherwise(F.col("ticker")),
        "ml_eligible": F.col("ml_eligible") & ~((F.col("split_name") == "train") & (day == 5)),
        "target_return_next_5d": F.when((F.col("split_name") == "train") & (day == 7), F.col("target_return_next_5d") + 1e-12).otherwise(F.col("target_return_next_5d"))})
    sides = {n: split.filter(F.col("split_name") == n) for n in _SIDES}
    sides["validation"] = sides["validation"].unionByName(sides["train"].filter(day == 9))
    sides["test"] = sides["test"].unionByName(sides["test"])
    return S.split_contract(sides, p.stored_samples)


_T = "split_name = 'train'"
final("split_contract", "weekly", _spoiled_splits, CHECK, "split", "SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
      + " UNION ALL ".join(f"SELECT '{n}' AS check_name, count(*) AS violations FROM split WHERE {w}" for n, w in {
          "KEY_IN_ONE_SPLIT": f"{_T} AND day(feature_date) = 9", "KEY_ONCE_PER_SPLIT": "split_name = 'test'", "KEY_IN_TRAINING": f"{_T} AND day(feature_date) = 3",
          "ROW_ELIGIBLE": f"{_T} AND day(feature_date) = 5", "TARGET_UNCHANGED": f"{_T} AND day(feature_date) = 7"}.items()) + ")")
final("split_contract_sound", "weekly", lambda p: S.split_contract({n: p.sample_split.filter(F.col("split_name") == n) for n in _SIDES}, p.stored_samples), CHECK, "split",
      "SELECT unnest(['KEY_IN_ONE_SPLIT', 'KEY_ONCE_PER_SPLIT', 'KEY_IN_TRAINING', 'ROW_ELIGIBLE', 'TARGET_UNCHANGED']) AS check_name, CAST(0 AS BIGINT) AS violations, 'PASS' AS status "
      "FROM (SELECT count(*) AS n FROM split) WHERE n > 0")
_EXTREME = ("split_name side position ticker feature_date target_date close_price target_price_next_5d target_pct price_return_pct economic_price_diff_pct")
final("extreme_rows", "weekly", lambda p: DG.extreme_rows(p.split), _EXTREME, "split", " UNION ALL ".join(f"""
  SELECT split_name, '{side}' AS side, CAST(n AS INT) AS position, ticker, feature_date, target_date, close_price, target_price_next_5d, target_return_next_5d * 100 AS target_pct,
         target_price_return_next_5d * 100 AS price_return_pct, target_economic_vs_price_difference * 100 AS economic_price_diff_pct
  FROM (SELECT *, row_number() OVER (PARTITION BY split_name ORDER BY target_return_next_5d {way}, ticker, feature_date) AS n FROM split) WHERE n <= {k}"""
                                                                                                      for side, way, k in (("worst", "", 20), ("best", "DESC", 10))))


def _spoiled_reviewed(p):
    """The reviewed candidates with a violation of each rule, by the last digit of the ticker."""
    digit = F.substring("ticker", -1, 1)
    put = lambda n, c, v: F.when(digit == n, v).otherwise(F.col(c))
    rows = p.reviewed.withColumns({
        "cnpj": put("0", "cnpj", F.lit(None)), "review_status": put("1", "review_status", F.lit("MAYBE")), "event_type": put("2", "event_type", F.lit("MERGER")),
        "is_confirmed_corporate_action": put("3", "is_confirmed_corporate_action", ~F.col("is_confirmed_corporate_action")),
        "daily_return": put("4", "daily_return", F.lit(0.1)),
        "detected_by_v4_threshold": put("5", "detected_by_v4_threshold", F.lit(True)), "newly_visible_in_v5_band": put("5", "newly_visible_in_v5_band", F.lit(True))})
    return D.candidate_checks(rows.unionByName(rows.filter(digit == "6")))


_C_RULES = {
    "REQUIRED_PRESENT": "d = '0'", "STATUS_IN_DOMAIN": "d = '1'", "EVENT_TYPE_IN_DOMAIN": "d = '2'",
    "FLAG_IS_CONFIRMED": "d = '3' OR (d = '1' AND is_confirmed_corporate_action)", "ABOVE_THRESHOLD": "d = '4'", "BANDS_DISJOINT": "d = '5'",
    "NEW_BAND_MATCHES": "(d = '4' AND newly_visible_in_v5_band) OR (d = '5' AND NOT newly_visible_in_v5_band)"}
final("candidate_checks", "daily", _spoiled_reviewed, CHECK, "reviewed", "SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
      + " UNION ALL ".join([*[f"SELECT '{n}' AS check_name, count(*) FILTER ({w}) AS violations FROM twice" for n, w in _C_RULES.items()],
                            "SELECT 'KEY_UNIQUE', count(*) FILTER (d = '6') // 2 FROM twice"]).replace(
          "FROM twice", f"FROM (SELECT *, {_DIGIT} AS d FROM reviewed UNION ALL SELECT *, {_DIGIT} FROM reviewed WHERE {_DIGIT} = '6')") + ")")


def _spoiled_master(s, d):
    rows = TB.price_master(s, d)
    k = F.col("codigo_cvm").cast("int")
    return ID.silver_master_checks(rows.withColumn("cnpj", F.when(k % 10 == 3, F.lit(None)).otherwise(F.col("cnpj"))).unionByName(rows.filter(k % 10 == 4)))


register("silver_master_checks", _spoiled_master, CHECK, """
  SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
    SELECT 'NOT_EMPTY' AS check_name, CAST(count(*) = 0 AS BIGINT) AS violations FROM customer
    UNION ALL SELECT 'ID_PRESENT', count(*) FILTER (c_custkey % 10 = 3) FROM customer
    UNION ALL SELECT 'ID_UNIQUE', count(*) FILTER (c_custkey % 10 = 4) FROM customer)""")


def _spoiled_training(p):
    """The training set with a violation of each rule, by the day of the month."""
    day = F.day("feature_date")
    put = lambda n, c, v: F.when(day == n, v).otherwise(F.col(c))
    y = "target_return_next_5d"
    rows = p.training.withColumns({
        "target_date": put(3, "target_date", F.col("feature_date")), "feature_ready": put(4, "feature_ready", F.lit(False)),
        y: F.when(day == 5, F.lit(float("nan"))).when(day == 6, F.lit(-1.5)).otherwise(F.col(y)),
        "target_global_session_index": put(7, "target_global_session_index", F.col("target_global_session_index") + 1),
        "ml_eligible": put(8, "ml_eligible", ~F.col("ml_eligible")),
        "target_economic_vs_price_difference": put(9, "target_economic_vs_price_difference", F.col("target_economic_vs_price_difference") + 1)})
    return TR.training_checks(twice(rows, day == 10))


_DAYS = {"TICKER_PRESENT": "false", "FEATURE_DATE_PRESENT": "false", "TARGET_DATE_PRESENT": "false", "TARGET_AFTER_FEATURE": "k = 3", "FEATURE_READY": "k = 4", "TARGET_FINITE": "k = 5",
         "TARGET_ABOVE_MINUS_ONE": "k = 6", "HORIZON_EXACT": "k = 7", "ELIGIBLE_IS_CLEAN": "k = 8", "DIFFERENCE_CONSISTENT": "k IN (5, 6, 9)"}
final("training_checks", "weekly", _spoiled_training, CHECK, "training", "SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
      + " UNION ALL ".join([*[f"SELECT '{n}' AS check_name, count(*) FILTER ({w}) AS violations FROM (SELECT day(feature_date) AS k FROM training) " for n, w in _DAYS.items()],
                            "SELECT 'KEY_UNIQUE', count(*) FILTER (day(feature_date) = 10) FROM training"]) + ")")
