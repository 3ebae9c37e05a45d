"""Queries of the models: folds and split, their records, rankings and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from brickfolio import contracts as C
from brickfolio.operators import foldmodels as FM, walkforward as WF
from brickfolio.plans.catalog import register
from brickfolio.plans.oracle_price import BOTH_MODELS, SCORES, linear_sql
from brickfolio.plans.pipeline import Pipeline
from brickfolio.plans.queries_price import CHECK, _BASE, _METRICS, _SUMMARY, _SUMMARY_COLUMNS
from brickfolio.plans.shape import select_list
from brickfolio.session import write_and_reread

_FN = C.feature_names()
_SOURCE_COLUMNS = f"ticker, feature_date, target_return_next_5d AS y, {', '.join(_FN)}"
_FOLD_SOURCE = f"SELECT fold_id AS grp, role, {_SOURCE_COLUMNS} FROM members"
_SPLIT_SOURCE = f"SELECT 1 AS grp, split_name AS role, {_SOURCE_COLUMNS} FROM split WHERE split_name IN ('train', 'validation')"
_FOLD_METRICS = f"""
  SELECT s.*, j.majority_direction, j.majority_directional_accuracy, s.directional_accuracy - j.majority_directional_accuracy AS directional_lift
  FROM (SELECT grp AS fold_id, model, {SCORES} FROM {BOTH_MODELS} GROUP BY grp, model) s JOIN majority j USING (fold_id)"""


def of_folds(key, build, columns, sql):
    cols = columns.split() if isinstance(columns, str) else list(columns)
    register(key, lambda s, d: build(Pipeline.weekly(s, d)), cols,
             linear_sql("weekly", "majority", _FOLD_SOURCE, f"SELECT {select_list(cols)} FROM ({sql})"))


def of_split(key, build, columns, sql):
    cols = columns.split() if isinstance(columns, str) else list(columns)
    register(key, lambda s, d: build(Pipeline.weekly(s, d)), cols,
             linear_sql("weekly", "split", _SPLIT_SOURCE, f"SELECT {select_list(cols)} FROM ({sql})"))


def _fold_metrics(p):
    return WF.fold_metrics(FM.fold_predictions(p.universe), WF.majority_baseline(p.universe))


def _split_predictions(p):
    return FM.linear_predictions(FM.split_roles(p.sample_split), _FN, 1)


# --- folds -----------------------------------------------------------------------
of_folds("walk_forward_fit", _fold_metrics, _METRICS, _FOLD_METRICS)
of_folds("walk_forward_summary", lambda p: WF.model_summary(_fold_metrics(p)), _SUMMARY_COLUMNS, _SUMMARY.replace("FROM metrics", f"FROM ({_FOLD_METRICS})"))
of_folds("best_models", lambda p: WF.best_models(WF.model_summary(_fold_metrics(p))), "criterion model score", " UNION ALL ".join(
    f"SELECT '{name}' AS criterion, arg_min(model, ({'' if way == 'min' else '-'}{col}, model)) AS model, {way}({col}) AS score "
    f"FROM ({_SUMMARY.replace('FROM metrics', f'FROM ({_FOLD_METRICS})')})" for name, (col, way) in WF.BEST.items()))
_FILLED = " + ".join(f"({c} IS NULL OR isnan({c}))::BIGINT" for c in _FN)
_SIDE = lambda r: (
    f"min(feature_date) FILTER (role = '{r}') AS {r}_start, max(feature_date) FILTER (role = '{r}') AS {r}_end, count(*) FILTER (role = '{r}') AS {r}_rows, "
    f"count(DISTINCT ticker) FILTER (role = '{r}') AS {r}_tickers, count(DISTINCT feature_date) FILTER (role = '{r}') AS {r}_feature_dates, "
    f"CAST(sum({_FILLED}) FILTER (role = '{r}') AS BIGINT) AS {r}_nan_count, avg(target_return_next_5d) FILTER (role = '{r}') AS {r}_target_mean, "
    f"median(target_return_next_5d) FILTER (role = '{r}') AS {r}_target_median, avg((target_return_next_5d > 0)::INT) FILTER (role = '{r}') AS {r}_positive_share")
of_folds("fold_records", lambda p: WF.fold_records(p.universe, _fold_metrics(p)), WF.FOLD_RECORD, f"""
  SELECT *, '{C.WALK_FORWARD_VERSION}' AS walk_forward_version, {C.FOLD_SESSIONS} AS validation_feature_sessions
  FROM ({_FOLD_METRICS}) JOIN (
    SELECT fold_id, max(target_date) FILTER (role = 'train') AS train_target_max, min(target_date) FILTER (role = 'validation') AS validation_target_min,
           max(target_date) FILTER (role = 'validation') AS validation_target_max, {_SIDE('train')}, {_SIDE('validation')} FROM members GROUP BY fold_id)
  USING (fold_id)""")


def _contract(p):
    """The records and their summary, and the same with one fold left out of the records."""
    metrics = write_and_reread(_fold_metrics(p), "fold-metrics")
    records = WF.fold_records(p.universe, metrics)
    summary = WF.summary_record(metrics)
    spoiled = records.filter("fold_id <> 12 or model <> 'dummy_mean'").withColumn("walk_forward_version", F.when(F.col("fold_id") > 1, F.col("walk_forward_version")).otherwise("v0"))
    return WF.summary_contract(records, summary).withColumn("variant", F.lit("sound")).unionByName(
        WF.summary_contract(spoiled, summary).withColumn("variant", F.lit("spoiled")))


of_folds("summary_contract", _contract, f"variant {CHECK}", """
  SELECT variant, check_name, CAST(variant = 'spoiled' AND check_name IN ('VERSION_MATCHES', 'RECORD_PER_FOLD_AND_MODEL') AS BIGINT) AS violations,
         CASE WHEN variant = 'spoiled' AND check_name IN ('VERSION_MATCHES', 'RECORD_PER_FOLD_AND_MODEL') THEN 'FAIL' ELSE 'PASS' END AS status
  FROM (SELECT unnest(['sound', 'spoiled']) AS variant) CROSS JOIN (
    SELECT unnest(['VERSION_MATCHES', 'FOLD_COUNT_MATCHES', 'MODELS_MATCH', 'RECORD_PER_FOLD_AND_MODEL', 'TEST_UNTOUCHED']) AS check_name)
  WHERE (SELECT count(*) FROM linear) > 0""")
# a forest has no SQL; the tests hold its trees against exhaustive search
register("walk_forward_forest", lambda s, d: (lambda p: WF.fold_metrics(
    FM.forest_predictions(p.universe), WF.majority_baseline(p.universe)))(Pipeline.weekly(s, d)), _METRICS)

# --- split -----------------------------------------------------------------------
of_split("baseline_fit", lambda p: WF.baseline_metrics(_split_predictions(p), WF.split_majority(p.sample_split)), _BASE, f"""
  SELECT *, directional_accuracy - (
            SELECT CASE WHEN a > 1 - a THEN b ELSE 1 - b END FROM (
              SELECT avg((target_return_next_5d > 0)::INT) FILTER (split_name = 'train') AS a,
                     avg((target_return_next_5d > 0)::INT) FILTER (split_name = 'validation') AS b FROM split)) AS directional_lift
  FROM (SELECT model, {SCORES} FROM {BOTH_MODELS} GROUP BY model)""")


def _split_forest(p):
    return FM.forest(FM.split_roles(p.sample_split), _FN, 1, larger=True)


register("forest_fit", lambda s, d: (lambda p: WF.baseline_metrics(
    _split_forest(p)[0].drop("fold_id"), WF.split_majority(p.sample_split)))(Pipeline.weekly(s, d)), _BASE)
register("feature_importance", lambda s, d: _split_forest(Pipeline.weekly(s, d))[1].orderBy(F.desc("importance"), "feature_name"), "feature_name importance")
_PROFILE = (["model", "rows", "min", "max"] + [f"abs_ge_{int(t * 100)}_pct" for t in WF.PREDICTION_THRESHOLDS] + ["p01", "p05", "median", "p95", "p99"])
of_split("prediction_profile", lambda p: WF.prediction_profile(_split_predictions(p)), _PROFILE,
         "SELECT model, count(*) AS rows, min(prediction) AS min, max(prediction) AS max, " + ", ".join(
             f"count(*) FILTER (abs(prediction) >= {t}) AS abs_ge_{int(t * 100)}_pct" for t in WF.PREDICTION_THRESHOLDS)
         + ", quantile_cont(prediction, 0.01) AS p01, quantile_cont(prediction, 0.05) AS p05, median(prediction) AS median, "
           f"quantile_cont(prediction, 0.95) AS p95, quantile_cont(prediction, 0.99) AS p99 FROM {BOTH_MODELS} GROUP BY model")
of_split("top_errors", lambda p: WF.top_errors(_split_predictions(p).filter("model = 'linear_regression'")),
         "model ticker feature_date target_return_next_5d prediction absolute_error", f"""
  SELECT *, y AS target_return_next_5d, abs(prediction - y) AS absolute_error FROM {BOTH_MODELS} WHERE model = 'linear_regression'
  ORDER BY abs(prediction - y) DESC, ticker, feature_date LIMIT 20""")
