"""Walk-forward folds, baselines and model evaluation."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.functions.quantiles import exact_quantiles
from brickfolio.operators.checks import rule_counts
from brickfolio.session import write_and_reread

TARGET = f"target_return_next_{C.TARGET_HORIZON}d"


def pre_test_universe(training: DataFrame, boundaries: DataFrame) -> DataFrame:
    start = boundaries.select("test_start").scalar()
    return training.filter(X.flag("ml_eligible") & X.flag("feature_ready")).withColumn("test_start", start).filter(
        (F.col("feature_date") < F.col("test_start")) & (F.col("target_date") < F.col("test_start"))
    ).drop("test_start")


def fold_dates(universe: DataFrame, folds: int = C.FOLDS, sessions: int = C.FOLD_SESSIONS) -> DataFrame:
    """(fold_id, validation date) for the last ``folds * sessions`` feature dates.

    One row per session goes into the unpartitioned window.
    """
    pool = folds * sessions
    ranked = universe.select("feature_date").distinct().withColumn(
        "from_last", F.row_number().over(Window.orderBy(F.desc("feature_date"))))
    fold = F.floor((F.lit(pool) - F.col("from_last")) / F.lit(sessions)).cast("int") + 1
    return ranked.filter(F.col("from_last") <= pool).select("feature_date", fold.alias("fold_id"))


def fold_table(universe: DataFrame, folds: int = C.FOLDS, sessions: int = C.FOLD_SESSIONS) -> DataFrame:
    return fold_dates(universe, folds, sessions).groupBy("fold_id").agg(
        F.min("feature_date").alias("validation_start"), F.max("feature_date").alias("validation_end"),
        F.count(F.lit(1)).cast("int").alias("validation_sessions"))


def fold_starts(table: DataFrame) -> Column:
    """The fold table as one array value, used inside expressions instead of a join."""
    return table.agg(F.array_sort(F.collect_list(F.struct("fold_id", "validation_start")))).scalar()


def train_folds(target_date: str, starts: str = "fold_starts") -> Column:
    """Folds whose training set holds a row: its target lies before the fold starts.

    The feature date is always earlier than the target date, so the target decides.
    """
    return F.transform(
        F.filter(starts, lambda s: F.col(target_date) < s["validation_start"]), lambda s: s["fold_id"])


def fold_members(universe: DataFrame, folds: int = C.FOLDS, sessions: int = C.FOLD_SESSIONS) -> DataFrame:
    """Rows of every fold with role train or validation."""
    dates = fold_dates(universe, folds, sessions)
    starts = fold_starts(fold_table(universe, folds, sessions))
    train = universe.withColumn("fold_starts", starts).select(
        F.explode(train_folds("target_date")).alias("fold_id"), F.lit("train").alias("role"),
        "ticker", "feature_date", "target_date")
    # at most one row per session on the fold side
    validation = universe.join(F.broadcast(dates), "feature_date").select(
        "fold_id", F.lit("validation").alias("role"), "ticker", "feature_date", "target_date")
    return train.unionByName(validation)


def walk_forward_folds(universe: DataFrame, folds: int = C.FOLDS, sessions: int = C.FOLD_SESSIONS) -> DataFrame:
    """Size and date range of both sides of each fold.

    Training sets grow with the fold, so the rows are first summed per date and
    the tickers by their earliest target; only those small tables are expanded.
    """
    dates = fold_dates(universe, folds, sessions)
    starts = fold_starts(fold_table(universe, folds, sessions))
    per_day = universe.groupBy("feature_date", "target_date").agg(F.count(F.lit(1)).alias("n"))
    train = per_day.withColumn("fold_starts", starts).withColumn(
        "fold_id", F.explode(train_folds("target_date"))).groupBy("fold_id").agg(
        F.sum("n").alias("train_rows"), F.countDistinct("feature_date").alias("train_feature_dates"),
        F.min("feature_date").alias("train_start"), F.max("feature_date").alias("train_end"),
        F.max("target_date").alias("train_target_max"))
    tickers = universe.groupBy("ticker").agg(F.min("target_date").alias("first_target")).withColumn(
        "fold_starts", starts).withColumn("fold_id", F.explode(train_folds("first_target"))).groupBy(
        "fold_id").agg(F.count(F.lit(1)).alias("train_tickers"))
    held = universe.join(F.broadcast(dates), "feature_date").groupBy("fold_id", "ticker").agg(
        F.count(F.lit(1)).alias("n"), F.min("feature_date").alias("f0"), F.max("feature_date").alias("f1"),
        F.min("target_date").alias("t0"), F.max("target_date").alias("t1"))
    validation = held.groupBy("fold_id").agg(
        F.sum("n").alias("validation_rows"), F.count(F.lit(1)).alias("validation_tickers"),
        F.min("f0").alias("validation_start"), F.max("f1").alias("validation_end"),
        F.min("t0").alias("validation_target_min"), F.max("t1").alias("validation_target_max"))
    counts = dates.groupBy("fold_id").agg(F.count(F.lit(1)).alias("validation_feature_dates"))
    return (
        validation.join(train, "fold_id", "left").join(tickers, "fold_id", "left").join(counts, "fold_id")
        .withColumns({
            "purged": F.col("train_target_max") < F.col("validation_start"),
            "enough_history": F.col("train_feature_dates") >= C.MIN_TRAIN_SESSIONS,
        })
    )


def target_profile(universe: DataFrame, folds: int = C.FOLDS, sessions: int = C.FOLD_SESSIONS) -> DataFrame:
    """Mean, median and share of positive targets on both sides of each fold."""
    dates = fold_dates(universe, folds, sessions)
    starts = fold_starts(fold_table(universe, folds, sessions))
    y = F.col(TARGET)
    # equal targets of one day are one row before the folds are expanded
    counted = universe.groupBy("target_date", y.alias("y")).agg(F.count(F.lit(1)).alias("n"))
    train = counted.withColumn("fold_starts", starts).select(
        F.explode(train_folds("target_date")).alias("fold_id"), F.lit("train").alias("role"), "y", "n")
    held = universe.join(F.broadcast(dates), "feature_date").groupBy("fold_id", y.alias("y")).agg(
        F.count(F.lit(1)).alias("n")).select("fold_id", F.lit("validation").alias("role"), "y", "n")
    both = train.unionByName(held)
    group = ["fold_id", "role"]
    sums = both.groupBy(*group).agg(
        (F.sum(F.col("y") * F.col("n")) / F.sum("n")).alias("target_mean"),
        (F.sum(F.when(F.col("y") > 0, F.col("n")).otherwise(0)) / F.sum("n")).alias("positive_share"))
    return sums.join(exact_quantiles(both, group, "y", {"target_median": 0.5}, weight="n"), group)


def majority_baseline(universe: DataFrame, folds: int = C.FOLDS, sessions: int = C.FOLD_SESSIONS) -> DataFrame:
    """Direction learned on the training side (positive only above one half) and its accuracy."""
    dates = fold_dates(universe, folds, sessions)
    starts = fold_starts(fold_table(universe, folds, sessions))
    up = (F.col(TARGET) > 0).cast("bigint")
    train = universe.groupBy("target_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(up).alias("up"), F.sum(TARGET).alias("y")
    ).withColumn("fold_starts", starts).withColumn("fold_id", F.explode(train_folds("target_date"))).groupBy(
        "fold_id").agg((F.sum("up") / F.sum("n")).alias("train_positive_share"),
                       (F.sum("y") / F.sum("n")).alias("train_target_mean"))
    held = universe.join(F.broadcast(dates), "feature_date").groupBy("fold_id").agg(
        F.avg(up).alias("validation_positive_share"), F.count(F.lit(1)).alias("validation_rows"))
    positive = F.col("train_positive_share") > 0.5
    return held.join(train, "fold_id").withColumns({
        "majority_direction": F.when(positive, "POSITIVE").otherwise("NON_POSITIVE"),
        "majority_directional_accuracy": F.when(positive, F.col("validation_positive_share"))
        .otherwise(1.0 - F.col("validation_positive_share")),
    })


def mean_predictions(universe: DataFrame, folds: int = C.FOLDS, sessions: int = C.FOLD_SESSIONS) -> DataFrame:
    """Predictions of the mean baseline for every validation row."""
    dates = fold_dates(universe, folds, sessions)
    means = majority_baseline(universe, folds, sessions).select("fold_id", F.col("train_target_mean").alias("prediction"))
    # both small sides have at most one row per session or fold
    return universe.join(F.broadcast(dates), "feature_date").join(F.broadcast(means), "fold_id").select(
        "fold_id", F.lit("dummy_mean").alias("model"), "ticker", "feature_date", TARGET, "prediction")


# --- metrics ----------------------------------------------------------------

def regression_metrics(predictions: DataFrame, group: list[str], target: str = TARGET) -> DataFrame:
    """MAE, RMSE, R2 and directional accuracy as one partial aggregate."""
    y, p = F.col(target), F.col("prediction")
    error = y - p
    spread = F.var_pop(y) * F.count(y)
    return predictions.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1.0 - F.try_divide(F.sum(error * error), spread)).alias("r2"),
        F.avg(((y > 0) == (p > 0)).cast("double")).alias("directional_accuracy"),
        F.avg(p).alias("prediction_mean"), F.min(p).alias("prediction_min"), F.max(p).alias("prediction_max"))


def fold_metrics(predictions: DataFrame, majority: DataFrame) -> DataFrame:
    """Per (fold, model) metrics with the lift over the majority direction."""
    group = ["fold_id", "model"]
    medians = exact_quantiles(predictions, group, "prediction", {"prediction_median": 0.5})
    base = majority.select("fold_id", "majority_direction", "majority_directional_accuracy")
    return regression_metrics(predictions, group).join(medians, group).join(base, "fold_id").withColumn(
        "directional_lift", F.col("directional_accuracy") - F.col("majority_directional_accuracy"))


def model_summary(metrics: DataFrame) -> DataFrame:
    """Per model over the folds; deviations are population deviations."""
    out = [F.count(F.lit(1)).alias("folds")]
    for m in ("mae", "rmse", "r2", "directional_accuracy", "directional_lift"):
        out += [F.avg(m).alias(f"{m}_mean"), F.median(m).alias(f"{m}_median")]
    out += [F.stddev_pop(m).alias(f"{m}_std") for m in ("mae", "rmse")]
    for m in ("directional_lift", "r2"):
        out += [F.count_if(F.col(m) > 0).alias(f"positive_{m}_folds"),
                F.count_if(F.col(m) <= 0).alias(f"non_positive_{m}_folds")]
    return metrics.groupBy("model").agg(*out)


# fixed values: selection criteria and the summary column each one reads
BEST = {
    "best_mean_mae": ("mae_mean", "min"), "best_mean_rmse": ("rmse_mean", "min"), "best_mean_r2": ("r2_mean", "max"),
    "best_mean_directional_accuracy": ("directional_accuracy_mean", "max"),
    "best_mean_directional_lift": ("directional_lift_mean", "max"),
}


def best_models(summary: DataFrame) -> DataFrame:
    """Best model per criterion; equal scores go to the first model by name."""
    picks = []
    for name, (column, way) in BEST.items():
        score = F.col(column) if way == "min" else -F.col(column)
        picks.append(F.min(F.struct(score.alias("score"), F.col("model").alias("model"))).alias(name))
    row = summary.agg(*picks)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("criterion"), F.col(n)["model"].alias("model"),
                 (F.col(n)["score"] if BEST[n][1] == "min" else -F.col(n)["score"]).alias("score"))
        for n in BEST])))


# --- models -----------------------------------------------------------------

def model_pipeline(name: str, features: list[str], target: str = TARGET, trees: int = C.FOREST_TREES,
                   depth: int = 30, seed: int = C.SEED) -> Pipeline:
    """Thirty is the deepest tree that Spark grows; its splits end earlier where a node is pure."""
    filled = [f"{c}_filled" for c in features]
    impute = Imputer(inputCols=features, outputCols=filled, strategy="median", relativeError=0.0005)
    assemble = VectorAssembler(inputCols=filled, outputCol="assembled")
    if name == "linear_regression":
        scale = StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True)
        fit = LinearRegression(featuresCol="scaled", labelCol=target, solver="normal", regParam=0.0)
        return Pipeline(stages=[impute, assemble, scale, fit])
    if name == "random_forest":
        fit = RandomForestRegressor(
            featuresCol="assembled", labelCol=target, numTrees=trees, maxDepth=depth, seed=seed,
            featureSubsetStrategy="all", maxMemoryInMB=1024)
        return Pipeline(stages=[impute, assemble, fit])
    raise ValueError(name)


def fit_predict(train: DataFrame, held: DataFrame, name: str, features: list[str], **options) -> tuple[PipelineModel, DataFrame]:
    model = model_pipeline(name, features, **options).fit(train)
    out = model.transform(held).select("ticker", "feature_date", TARGET, "prediction")
    return model, out.withColumn("model", F.lit(name))


def absent_inputs(universe: DataFrame, features: list[str], folds: int = C.FOLDS, sessions: int = C.FOLD_SESSIONS) -> DataFrame:
    """Absent values among the inputs of both sides of each fold; counted per date before the folds are expanded."""
    absent = sum((F.when(F.col(c).isNull() | F.isnan(c), 1).otherwise(0) for c in features), F.lit(0)).cast("bigint")
    starts = fold_starts(fold_table(universe, folds, sessions))
    train = universe.groupBy("target_date").agg(F.sum(absent).alias("n")).withColumn("fold_starts", starts).withColumn(
        "fold_id", F.explode(train_folds("target_date"))).groupBy("fold_id").agg(F.sum("n").alias("train_nan_count"))
    held = universe.join(F.broadcast(fold_dates(universe, folds, sessions)), "feature_date").groupBy("fold_id").agg(
        F.sum(absent).alias("validation_nan_count"))
    return held.join(train, "fold_id", "left")


def fold_records(universe: DataFrame, metrics: DataFrame, folds: int = C.FOLDS, sessions: int = C.FOLD_SESSIONS) -> DataFrame:
    """The full record of each fold and model: dates, sizes, absent values, targets of both sides, majority and metrics."""
    sides = target_profile(universe, folds, sessions).groupBy("fold_id").agg(*[
        F.max(F.when(F.col("role") == r, F.col(c))).alias(f"{r}_{n}") for r in ("train", "validation")
        for c, n in (("target_mean", "target_mean"), ("target_median", "target_median"), ("positive_share", "positive_share"))])
    shape = walk_forward_folds(universe, folds, sessions).drop("purged", "enough_history")
    # a row per fold on each side
    return metrics.join(shape, "fold_id").join(sides, "fold_id").join(absent_inputs(universe, C.feature_names(), folds, sessions), "fold_id").withColumns({
        "walk_forward_version": F.lit(C.WALK_FORWARD_VERSION), "validation_feature_sessions": F.lit(sessions)}).select(*FOLD_RECORD)


# fixed values: the columns of a fold record
FOLD_RECORD = [
    "walk_forward_version", "fold_id", "model", "validation_feature_sessions", "train_start", "train_end", "train_target_max",
    "validation_start", "validation_end", "validation_target_min", "validation_target_max", "train_rows", "validation_rows",
    "train_tickers", "validation_tickers", "train_feature_dates", "validation_feature_dates", "train_nan_count", "validation_nan_count",
    "train_target_mean", "train_target_median", "validation_target_mean", "validation_target_median", "train_positive_share",
    "validation_positive_share", "majority_direction", "majority_directional_accuracy", "mae", "rmse", "r2", "directional_accuracy",
    "directional_lift", "prediction_mean", "prediction_median", "prediction_min", "prediction_max",
]


def summary_record(metrics: DataFrame) -> DataFrame:
    """The summary of a walk-forward run as one row that is written as JSON: versions, folds, use of the test split, and a struct per model."""
    per_model = model_summary(metrics)
    struct = F.struct(*[F.col(c) for c in per_model.columns if c != "model"])
    # a row per model
    models = per_model.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("model"), struct.alias("value"))))).alias("models"))
    return models.withColumns({
        "walk_forward_version": F.lit(C.WALK_FORWARD_VERSION), "fold_count": metrics.agg(F.countDistinct("fold_id")).scalar(),
        "test_policy": F.lit(C.HOLDOUT_POLICY), "test_features_used": F.lit(False), "test_targets_used": F.lit(False),
        "test_predictions_generated": F.lit(False)})


def summary_contract(records: DataFrame, summary: DataFrame) -> DataFrame:
    """Fold records against the summary of the same run: versions, folds, models, and that the test split was left alone."""
    s = summary.select(
        F.col("walk_forward_version").alias("s_version"), F.col("fold_count").alias("s_folds"), F.array_sort(F.map_keys("models")).alias("s_models"),
        (F.coalesce(F.col("test_policy") != C.HOLDOUT_POLICY, F.lit(True)) | F.col("test_features_used") | F.col("test_targets_used")
         | F.col("test_predictions_generated")).alias("s_test"))
    m = records.agg(F.array_sort(F.collect_set("walk_forward_version")).alias("versions"), F.countDistinct("fold_id").alias("folds"),
                    F.array_sort(F.collect_set("model")).alias("models"), F.count(F.lit(1)).alias("n"))
    rules = {
        "VERSION_MATCHES": ~F.col("versions").eqNullSafe(F.array("s_version")), "FOLD_COUNT_MATCHES": ~F.col("folds").eqNullSafe(F.col("s_folds")),
        "MODELS_MATCH": ~F.col("models").eqNullSafe(F.col("s_models")), "RECORD_PER_FOLD_AND_MODEL": F.col("n") != F.col("folds") * F.size("models"),
        "TEST_UNTOUCHED": F.col("s_test"),
    }
    # one row on either side
    return rule_counts(m.crossJoin(F.broadcast(s)), rules)


def walk_forward_predictions(universe: DataFrame, models: list[str], folds: int = C.FOLDS,
                             sessions: int = C.FOLD_SESSIONS, parallelism: int = 4, **options) -> DataFrame:
    """Fit every model on every fold and union the validation predictions.

    The driver loops over folds and models only, a few fits at a time. Each fit
    reads the rows again, so ``universe`` should be a stored table.
    """
    features = C.feature_names()
    rows = universe.select("ticker", "feature_date", "target_date", TARGET, *features)
    bounds = sorted((r.fold_id, r.validation_start, r.validation_end)
                    for r in fold_table(universe, folds, sessions).collect())

    def one(job):
        (fold_id, start, end), name = job
        train = rows.filter(F.col("target_date") < F.lit(start))
        held = rows.filter(F.col("feature_date").between(F.lit(start), F.lit(end)))
        _, predicted = fit_predict(train, held, name, features, **options)
        return predicted.withColumn("fold_id", F.lit(fold_id))

    jobs = [(b, name) for b in bounds for name in models]
    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(inheritable_thread_target(universe.sparkSession)(one), jobs))
    return reduce(DataFrame.unionByName, parts).select(
        "fold_id", "model", "ticker", "feature_date", TARGET, "prediction")


def baseline_predictions(split: DataFrame, models: list[str], **options) -> DataFrame:
    """Fit on the train split, predict validation; the test split stays untouched."""
    features = C.feature_names()
    stored = write_and_reread(
        split.select("split_name", "ticker", "feature_date", TARGET, *features), "baseline")
    train, held = (stored.filter(F.col("split_name") == n) for n in ("train", "validation"))
    parts = []
    for name in models:
        _, predicted = fit_predict(train, held, name, features, **options)
        parts.append(predicted)
    return reduce(DataFrame.unionByName, parts).select("model", "ticker", "feature_date", TARGET, "prediction")


def split_majority(split: DataFrame) -> DataFrame:
    """Majority direction of the train split and its accuracy on validation; one row."""
    up = (F.col(TARGET) > 0).cast("double")
    on = lambda n, v: F.avg(F.when(F.col("split_name") == n, v))
    row = split.agg(on("train", up).alias("positive_rate_train"), on("validation", up).alias("up_validation"),
                    on("train", F.col(TARGET)).alias("train_target_mean"))
    positive = F.col("positive_rate_train") > 1.0 - F.col("positive_rate_train")
    return row.select(
        F.when(positive, "POSITIVE").otherwise("NON_POSITIVE").alias("direction"), "positive_rate_train",
        (1.0 - F.col("positive_rate_train")).alias("non_positive_rate_train"),
        F.when(positive, F.col("positive_rate_train")).otherwise(1.0 - F.col("positive_rate_train"))
        .alias("train_accuracy"),
        F.when(positive, F.col("up_validation")).otherwise(1.0 - F.col("up_validation"))
        .alias("validation_accuracy"), "train_target_mean")


def mean_baseline_predictions(split: DataFrame) -> DataFrame:
    mean = split.filter(F.col("split_name") == "train").agg(F.avg(TARGET)).scalar()
    return split.filter(F.col("split_name") == "validation").select(
        F.lit("dummy_mean").alias("model"), "ticker", "feature_date", TARGET).withColumn("prediction", mean)


def baseline_metrics(predictions: DataFrame, majority: DataFrame) -> DataFrame:
    accuracy = majority.select("validation_accuracy").scalar()
    return regression_metrics(predictions, ["model"]).withColumn(
        "directional_lift", F.col("directional_accuracy") - accuracy)


def feature_importance(split: DataFrame, **options) -> DataFrame:
    """Forest importances, largest first; one row per model input."""
    features = C.feature_names()
    train = write_and_reread(
        split.filter(F.col("split_name") == "train").select(TARGET, *features), "importance")
    model = model_pipeline("random_forest", features, **options).fit(train)
    weights = model.stages[-1].featureImportances.toArray()
    return split.sparkSession.createDataFrame(
        [(n, float(w)) for n, w in zip(features, weights)], "feature_name string, importance double",
    ).orderBy(F.desc("importance"), "feature_name")


# fixed values: thresholds of the prediction report
PREDICTION_THRESHOLDS = (0.05, 0.10, 0.20, 0.50, 1.00)


def prediction_profile(predictions: DataFrame) -> DataFrame:
    """Distribution of predictions per model and how many are large."""
    size = F.abs("prediction")
    stats = predictions.groupBy("model").agg(
        F.count(F.lit(1)).alias("rows"), F.min("prediction").alias("min"), F.max("prediction").alias("max"),
        *[F.count_if(size >= t).alias(f"abs_ge_{int(t * 100)}_pct") for t in PREDICTION_THRESHOLDS])
    shape = exact_quantiles(
        predictions, ["model"], "prediction", {"p01": .01, "p05": .05, "median": .5, "p95": .95, "p99": .99})
    return stats.join(shape, "model")


def top_errors(predictions: DataFrame, n: int = 20) -> DataFrame:
    """The n largest absolute errors (the report is a top-n list)."""
    return predictions.withColumn("absolute_error", F.abs(F.col("prediction") - F.col(TARGET))).orderBy(
        F.desc("absolute_error"), "ticker", "feature_date").limit(n)
