"""Purged temporal split and its checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.operators.checks import rule_counts

# columns of the training set that the split keeps under names of its own
LINEAGE = [
    "training_dataset_version", "source_feature_version", "source_ml_eligibility_version", "source_price_quality_version",
    "source_price_history_version", "target_horizon", "target_horizon_semantics", "target_return_semantics", "price_semantics",
    "return_semantics", "corporate_action_value_semantics",
]


def eligible_samples(training: DataFrame) -> DataFrame:
    return training.filter(X.flag("ml_eligible"))


def split_boundaries(training: DataFrame, validation_days: int = C.VALIDATION_DAYS,
                     test_days: int = C.TEST_DAYS) -> DataFrame:
    """One row: the first dates of validation and test.

    Days are counted over the distinct feature dates of the eligible samples;
    the unpartitioned window sees at most one row per session. Too few dates for
    all three sides are an error, not an empty side.
    """
    if validation_days <= 0 or test_days <= 0:
        raise C.ContractError("validation and test need at least one day each")
    dates = eligible_samples(training).select("feature_date").distinct().withColumn(
        "from_last", F.row_number().over(Window.orderBy(F.desc("feature_date"))))
    least = validation_days + test_days + 1
    short = F.raise_error(F.concat(F.lit(f"a split needs {least} feature dates, found "), F.count(F.lit(1)).cast("string"))).cast("date")
    at = lambda n: F.when(
        F.count(F.lit(1)) >= least, F.max(F.when(F.col("from_last") == n, F.col("feature_date")))).otherwise(short)
    return dates.agg(
        at(test_days + validation_days).alias("validation_start"), at(test_days).alias("test_start"),
        F.count(F.lit(1)).alias("feature_dates"))


def _region(validation_start, test_start):
    d = F.col("feature_date")
    return F.when(d < validation_start, "train").when(d < test_start, "validation").otherwise("test")


def labelled_samples(training: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Eligible samples with their region and split; purged rows have a null split.

    A row leaves its region when its target date reaches the next region.
    """
    v = boundaries.select("validation_start").scalar()
    t = boundaries.select("test_start").scalar()
    region, target = F.col("split_region"), F.col("target_date")
    kept = (
        ((region == "train") & (target < F.col("validation_start")))
        | ((region == "validation") & (target < F.col("test_start"))) | (region == "test"))
    return (
        eligible_samples(training)
        .withColumns({"validation_start": v, "test_start": t})
        .withColumn("split_region", _region(F.col("validation_start"), F.col("test_start")))
        .withColumn("split_name", F.when(kept, region))
    )


def temporal_split(training: DataFrame, validation_days: int = C.VALIDATION_DAYS,
                   test_days: int = C.TEST_DAYS) -> DataFrame:
    boundaries = split_boundaries(training, validation_days, test_days)
    return labelled_samples(training, boundaries).filter(F.col("split_name").isNotNull()).withColumns(
        given_columns(validation_days, test_days)).drop("split_region")


def given_columns(validation_days: int = C.VALIDATION_DAYS, test_days: int = C.TEST_DAYS) -> dict[str, Column]:
    """The columns of a split that are of one value or repeat one of the training set."""
    return {
        "split_version": F.lit("v3"),
        "validation_days": F.lit(validation_days), "test_days": F.lit(test_days),
        "split_source_training_dataset_version": F.col("training_dataset_version"),
        "split_source_feature_version": F.col("source_feature_version"),
        "split_source_ml_eligibility_version": F.col("source_ml_eligibility_version"),
        "split_source_price_quality_version": F.col("source_price_quality_version"),
        "split_source_price_history_version": F.col("source_price_history_version"),
        "split_requires_ml_eligible": F.lit(True),
        "split_purge_semantics": F.lit(C.PURGE_SEMANTICS),
        "split_target_horizon": F.col("target_horizon"),
        "split_target_horizon_semantics": F.col("target_horizon_semantics"),
        "split_target_return_semantics": F.col("target_return_semantics"),
        "split_price_semantics": F.col("price_semantics"),
        "split_return_semantics": F.col("return_semantics"),
        "split_corporate_action_value_semantics": F.col("corporate_action_value_semantics"),
        "test_holdout_policy": F.lit(C.HOLDOUT_POLICY),
    }


def purge_diagnostics(training: DataFrame, validation_days: int = C.VALIDATION_DAYS,
                      test_days: int = C.TEST_DAYS) -> DataFrame:
    rows = labelled_samples(training, split_boundaries(training, validation_days, test_days))
    region, kept = F.col("split_region"), F.col("split_name").isNotNull()
    names = ("train", "validation", "test")
    return rows.agg(
        F.count(F.lit(1)).alias("eligible_total"),
        *[F.count_if(region == n).alias(f"{n}_region_before_purge") for n in names],
        *[F.count_if((region == n) & ~kept).alias(f"{n}_purged") for n in names],
        F.count_if(~kept).alias("total_purged"), F.count_if(kept).alias("assigned_total"),
    )


def split_overlap(split: DataFrame) -> DataFrame:
    """Keys that occur in more than one split, counted per pair; one aggregate instead of three joins."""
    pairs = [("train", "validation"), ("train", "test"), ("validation", "test")]
    names = sorted({n for p in pairs for n in p})
    per_key = split.groupBy("ticker", "feature_date").agg(*[
        F.max((F.col("split_name") == n).cast("int")).alias(n) for n in names])
    counts = per_key.agg(*[
        F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias(f"{a}_{b}") for a, b in pairs])
    rows = F.array(*[
        F.struct(F.lit(a).alias("left_split"), F.lit(b).alias("right_split"),
                 F.col(f"{a}_{b}").alias("shared_keys")) for a, b in pairs])
    return counts.select(F.inline(rows))


def split_checks(split: DataFrame, dataset: str | None = None) -> DataFrame:
    """Six boundary rules, eligibility, and chronological order of the splits."""
    name, f, t = F.col("split_name"), F.col("feature_date"), F.col("target_date")
    v, s = F.col("validation_start"), F.col("test_start")
    rules = {
        "TRAIN_FEATURE_BEFORE_VALIDATION": (name == "train") & (f >= v),
        "TRAIN_TARGET_BEFORE_VALIDATION": (name == "train") & (t >= v),
        "VALIDATION_FEATURE_NOT_EARLY": (name == "validation") & (f < v),
        "VALIDATION_FEATURE_BEFORE_TEST": (name == "validation") & (f >= s),
        "VALIDATION_TARGET_BEFORE_TEST": (name == "validation") & (t >= s),
        "TEST_FEATURE_NOT_EARLY": (name == "test") & (f < s),
        "ROWS_ELIGIBLE": ~X.flag("ml_eligible"),
    }
    return rule_counts(split, rules, key=("ticker", "feature_date"), dataset=dataset)


def chronological_order(split: DataFrame) -> DataFrame:
    """Date ranges per split and whether each starts after the targets of the one before."""
    order = F.when(F.col("split_name") == "train", 1).when(F.col("split_name") == "validation", 2).otherwise(3)
    ranges = split.groupBy("split_name").agg(
        F.count(F.lit(1)).alias("sample_rows"), F.min("feature_date").alias("first_feature_date"),
        F.max("feature_date").alias("last_feature_date"), F.max("target_date").alias("last_target_date"))
    before = F.lag("last_target_date").over(Window.orderBy("position"))
    return ranges.withColumn("position", order).withColumn(
        "starts_after_previous_targets", F.coalesce(F.col("first_feature_date") > before, F.lit(True)))


def split_contract(splits: dict[str, DataFrame], training: DataFrame, target: str = f"target_return_next_{C.TARGET_HORIZON}d") -> DataFrame:
    """The stored splits against the stored training set, as multisets of keys and of the targets' bits.

    One union and one grouping: per key the rows of each split and of the eligible training set, with their targets' bits.
    """
    bits = F.col(target).cast("double").cast("string")   # the shortest text of a double names one value; -0.0 and 0.0 differ
    columns = ["ticker", "feature_date"]
    own = training.select(*columns, bits.alias("bits"), F.lit("training").alias("side"), X.flag("ml_eligible").alias("eligible"))
    rows = own
    for name, df in splits.items():
        rows = rows.unionByName(df.select(*columns, bits.alias("bits"), F.lit(name).alias("side"), X.flag("ml_eligible").alias("eligible")))
    n = {name: F.count_if(F.col("side") == name) for name in splits}
    in_splits = F.col("side") != "training"
    per_key = rows.groupBy(*columns).agg(
        *[n[name].alias(f"n_{name}") for name in splits], F.count_if(~in_splits).alias("n_training"),
        F.count_if(~in_splits & F.col("eligible")).alias("n_eligible"), F.count_if(in_splits & ~F.col("eligible")).alias("n_ineligible"),
        F.array_sort(F.collect_set(F.when(in_splits, F.coalesce("bits", F.lit("null"))))).alias("split_bits"),
        F.array_sort(F.collect_set(F.when(~in_splits, F.coalesce("bits", F.lit("null"))))).alias("training_bits"))
    used = sum((F.when(F.col(f"n_{name}") > 0, 1).otherwise(0) for name in splits), F.lit(0))
    total = sum((F.col(f"n_{name}") for name in splits), F.lit(0))
    rules = {
        "KEY_IN_ONE_SPLIT": used > 1, "KEY_ONCE_PER_SPLIT": F.greatest(*[F.col(f"n_{name}") for name in splits]) > 1,
        "KEY_IN_TRAINING": (total > 0) & (F.col("n_training") == 0), "ROW_ELIGIBLE": (F.col("n_ineligible") > 0) | ((total > 0) & (F.col("n_training") > 0) & (F.col("n_eligible") == 0)),
        "TARGET_UNCHANGED": (total > 0) & (F.col("n_training") > 0) & (F.size(F.array_except("split_bits", "training_bits")) > 0),
    }
    return rule_counts(per_key, rules)
