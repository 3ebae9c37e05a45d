"""Drift, outlier and price-jump diagnostics of the training data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brickfolio import contracts as C
from brickfolio.functions import columns as X
from brickfolio.functions.quantiles import exact_quantiles
from brickfolio.operators.walkforward import TARGET

# fixed values: report thresholds and quantile names
FEATURE_QUANTILES = {"p01": .01, "p05": .05, "p25": .25, "median": .5, "p75": .75, "p95": .95, "p99": .99}
TARGET_QUANTILES = {f"q{int(q * 100):02d}": q for q in (.01, .05, .10, .25, .50, .75, .90, .95, .99)}
LOSS_THRESHOLDS = (0.05, 0.10, 0.20, 0.30, 0.50)
GAIN_THRESHOLDS = (0.05, 0.10, 0.20, 0.30, 0.50, 1.00)
TRIM_SIZES = (1, 5, 10, 25, 50, 100)
AUDIT_LOSS = -0.20
LARGE_MOVE = 0.20
CONTEXT_ROWS = 5


def feature_stats(rows: DataFrame, features: list[str], group: str = "split_name") -> DataFrame:
    """Counts, moments and exact quantiles per (split, feature).

    Moments come from one wide aggregate over the rows as they are; only the
    quantiles need the long form.
    """
    good = {c: F.when(X.finite(c), F.col(c)) for c in features}
    wide = rows.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), *[
        F.struct(
            F.count_if(F.col(c).isNull() | F.isnan(c)).alias("nulls"),
            F.count_if(F.col(c).isNotNull() & ~F.isnan(c) & ~X.finite(c)).alias("non_finite"),
            F.count(v).alias("finite_rows"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"), F.max(v).alias("max"),
        ).alias(c) for c, v in good.items()])
    moments = wide.select(group, "rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature_name"), F.col(c).alias("s")) for c in features])).alias("f")
    ).select(group, "f.feature_name", "rows", "f.s.*")
    long = rows.select(group, *[v.alias(c) for c, v in good.items()]).unpivot(
        [group], features, "feature_name", "value")
    return moments.join(exact_quantiles(long, [group, "feature_name"], "value", FEATURE_QUANTILES),
                        [group, "feature_name"], "left")


def smd_class(size: Column) -> Column:
    return (F.when(~X.finite(size), "UNDEFINED").when(size < 0.10, "LOW").when(size < 0.25, "MODERATE")
            .when(size < 0.50, "HIGH").otherwise("VERY_HIGH"))


def feature_drift(stats: DataFrame, group: str = "split_name") -> DataFrame:
    """Train against validation per feature; the input has a few rows per feature."""
    kept = ("mean", "median", "std", "p01", "p99", "nulls")
    side = lambda n: F.max(F.when(F.col(group) == n, F.struct(*kept)))
    both = stats.groupBy("feature_name").agg(side("train").alias("t"), side("validation").alias("v"))
    t, v = F.col("t"), F.col("v")
    pooled = F.sqrt((t["std"] * t["std"] + v["std"] * v["std"]) / 2.0)
    smd = F.when(pooled > 0, (v["mean"] - t["mean"]) / pooled)
    return both.select(
        "feature_name", t["mean"].alias("train_mean"), v["mean"].alias("validation_mean"),
        (v["mean"] - t["mean"]).alias("mean_delta"), t["median"].alias("train_median"),
        v["median"].alias("validation_median"), (v["median"] - t["median"]).alias("median_delta"),
        t["std"].alias("train_std"), v["std"].alias("validation_std"),
        F.when(t["std"] > 0, v["std"] / t["std"]).alias("std_ratio"),
        t["p01"].alias("train_p01"), v["p01"].alias("validation_p01"), t["p99"].alias("train_p99"),
        v["p99"].alias("validation_p99"), t["nulls"].alias("train_nulls"), v["nulls"].alias("validation_nulls"),
        smd.alias("smd"), F.abs(smd).alias("abs_smd"), smd_class(F.abs(smd)).alias("smd_class"))


def target_distribution(rows: DataFrame, target: str = TARGET, group: str = "split_name") -> DataFrame:
    y = F.col(target)
    moments = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"),
        F.min(y).alias("min"), F.max(y).alias("max"))
    return moments.join(exact_quantiles(rows, [group], target, TARGET_QUANTILES), group)


def target_thresholds(rows: DataFrame, target: str = TARGET, group: str = "split_name") -> DataFrame:
    """Loss and gain counts at each threshold, one pass."""
    y = F.col(target)
    tests = [("loss", t, y <= -t) for t in LOSS_THRESHOLDS] + [("gain", t, y >= t) for t in GAIN_THRESHOLDS]
    counts = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(test).alias(f"c{i}") for i, (_, _, test) in enumerate(tests)])
    out = F.array(*[
        F.struct(F.lit(d).alias("direction"), F.lit(t).alias("threshold"), F.col(f"c{i}").alias("sample_count"))
        for i, (d, t, _) in enumerate(tests)])
    return counts.select(group, "n", F.inline(out)).withColumn(
        "share", F.try_divide("sample_count", "n")).drop("n")


def trimmed_mean(rows: DataFrame, target: str = TARGET, sizes=TRIM_SIZES) -> DataFrame:
    """Mean without the N most extreme samples of each direction.

    Only the largest N values of a direction are ordered (a top-N per
    partition, then a merge); the rest enters as a sum and a count.
    """
    y = F.col(target)
    top = max(sizes)
    total = rows.agg(F.sum(y).alias("s"), F.count(y).alias("n"))
    parts = None
    for direction, order in (("negative", y.asc()), ("positive", y.desc()), ("absolute", F.abs(y).desc())):
        extreme = rows.filter(y.isNotNull()).select(target).orderBy(order).limit(top)
        place = F.row_number().over(Window.orderBy(order))  # over ``top`` rows only
        cut = extreme.withColumn("place", place).agg(*[
            F.sum(F.when(F.col("place") <= n, y)).alias(f"cut_{n}") for n in sizes])
        cut = cut.select(F.lit(direction).alias("direction"), F.inline(F.array(*[
            F.struct(F.lit(n).alias("removed"), F.col(f"cut_{n}").alias("cut")) for n in sizes])))
        parts = cut if parts is None else parts.unionByName(cut)
    s, n = total.select("s").scalar(), total.select("n").scalar()
    return parts.withColumns({"s": s, "n": n}).filter(F.col("removed") < F.col("n")).select(
        "direction", "removed", ((F.col("s") - F.col("cut")) / (F.col("n") - F.col("removed"))).alias("trimmed_mean"),
        (F.col("s") / F.col("n")).alias("original_mean"))


def loss_concentration(rows: DataFrame, target: str = TARGET, threshold: float = 0.10, n: int = 20) -> DataFrame:
    """The n tickers with most losses at or below -threshold."""
    losses = rows.filter(F.col(target) <= -threshold)
    per = losses.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("occurrences"), F.avg(target).alias("mean_target"), F.min(target).alias("min_target"),
        F.min("feature_date").alias("first_feature_date"), F.max("feature_date").alias("last_feature_date"))
    total = losses.agg(F.count(F.lit(1))).scalar()
    return per.withColumn("share_of_loss_events", F.col("occurrences") / total).orderBy(
        F.desc("occurrences"), "min_target", "ticker").limit(n)


def ticker_distribution(rows: DataFrame, target: str = TARGET, group: str = "split_name") -> DataFrame:
    """How many tickers have a negative, positive or zero mean target.

    A ticker holds at most one sample per session, so its median is a small group.
    """
    per = rows.groupBy(group, "ticker").agg(
        F.count(F.lit(1)).alias("observations"), F.avg(target).alias("mean_target"),
        F.median(target).alias("median_target"))
    m = F.col("mean_target")
    return per.groupBy(group).agg(
        F.count(F.lit(1)).alias("tickers"), F.count_if(m < 0).alias("negative_mean_tickers"),
        F.count_if(m > 0).alias("positive_mean_tickers"), F.count_if(m == 0).alias("zero_mean_tickers"),
        F.avg("median_target").alias("mean_of_medians"), F.max("observations").alias("max_observations"))


def split_summary(rows: DataFrame, target: str = TARGET, group: str = "split_name") -> DataFrame:
    y = F.col(target)
    rate = lambda test: F.avg(test.cast("double"))
    # tickers first: their distinct count is then a plain count
    per = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("ticker").alias("tickers"), F.avg(y).alias("mean"),
        F.stddev_samp(y).alias("std"), rate(y > 0).alias("positive_rate"),
        *[rate(y <= -t).alias(f"loss_{int(t * 100)}_rate") for t in (0.05, 0.10, 0.20)])
    return per.join(exact_quantiles(rows, [group], target, {"median": .5}), group)


def split_deltas(summary: DataFrame, group: str = "split_name") -> DataFrame:
    """Validation minus train for each summary metric."""
    metrics = ["mean", "median", "std", "positive_rate", "loss_5_rate", "loss_10_rate", "loss_20_rate"]
    long = summary.unpivot([group], metrics, "metric", "value")
    side = lambda n: F.max(F.when(F.col(group) == n, F.col("value")))
    return long.groupBy("metric").agg(
        side("train").alias("train_value"), side("validation").alias("validation_value")).withColumn(
        "delta", F.col("validation_value") - F.col("train_value"))


def audit_samples(rows: DataFrame, focus: list[str], target: str = TARGET) -> DataFrame:
    """Samples of the focus tickers and every sample with a loss of 20 % or more."""
    return rows.filter(F.col("ticker").isin(*focus) | (F.col(target) <= AUDIT_LOSS)).dropDuplicates(
        ["ticker", "feature_date"]).select("ticker", "feature_date", "target_date", target)


def context_window(samples: DataFrame, panel: DataFrame, around: int = CONTEXT_ROWS) -> DataFrame:
    """Rows from ``around`` rows before each sample's period to ``around`` rows after it.

    Positions are per ticker. Each sample finds the position of its first and
    last row inside the period; the frame is then exploded into positions and
    joined by equality, so no pairs outside the frame are ever formed.
    """
    numbered = panel.withColumn(
        "position", F.row_number().over(Window.partitionBy("ticker").orderBy("trade_date")))
    places = numbered.select("ticker", "trade_date", "position")
    # samples lie on price rows: both ends are found by equality
    ends = (
        samples.select("ticker", "feature_date", "target_date")
        .join(places.withColumnsRenamed({"trade_date": "feature_date", "position": "first_row"}), ["ticker", "feature_date"])
        .join(places.withColumnsRenamed({"trade_date": "target_date", "position": "last_row"}), ["ticker", "target_date"])
    )
    wanted = ends.withColumn(
        "position", F.explode(F.sequence(F.col("first_row") - around, F.col("last_row") + around)))
    return wanted.join(numbered, ["ticker", "position"], "inner").withColumn(
        "inside", F.col("position").between(F.col("first_row"), F.col("last_row")))


def sample_paths(samples: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of each sample's ticker between its feature and target date."""
    return context_window(samples, rows, around=0).drop("first_row", "last_row", "inside", "position")


def path_metrics(samples: DataFrame, adjusted: DataFrame) -> DataFrame:
    path = sample_paths(samples, adjusted)
    raw = F.when(X.finite("daily_return_raw"), F.abs("daily_return_raw"))
    economic = F.when(X.finite("daily_return_economic"), F.abs("daily_return_economic"))
    status = F.col("review_status_on_date")
    return path.groupBy("ticker", "feature_date", "target_date").agg(
        F.count(F.lit(1)).alias("path_rows"), F.count_if(raw >= LARGE_MOVE).alias("large_raw_moves"),
        F.count_if(economic >= LARGE_MOVE).alias("large_economic_moves"),
        F.max(raw).alias("max_abs_raw_return"), F.max(economic).alias("max_abs_economic_return"),
        *[F.coalesce(F.bool_or(status == s), F.lit(False)).alias(n) for n, s in (
            ("has_pending", "PENDING_REVIEW"), ("has_confirmed", "CONFIRMED"), ("has_rejected", "REJECTED"))])


def audit_class(metrics: DataFrame) -> DataFrame:
    """What explains a sample's path, the strongest reason first."""
    # fixed values: audit class names
    kind = (
        F.when(F.col("has_pending"), "REVIEW_REQUIRED_PENDING_EVENT")
        .when(F.col("has_confirmed"), "KNOWN_CORPORATE_ACTION")
        .when(F.col("large_economic_moves") > 0, "LARGE_ECONOMIC_MARKET_MOVE")
        .when((F.col("large_raw_moves") > 0) & F.col("has_rejected"), "LARGE_RAW_MOVE_REJECTED_AS_CORPORATE_ACTION")
        .when(F.col("large_raw_moves") > 0, "LARGE_RAW_MOVE_WITHOUT_CONFIRMED_ACTION")
        .otherwise("NO_SINGLE_LARGE_DAILY_MOVE"))
    return metrics.withColumn("audit_class", kind)


def extreme_rows(split: DataFrame, worst: int = 20, best: int = 10, target: str = f"target_return_next_{C.TARGET_HORIZON}d") -> DataFrame:
    """The largest losses and gains of each split, with both returns in percent; equal targets in order of ticker and date.

    Spark keeps only so many rows of a split in each task before it shuffles them.
    """
    kept = split.select("split_name", "ticker", "feature_date", "target_date", "close_price", "target_price_next_5d", F.col(target).alias("target"),
                        "target_price_return_next_5d", "target_economic_vs_price_difference").filter(F.col("target").isNotNull())

    def side(name: str, order: Column, n: int) -> DataFrame:
        at = F.row_number().over(Window.partitionBy("split_name").orderBy(order, "ticker", "feature_date"))
        return kept.withColumn("position", at).filter(F.col("position") <= n).withColumn("side", F.lit(name))
    rows = side("worst", F.asc("target"), worst).unionByName(side("best", F.desc("target"), best))
    return rows.select("split_name", "side", "position", "ticker", "feature_date", "target_date", "close_price", "target_price_next_5d",
                       (F.col("target") * 100).alias("target_pct"), (F.col("target_price_return_next_5d") * 100).alias("price_return_pct"),
                       (F.col("target_economic_vs_price_difference") * 100).alias("economic_price_diff_pct"))
