"""Gaps, eligibility, targets, split, folds and quantiles."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brickfolio import contracts as C
from brickfolio.functions.quantiles import exact_quantiles
from brickfolio.operators import (
    adjusted as A, diagnostics as DG, eligibility as EL, features as FE, history as H, quality as Q, splits as S, training as T,
    walkforward as WF,
)
from conftest import day


@pytest.fixture(scope="module")
def chain(panel, registry):
    """Sixty sessions; B misses some of them; A has one open jump that blocks samples."""
    rng = random.Random(7)
    price, a, b, c = 100.0, {}, {}, {}
    for n in range(60):
        price *= 1 + rng.uniform(-0.02, 0.02)
        a[n] = price if n < 52 else price * 3
        c[n] = price * (1 + 0.001 * (n % 7))
        if n % 11 != 5:
            b[n] = price / 2
    p = panel({"A": a, "B": b, "C": c})
    adjusted = A.adjusted_from_registry(p, registry()).cache()
    history = H.price_history(adjusted)
    quality = Q.price_quality(adjusted)
    features = FE.ml_features(history)
    return dict(panel=p, adjusted=adjusted, history=history, quality=quality, features=features,
                training=T.training_from_adjusted(adjusted).cache())


def test_gap_classes_at_their_edges(panel):
    sessions = {n: 1.0 for n in range(60)}
    gaps = {0: 1, 1: 1, 6: 1, 12: 1, 32: 1, 53: 1}      # 1, 5, 6, 20 and 21 sessions
    got = Q.session_gaps(panel({"Z": sessions, "G": gaps})).filter("ticker = 'G'").orderBy("trade_date").collect()
    assert [r.trading_gap_class for r in got] == [
        "UNKNOWN", "CONTIGUOUS", "SHORT_GAP", "MEDIUM_GAP", "MEDIUM_GAP", "LONG_GAP"]


def test_one_pass_equals_the_joined_tables(chain):
    eligibility = EL.ml_eligibility(chain["features"], chain["quality"])
    one_pass = T.eligibility_from_adjusted(chain["adjusted"])
    assert eligibility.exceptAll(one_pass).count() == 0 and one_pass.exceptAll(eligibility).count() == 0
    joined = T.training_dataset(chain["features"], eligibility, chain["history"])
    assert joined.columns == chain["training"].columns
    assert joined.exceptAll(chain["training"]).count() == 0 and joined.count() == chain["training"].count() > 0


def test_target_is_on_the_market_calendar(chain):
    rows = chain["training"].select("ticker", "feature_date", "target_date", "target_return_next_5d").collect()
    closes = {(r.ticker, r.trade_date): r.close_price for r in chain["panel"].collect()}
    assert any(r.ticker == "B" for r in rows)
    for r in rows:
        assert (r.target_date - r.feature_date).days == 5      # every day is a session here
        want = closes[r.ticker, r.target_date] / closes[r.ticker, r.feature_date] - 1
        assert r.target_return_next_5d == pytest.approx(want)


def test_horizon_counts_equal_a_range_join(chain):
    signals = EL.blocking_signals(chain["quality"]).select("ticker", "trade_date", F.col("blocking_signal").cast("int").alias("s"))
    e = T.eligibility_from_adjusted(chain["adjusted"])
    brute = e.alias("e").join(signals.alias("q"), (F.col("e.ticker") == F.col("q.ticker")) & (
        F.col("q.trade_date") > F.col("e.feature_date")) & (F.col("q.trade_date") <= F.col("e.target_date"))).groupBy(
        "e.ticker", "e.feature_date").agg(F.sum("s").alias("n"), F.first("blocking_target_horizon_count").alias("got"))
    assert brute.filter("n <> got").count() == 0
    assert e.filter("not ml_eligible").count() > 0


def test_split_is_purged_and_disjoint(chain):
    split = S.temporal_split(chain["training"], 5, 5)
    assert S.split_checks(split).filter("status = 'FAIL'").count() == 0
    assert {r.shared_keys for r in S.split_overlap(split).collect()} == {0}
    assert all(r.starts_after_previous_targets for r in S.chronological_order(split).filter("split_name <> 'test'").collect())
    (d,) = S.purge_diagnostics(chain["training"], 5, 5).collect()
    assert d.assigned_total == split.count() and d.total_purged == d.train_purged + d.validation_purged > 0
    assert d.test_purged == 0


def test_row_whose_target_is_the_boundary_is_purged(chain):
    split = S.temporal_split(chain["training"], 5, 5)
    first = split.select("validation_start").first()[0]
    assert split.filter(F.col("split_name") == "train").agg(F.max("target_date")).first()[0] < first
    assert chain["training"].filter((F.col("target_date") == F.lit(first)) & F.col("ml_eligible")).count() > 0


def test_contaminated_input_names_are_refused():
    assert len(C.feature_names()) == 18
    assert not any(C.is_forbidden_feature(n) for n in C.feature_names())
    for name in ("target_return_next_5d", "return_5d_pct", "close_price_raw", "ticker", "ml_eligible", "price_semantics"):
        assert C.is_forbidden_feature(name)


@pytest.mark.parametrize("values", [
    [float(v) for v in range(1, 101)], [0.0] * 50 + [1.0] * 25 + [-3.5] * 7, [1e-300, -1e300, 0.0, 5.0], [2.0],
    [random.Random(3).gauss(0, 1) for _ in range(997)],
])
def test_exact_quantiles_equal_numpy(spark, values):
    probs = {"p01": .01, "p25": .25, "median": .5, "p95": .95}
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    (got,) = exact_quantiles(df, [], "v", probs).collect()
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_quantiles_of_values_crowded_around_one(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([1 + rng.uniform(-1e-6, 1e-6, 9900), rng.normal(size=100)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    (got,) = exact_quantiles(df, [], "v", {"a": 0.01, "m": 0.5, "z": 0.999}).collect()
    assert [got.a, got.m, got.z] == pytest.approx(np.quantile(values, [0.01, 0.5, 0.999]), rel=1e-14)


def test_crowded_buckets_are_cut_further(spark, monkeypatch):
    from brickfolio.functions import quantiles

    rng = np.random.default_rng(4)
    values = np.concatenate([1 + rng.uniform(-1e-6, 1e-6, 3000), rng.normal(size=100)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    monkeypatch.setattr(quantiles, "_FEW", 10)
    (got,) = exact_quantiles(df, [], "v", {"a": 0.01, "m": 0.5, "z": 0.999}).collect()
    assert [got.a, got.m, got.z] == pytest.approx(np.quantile(values, [0.01, 0.5, 0.999]), rel=1e-14)


def test_split_of_too_few_dates_is_an_error(spark):
    rows = spark.createDataFrame([(day(n), day(n + 1), True) for n in range(6)], "feature_date date, target_date date, ml_eligible boolean")
    assert S.split_boundaries(rows, 2, 3).first().feature_dates == 6
    with pytest.raises(Exception, match="a split needs 21 feature dates, found 6"):
        S.split_boundaries(rows).collect()


def test_quantiles_with_weights_and_groups(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1), ("b", 5.0, 2), ("b", None, 9)], "g string, v double, n long")
    got = {r.g: r.m for r in exact_quantiles(df, ["g"], "v", {"m": .5}, weight="n").collect()}
    assert got == {"a": 1.0, "b": 5.0}


def test_trimmed_mean_equals_sorting(spark):
    rng = random.Random(1)
    y = [rng.gauss(0, 1) for _ in range(300)]
    got = {(r.direction, r.removed): r.trimmed_mean for r in DG.trimmed_mean(spark.createDataFrame([(v,) for v in y], "y double"), "y").collect()}
    for n in DG.TRIM_SIZES:
        assert got["negative", n] == pytest.approx(np.mean(sorted(y)[n:]))
        assert got["positive", n] == pytest.approx(np.mean(sorted(y)[:-n]))
        assert got["absolute", n] == pytest.approx(np.mean(sorted(y, key=abs)[:-n]))


def test_folds_and_linear_fit(spark):
    rng = np.random.default_rng(5)
    names = C.feature_names()
    rows = []
    for n in range(40):
        for t in range(6):
            x = rng.normal(size=len(names))
            rows.append((f"T{t}", day(n), day(n + 5), float(x[0] * 0.5 - x[3] * 0.2 + rng.normal() * 0.01), *map(float, x)))
    schema = f"ticker string, feature_date date, target_date date, {WF.TARGET} double, " + ", ".join(f"{n} double" for n in names)
    universe = spark.createDataFrame(rows, schema)
    folds = WF.walk_forward_folds(universe, 3, 4).orderBy("fold_id").collect()
    assert [r.fold_id for r in folds] == [1, 2, 3] and all(r.purged for r in folds)
    assert [r.validation_start for r in folds] == [day(28), day(32), day(36)]
    assert [r.train_rows for r in folds] == [6 * 23, 6 * 27, 6 * 31]
    members = WF.fold_members(universe, 3, 4).groupBy("fold_id", "role").count().collect()
    assert {(r.fold_id, r.role): r["count"] for r in members}[2, "train"] == 6 * 27
    got = {(r.ticker, r.feature_date): r.prediction for r in WF.walk_forward_predictions(
        universe, ["linear_regression"], 3, 4).filter("fold_id = 1").collect()}
    train = [r for r in rows if r[2] < day(28)]
    x = np.column_stack([np.ones(len(train)), np.array([r[4:] for r in train])])
    beta, *_ = np.linalg.lstsq(x, np.array([r[3] for r in train]), rcond=None)
    for r in rows:
        if day(28) <= r[1] <= day(31):
            assert got[r[0], r[1]] == pytest.approx(beta[0] + np.dot(beta[1:], r[4:]), abs=1e-6)
