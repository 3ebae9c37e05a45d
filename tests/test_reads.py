"""How often queries read their input, and that narrower or fewer reads give the same rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from brickfolio.operators import discontinuities as D, walkforward as WF
from brickfolio.plans.pipeline import KEYS, Pipeline
from brickfolio.plans.queries_price import twice


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def pipeline(spark, panel, registry):
    # the first ticker jumps, the others stay calm
    price = lambda n, k: (100.0 + (n * 7 + k * 13) % 11) * (5 if k == 0 and n % 9 == 4 else 1)
    closes = {f"FD{k}": {n: price(n, k) for n in range(90) if (n + k) % 17} for k in range(4)}
    return Pipeline(panel(closes), registry=lambda c: c.filter("false").select([f.name for f in registry().schema]))


def test_rows_twice_are_read_once(spark):
    rows = spark.createDataFrame([("a", date(2024, 1, 3)), ("b", date(2024, 1, 4)), ("c", None), ("a", date(2024, 1, 3))], "t string, d date")
    condition = F.day("d") == 3
    got = twice(rows, condition)
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.unionByName(rows.filter(condition)).collect()))
    assert got.columns == rows.columns and "Union" not in plan_of(got)


def test_the_queue_is_ordered_from_a_stored_table(pipeline):
    queue = D.review_queue(pipeline.stored_pending)
    assert queue.count() == D.review_queue(pipeline.reviewed).count() > 0
    assert sorted(map(str, queue.collect())) == sorted(map(str, D.review_queue(pipeline.reviewed).collect()))
    assert "Window" not in plan_of(queue)   # the order by ranges looks at its input twice


def test_samples_hold_what_folds_and_splits_read(pipeline):
    assert len(pipeline.stored_samples.columns) < len(pipeline.stored_training.columns) * 2 / 3
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
    assert same(pipeline.sample_split, pipeline.split) and pipeline.sample_split.count() > 0
    whole = WF.pre_test_universe(pipeline.stored_training, pipeline.boundaries)
    assert same(pipeline.universe, whole) and pipeline.universe.count() > 0
    assert same(pipeline.stored_samples.select(*KEYS), pipeline.stored_training)


def test_training_rules_read_the_chain_once(pipeline):
    from brickfolio.plans.queries_stored import _spoiled_training

    checks = _spoiled_training(pipeline)
    plan = plan_of(checks)
    assert "Union" not in plan and plan.count("session_index#") > 0 and "parquet" not in plan
    assert {r.check_name: r.violations > 0 for r in checks.collect()}["KEY_UNIQUE"]


def test_fixed_columns_are_those_of_the_rows(pipeline):
    for stage, fixed in pipeline.fixed.items():
        rows = getattr(pipeline, stage)
        assert len(fixed) > 10 and set(fixed) <= set(rows.columns)
        wrong = rows.withColumns({f"own_{c}": v for c, v in fixed.items()}).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(~F.col(c).eqNullSafe(F.col(f"own_{c}"))).alias(c) for c in fixed])
        found = wrong.first().asDict()
        assert found.pop("rows") > 0 and not any(found.values())
        assert [rows.schema[c].dataType for c in fixed] == [rows.select(v.alias(c)).schema[0].dataType for c, v in fixed.items()]


def test_given_columns_are_those_of_the_rows_and_are_not_stored_or_sorted(pipeline, tmp_path, monkeypatch):
    """Columns that follow from others of a row were stored for the split, and shuffled and sorted with it."""
    from brickfolio.operators import publish as P
    from brickfolio.plans import pipeline as PL

    sorted_by, stored, kind = [], [], type(pipeline.training)
    sort, store = kind.sortWithinPartitions, PL.write_and_reread
    monkeypatch.setattr(kind, "sortWithinPartitions", lambda self, *a: (sorted_by.append(self.columns), sort(self, *a))[1])
    monkeypatch.setattr(PL, "write_and_reread", lambda df, name: (stored.append(df.columns), store(df, name))[1])
    pipeline.__dict__.pop("stored_training", None), pipeline.__dict__.pop("split", None)
    for stage, partition in (("training", "feature_date"), ("split", "split_name")):
        rows, given = getattr(pipeline, stage), pipeline.given[stage]
        names = {c for group in given for c in group}
        assert len(names) > 30 and names <= set(rows.columns)
        out = P.publish_partitioned(rows, str(tmp_path / stage), [partition], ["ticker"], given)
        out = out.select(rows.columns)  # the partition comes last as read
        assert rows.count() == out.count() > 0
        assert out.exceptAll(rows).count() == rows.exceptAll(out).count() == 0
        assert not names & set(sorted_by[-1])
    assert len(stored) == 1 and not {c for group in pipeline.given["training"] for c in group} & set(stored[0])
    assert pipeline.stored_training.columns == pipeline.training.columns
    assert pipeline.stored_training.exceptAll(pipeline.training).count() == 0
