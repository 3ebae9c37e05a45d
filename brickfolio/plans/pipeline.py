"""The stages of the price pipeline, wired together lazily for one panel."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from brickfolio import contracts as C
from brickfolio.operators import (
    adjusted, calendar, discontinuities, eligibility, features, history, quality, splits, training, walkforward,
)
from brickfolio.plans import tables
from brickfolio.session import write_and_reread

KEYS = ["ticker", "feature_date", "target_date"]


class Pipeline:
    """Each property is a lazy table built from the ones before it."""

    def __init__(self, panel: DataFrame, registry=tables.registry, windows=C.DEFAULT_WINDOWS):
        self.panel = panel
        self._registry = registry
        self.windows = windows

    @classmethod
    def daily(cls, spark: SparkSession, sf_dir: str) -> Pipeline:
        return cls(tables.daily_panel(spark, sf_dir))

    @classmethod
    def weekly(cls, spark: SparkSession, sf_dir: str) -> Pipeline:
        return cls(tables.weekly_panel(spark, sf_dir))

    @cached_property
    def candidates(self) -> DataFrame:
        return discontinuities.discontinuities(self.panel)

    @cached_property
    def registry(self) -> DataFrame:
        return self._registry(self.candidates)

    @cached_property
    def reviewed(self) -> DataFrame:
        return discontinuities.apply_reviews(self.candidates, self.registry)

    @cached_property
    def stored_pending(self) -> DataFrame:
        """Candidates still to be reviewed as a written table: the queue's order looks for its bounds first and so reads its input twice."""
        return write_and_reread(self.reviewed.filter("review_status = 'PENDING_REVIEW'"), "pending")

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar.session_calendar(self.panel)

    @cached_property
    def adjusted(self) -> DataFrame:
        return adjusted.adjusted_from_registry(self.panel, self.registry)

    @cached_property
    def history(self) -> DataFrame:
        return history.price_history(self.adjusted, self.windows)

    @cached_property
    def quality(self) -> DataFrame:
        return quality.price_quality(self.adjusted, self.calendar)

    @cached_property
    def features(self) -> DataFrame:
        return features.ml_features(self.history, self.windows)

    @cached_property
    def eligibility(self) -> DataFrame:
        return training.eligibility_from_adjusted(self.adjusted, self.calendar, self.windows)

    @cached_property
    def training(self) -> DataFrame:
        return training.training_from_adjusted(self.adjusted, self.calendar, self.windows)

    @cached_property
    def stored_training(self) -> DataFrame:
        """The training set as a written table, for readers of the whole of it; the columns that are given are put in as it is read."""
        given = self.given["training"]
        rows = write_and_reread(self.training.drop(*[c for group in given for c in group]), "training")
        for group in given:
            rows = rows.withColumns(group)
        return rows.select(self.training.columns)

    @cached_property
    def stored_samples(self) -> DataFrame:
        """Keys, target, inputs and lineage of the training set as a written table.

        Split boundaries, folds and models each read it several times; without
        the table every read would repeat the whole chain. They read a third of
        the columns, so the others are neither computed nor written.
        """
        names = [*KEYS, "ml_eligible", "feature_ready", walkforward.TARGET, *C.feature_names(self.windows), *splits.LINEAGE]
        return write_and_reread(self.training.select(*names), "samples")

    @cached_property
    def boundaries(self) -> DataFrame:
        return splits.split_boundaries(self.stored_samples)

    @cached_property
    def split(self) -> DataFrame:
        """The split of the whole rows."""
        return splits.temporal_split(self.stored_training)

    @cached_property
    def fixed(self) -> dict[str, dict[str, Column]]:
        """By stage the literals of the columns that have one value in all of its rows."""
        return {"eligibility": eligibility.fixed_columns(), "training": training.fixed_columns(self.windows)}

    @cached_property
    def given(self) -> dict[str, list[dict[str, Column]]]:
        """By stage groups of columns that have one value in all of its rows, or follow from others of the row."""
        samples = training.given_columns(self.windows)
        return {"eligibility": [self.fixed["eligibility"]], "training": samples, "split": [*samples, splits.given_columns()]}

    @cached_property
    def sample_split(self) -> DataFrame:
        """The split of the samples' keys, targets, inputs and lineage."""
        return splits.temporal_split(self.stored_samples)

    @cached_property
    def stored_split(self) -> DataFrame:
        """The split as a written table, for reports that read it several times."""
        names = ["split_name", *KEYS, walkforward.TARGET, *C.feature_names(self.windows)]
        return write_and_reread(self.sample_split.select(*names), "split")

    @cached_property
    def universe(self) -> DataFrame:
        """Samples before the test split, written once: every fold statistic reads them again."""
        rows = walkforward.pre_test_universe(self.stored_samples, self.boundaries)
        names = [*KEYS, walkforward.TARGET, *C.feature_names(self.windows)]
        return write_and_reread(rows.select(*names), "universe")
