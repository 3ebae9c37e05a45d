"""Data contracts as tables: one row per rule, counted in a single pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brickfolio.contracts import ContractError


def _rows(counts: DataFrame, names: list[str], dataset: str | None) -> DataFrame:
    """Turn the one-row count table into (check_name, violations, status) rows."""
    pairs = F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("violations"))
        for i, n in enumerate(names)
    ])
    out = counts.select(F.inline(pairs))
    out = out.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
    return out if dataset is None else out.select(F.lit(dataset).alias("dataset"), *out.columns)


def rule_counts(df: DataFrame, rules: dict[str, Column], key: tuple[str, ...] | None = None,
                dataset: str | None = None) -> DataFrame:
    """Violations per rule; ``key`` adds a uniqueness rule.

    The uniqueness rule is folded in by grouping on the key first: the rules are
    summed per key group (partially before the shuffle) and then overall, so the
    whole contract is one scan and one hash exchange.
    """
    names = list(rules)
    counters = [F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(rules.values())]
    if key is None:
        return _rows(df.agg(*counters), names, dataset)
    grouped = df.groupBy(*key).agg(*counters, F.count(F.lit(1)).alias("copies"))
    totals = grouped.agg(
        *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(names))],
        F.sum(F.when(F.col("copies") > 1, F.col("copies") - 1).otherwise(0)).alias(f"c{len(names)}"),
    )
    return _rows(totals, names + ["KEY_UNIQUE"], dataset)


def assert_passed(checks: DataFrame) -> None:
    """The one driver-side step: read the few failing rules and raise."""
    failed = checks.filter(F.col("status") == "FAIL").collect()
    if failed:
        raise ContractError("; ".join(f"{r.check_name}={r.violations}" for r in failed))


def expect_single(df: DataFrame, values: dict[str, str], dataset: str | None = None) -> DataFrame:
    """Lineage columns that must hold one literal in every row."""
    return rule_counts(
        df, {f"{c.upper()}_IS_{v}": ~F.col(c).eqNullSafe(F.lit(v)) for c, v in values.items()}, dataset=dataset)


def duplicate_rows(df: DataFrame, *key: str) -> DataFrame:
    """All rows whose key occurs more than once.

    The repeated keys are found by a partial aggregate, so a key that holds a
    large share of the rows is never gathered into one task; the join that
    brings the rows back is a plain equi-join that AQE may split.
    """
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return df.join(repeated, list(key), "inner")
