"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brickfolio.plans.shape import pick
from brickfolio.session import configure

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def register(key: str, build: Build, columns: list[str] | str | None = None, sql: str | None = None) -> None:
    wanted = columns.split() if isinstance(columns, str) else columns

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(configure(spark), sf_dir)
        return pick(df, wanted or df.columns)

    run.__name__ = key
    assert key not in QUERIES, key
    QUERIES[key] = run
    if sql is not None:
        ORACLES[key] = sql
