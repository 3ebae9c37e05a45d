"""Window specifications of the panel: one row per (ticker, trade_date)."""

from __future__ import annotations

from pyspark.sql import Column, Window, functions as F


def by_ticker(order: str = "trade_date"):
    return Window.partitionBy("ticker").orderBy(order)


def last_rows(n: int, order: str = "trade_date"):
    return by_ticker(order).rowsBetween(-(n - 1), Window.currentRow)


def rows_before(n: int, order: str = "trade_date"):
    return by_ticker(order).rowsBetween(-n, -1)


def running(order: str = "trade_date"):
    return by_ticker(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(order: str = "trade_date"):
    return by_ticker(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def total_of_last(aggregate: Column, n: int, order: str = "trade_date") -> Column:
    """A count, or a sum of whole numbers, over the last ``n`` rows: the difference of two running totals, each of which takes a row once."""
    before = by_ticker(order).rowsBetween(Window.unboundedPreceding, -n)
    return aggregate.over(running(order)) - F.coalesce(aggregate.over(before), F.lit(0))


def exactly_ahead(n: int, index: str):
    """The row whose dense session index is exactly ``n`` further, if it exists."""
    return by_ticker(index).rangeBetween(n, n)


def full_window(value: Column, n: int, w, aggregate: Column) -> Column:
    """``aggregate`` over ``w``, the last ``n`` rows, when all ``n`` values of the frame are present."""
    return F.when(total_of_last(F.count(value), n) == n, aggregate.over(w))
