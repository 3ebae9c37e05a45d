import os
import sys
from datetime import date, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from brickfolio import contracts as C  # noqa: E402
from brickfolio.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session


DAY0 = date(2024, 1, 1)


def day(n: int) -> date:
    return DAY0 + timedelta(days=n)


@pytest.fixture(scope="session")
def panel(spark):
    """Builds a panel from {ticker: {day number: close price}}; all prices equal the close."""
    def build(closes, trades=10):
        rows = [
            (day(n), t, "0" * 14, "1", f"I{t}", *[float(p)] * 5, trades, "SINGLE_TICKER", "HIGH")
            for t, series in closes.items() for n, p in series.items()]
        return spark.createDataFrame(rows, C.PANEL_SCHEMA)
    return build


@pytest.fixture(scope="session")
def registry(spark):
    """Builds a registry from dicts; missing columns are null."""
    def build(*decisions):
        return spark.createDataFrame(
            [tuple(d.get(f.name) for f in C.REGISTRY_SCHEMA) for d in decisions], C.REGISTRY_SCHEMA)
    return build
