from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quarterdeck.functions.periods import ordinal  # noqa: E402
from quarterdeck.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def growing(entity: str, start: float, rate: float = 0.02) -> list[tuple]:
    """Eight quarters of 2020 and 2021, each 2 % above the one before, rounded when shown."""
    rows, price = [], start
    for year in (2020, 2021):
        for quarter in range(1, 5):
            shown = round(price, 2)
            rows.append((entity, ordinal(year, quarter), shown, shown * 1.1, shown * 0.9))
            price *= 1 + rate
    return rows


@pytest.fixture(scope="session")
def panel(spark):
    rows = growing("A", 100.0) + growing("AAPL", 200.0)
    return spark.createDataFrame(
        [(*r, 1000000, 1000000) for r in rows],
        "entity string, q_ord int, PriceAvg double, PriceHigh double, PriceLow double, "
        "Earnings long, TotalRevenue long")


@pytest.fixture(scope="session")
def scored(spark):
    rows = growing("A", 100.0) + growing("AAPL", 100.0)
    return spark.createDataFrame(
        [(e, q, p, 0.02, p * 1.02) for e, q, p, _, _ in rows],
        "entity string, q_ord int, PriceAvg double, Q_Delta_PriceAvg double, score double")


@pytest.fixture(scope="session")
def index_panel(spark):
    quarters = [ordinal(y, q) for y in (2019, 2020, 2021) for q in range(1, 5)]
    return spark.createDataFrame(
        [("DJI", q, 102.0 + 2 * i) for i, q in enumerate(quarters)],
        "entity string, q_ord int, PriceAvg double")
