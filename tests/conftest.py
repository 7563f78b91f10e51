import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from candlespark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """Physical plan text of a frame."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()


START = dt.datetime(2024, 1, 1)


@pytest.fixture
def trades(spark):
    """Build trades from ``(seconds, trade_id, price, quantity)`` rows of one symbol."""

    def build(rows, symbol="A"):
        data = [(symbol, i, START + dt.timedelta(seconds=s), p, q, False) for s, i, p, q in rows]
        return spark.createDataFrame(
            data, "symbol string, trade_id long, timestamp timestamp, price double, quantity double, is_buyer_maker boolean"
        )

    return build
