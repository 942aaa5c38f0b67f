import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tradewinds.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TOY = [
    # trade_id, account, coin, closed_pnl, size_usd, leverage, score, class, direction, win, roe, pnl_pct
    (100, "A", "SOL", 100.0, 5000.0, 5, 45.0, "Neutral", "Long", 1, 0.1, 0.02),
    (101, "A", "SOL", 200.0, 10000.0, 5, 60.0, "Greed", "Long", 1, 0.1, 0.02),
    (102, "A", "SOL", -150.0, 10000.0, 5, 65.0, "Greed", "Short", 0, -0.075, -0.015),
    (103, "A", "BTC", 300.0, 10000.0, 10, 30.0, "Fear", "Short", 1, 0.3, 0.03),
    (104, "A", "BTC", -50.0, 5000.0, 10, 20.0, "Extreme Fear", "Long", 0, -0.1, -0.01),
    (105, "B", "SOL", 100.0, 5000.0, 5, 45.0, "Neutral", "Long", 1, 0.1, 0.02),
    (106, "B", "SOL", 200.0, 10000.0, 5, 60.0, "Greed", "Long", 1, 0.1, 0.02),
    (107, "B", "SOL", -100.0, 10000.0, 5, 65.0, "Greed", "Short", 0, -0.05, -0.01),
    (108, "B", "BTC", 150.0, 10000.0, 10, 30.0, "Fear", "Short", 1, 0.15, 0.015),
    (109, "B", "BTC", 250.0, 10000.0, 10, 20.0, "Extreme Fear", "Long", 1, 0.25, 0.025),
]


@pytest.fixture(scope="session")
def toy(spark):
    """Ten closing trades of two accounts, all at the same minute, so only ``fill_seq`` orders them."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(TOY, (
        "trade_id long, account string, coin string, closed_pnl double, size_usd double, leverage int, "
        "sentiment_score double, sentiment_class string, trade_direction string, win_flag int, roe double, pnl_pct double"))
    return df.withColumns({
        "ts": F.lit("2026-05-25 10:00:00").cast("timestamp_ntz"), "date": F.lit("2026-05-25").cast("date"),
        "fill_seq": F.col("trade_id"), "is_closing_trade": F.lit(True), "hour": F.lit(10),
        "day_of_week": F.lit("Monday"), "leverage_bucket": F.lit("Medium Leverage (4x-10x)")})
