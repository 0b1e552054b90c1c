import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tradeflow.session import local_session

    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def trades(spark):
    """Five trades of two symbols."""
    rows = [
        ("t1", "AAPL", 150.0, 100, "2026-04-01 10:00:00"),
        ("t2", "AAPL", 151.0, 200, "2026-04-01 10:05:00"),
        ("t3", "AAPL", 149.0, 150, "2026-04-01 10:10:00"),
        ("t4", "MSFT", 300.0, 50, "2026-04-01 10:15:00"),
        ("t5", "MSFT", 305.0, 60, "2026-04-01 10:20:00"),
    ]
    df = spark.createDataFrame(rows, "trade_id string, symbol string, price double, volume long, timestamp string")
    return df.selectExpr("*", "'US' AS exchange", "'regular' AS session_type").withColumn(
        "timestamp", df.timestamp.cast("timestamp")
    )
