"""What the keyed stream holds in its state."""

from datetime import datetime, timedelta

from tradeflow.streaming.keyed_gold import KeyedGoldStream


def test_a_symbols_waiting_trades_are_kept_in_pieces(spark, tmp_path):
    start = datetime(2026, 4, 1, 15)
    rows = [(str(k), "S", 100.0 + k % 7, 10.0, start + timedelta(milliseconds=k)) for k in range(3_000)]
    silver = "trade_id string, symbol string, price double, volume double, timestamp timestamp"
    spark.createDataFrame(rows, silver).coalesce(1).write.parquet(str(tmp_path / "in"))
    gold = KeyedGoldStream(str(tmp_path / "gold"))
    stream = spark.readStream.schema(silver).parquet(str(tmp_path / "in"))
    query = gold.start(stream)
    query.awaitTermination()
    held = spark.read.format("statestore").option("path", f"{tmp_path}/gold/checkpoint").option("stateVarName", "waiting").load()
    assert 1 <= held.count() <= 3  # one row of state for each trade before
    gold.flush(spark)
    assert gold.output(spark).select("trade_id").distinct().count() == gold.output(spark).count() == 3_000
