import json

import pytest
from pyspark.sql import functions as F

from tradeflow.sources import decode, readers, sinks


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_ticks(spark):
    good = '{"type":"trade","data":[{"s":"AAPL","p":150.5,"v":100,"t":1640995200000}]}'
    df = lines(spark, good, '{"type":"ping"}', "not json", '{"type":"trade","data":[]}', '{"type":"trade","data":[{}]}')
    rows = decode.decode_ticks(df).collect()
    first = next(r for r in rows if r.symbol == "AAPL")
    assert (first.price, first.volume, first.exchange, str(first.timestamp)) == (150.5, 100.0, "US", "2022-01-01 00:00:00")
    bare = next(r for r in rows if r.symbol == "")
    assert len(rows) == 2 and (bare.price, bare.volume, str(bare.timestamp)) == (0.0, 0.0, "1970-01-01 00:00:00")
    counts = {r.kind: (r.lines, r.trades) for r in decode.classify_ticks(df).collect()}
    assert counts == {"trade": (3, 2), "other": (1, 0), "malformed": (1, 0)}
    assert {r.trade_id for r in decode.decode_ticks(df).collect()} == {r.trade_id for r in rows}


def test_bars(spark):
    bar = {"1. open": "150.0", "2. high": "151.0", "3. low": "149.0", "4. close": "150.5", "5. volume": "100"}
    payloads = spark.createDataFrame(
        [
            ("AAPL", json.dumps({"Meta Data": {"1. Information": "x"}, "Time Series (5min)": {"2026-04-01 10:00:00": bar}})),
            ("MSFT", json.dumps({"Time Series (Daily)": {"2026-04-01": bar, "2026-04-02": {**bar, "4. close": "oops"}}})),
            ("X", '{"Error Message": "no"}'),
            ("Y", '{"Note": "limit"}'),
            ("Z", '{"Information": "limit"}'),
            ("W", "broken"),
        ],
        "symbol string, payload string",
    )
    rows = decode.decode_bars(payloads).orderBy("symbol", "timestamp").collect()
    assert [(r.symbol, r.open, r.close, r.volume) for r in rows] == [
        ("AAPL", 150.0, 150.5, 100),
        ("MSFT", 150.0, 150.5, 100),
        ("MSFT", 150.0, None, 100),
    ]
    kinds = {r.kind: r.payloads for r in decode.classify_bars(payloads).collect()}
    assert kinds == {"data": 2, "error": 1, "rate_limited": 2, "unknown": 1}
    trades = decode.bars_to_trades(decode.decode_bars(payloads))
    assert trades.filter("symbol = 'AAPL'").first().trade_id == trades.select(F.md5(F.lit("AAPL_2026-04-01 10:00:00"))).first()[0]


def test_json_csv_and_layout(spark, tmp_path, trades):
    folder = str(tmp_path / "json")
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "a.json").write_text(
        '{"trade_id":"1","symbol":"A","price":1.5,"volume":2,"timestamp":"2026-04-01T10:00:00Z"}\n'
        '{"trade_id":"2","symbol":"B","price":"bad","volume":2,"timestamp":"2026-04-01T10:00:00Z"}\n'
    )
    rows = {r.trade_id: r for r in readers.read_trades_json(spark, folder).collect()}
    assert rows["1"].price == 1.5 and rows["2"].price is None
    assert rows["1"]._source_file.endswith("a.json") and rows["1"]._ingested_at is not None
    laid = sinks.cluster_layout(trades, partitions=2)
    laid.write.parquet(str(tmp_path / "laid"))
    assert spark.read.parquet(str(tmp_path / "laid")).count() == 5


def test_batch_sinks(spark, tmp_path, trades):
    path = str(tmp_path / "t")
    assert sinks.append_bars(trades.limit(0), path) is False
    assert sinks.append_bars(trades, path) and sinks.append_bars(trades, path)
    assert spark.read.parquet(path).count() == 10
    sinks.write_table(trades, path, mode="overwrite", stamp=True)
    assert "update_timestamp_utc" in spark.read.parquet(path).columns
    sinks.export_csv(trades, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 5
    with pytest.raises(ValueError):
        sinks.write_table(trades)


def test_zorder_skips_files_for_either_column(spark, tmp_path):
    """Of 64 files, a filter on one symbol and a filter on a tenth of the time each leave few to read."""
    import pyarrow.parquet as pq

    rows = spark.range(40_000).select(
        F.concat(F.lit("S"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.hash("id"), F.lit(40)))).alias("symbol"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(1_000_000))).alias("timestamp"), F.col("id").alias("row"),
    )
    read = {}
    for name, laid in (("z", sinks.zorder_layout(rows, partitions=64)), ("line", sinks.cluster_layout(rows, partitions=64))):
        assert laid.columns == rows.columns
        laid.write.parquet(str(tmp_path / name))
        stats = []
        for file in sorted((tmp_path / name).glob("part-*")):
            meta = pq.ParquetFile(file).metadata
            for g in range(meta.num_row_groups):
                columns = {meta.row_group(g).column(k).path_in_schema: meta.row_group(g).column(k).statistics for k in range(2)}
                stats.append((columns["symbol"].min, columns["symbol"].max))
        symbol = sum(a <= "S7" <= b for a, b in stats) / len(stats)
        spans = spark.read.parquet(str(tmp_path / name)).groupBy(F.input_file_name()).agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).collect()
        low, high = 1_700_000_000 + 500_000, 1_700_000_000 + 600_000
        time = sum(r.a.timestamp() <= high and low <= r.b.timestamp() for r in spans) / len(spans)
        read[name] = (symbol, time)
    assert spark.read.parquet(str(tmp_path / "z")).exceptAll(rows).isEmpty() and spark.read.parquet(str(tmp_path / "z")).count() == 40_000
    assert read["z"][0] < 0.3 and read["z"][1] < 0.4 < read["line"][1]


def test_zorder_of_missing_values_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, 1.0), ("a", None), (None, None), ("b", float("nan"))], "symbol string, price double")
    assert sinks.zorder_layout(rows, "symbol", "price", partitions=2).count() == 4
    assert sinks.zorder_layout(rows.limit(0), "symbol", "price").count() == 0
