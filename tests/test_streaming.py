import os
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradeflow.operators import enrich
from tradeflow.operators import features as ft
from tradeflow.schemas import BAR, TRADE
from tradeflow.sources import readers, sinks
from tradeflow.streaming import pipeline
from tradeflow.streaming.gold import GoldStream

T0 = datetime(2026, 4, 1, 15, 0)


def drop_files(spark, folder, *batches):
    """One file per batch, with increasing modification times, so each is one micro-batch."""
    folder.mkdir(exist_ok=True)
    for number, rows in enumerate(batches):
        pdf = pd.DataFrame(rows, columns=TRADE.names)
        pdf["timestamp"] = pd.to_datetime(pdf["timestamp"]).dt.tz_localize("UTC")
        name = folder / f"part-{number:03d}.parquet"
        pdf.to_parquet(name, coerce_timestamps="us")
        os.utime(name, (1_700_000_000 + 10 * number,) * 2)
    return readers.read_trades_parquet(spark, str(folder), max_files_per_trigger=1)


def trade(i, seconds, symbol="A", price=10.0):
    return (str(i), symbol, price, 100.0, T0 + timedelta(seconds=seconds), "US")


def test_stream_equals_batch_and_remembers_keys(spark, tmp_path):
    first = [trade(1, 0), trade(2, 10), trade(3, 20, price=-1.0)]
    second = [trade(1, 0), trade(4, 100), trade(2, 10)]
    stream = drop_files(spark, tmp_path / "in", first, second)
    out = pipeline.run_to_end(pipeline.silver_stream(stream, stamp=False), str(tmp_path / "out"))
    batch = enrich.bronze_to_silver(spark.createDataFrame(first + second, TRADE), stamp=False)
    assert sorted(map(str, out.collect())) == sorted(map(str, batch.collect()))


def test_late_rows_are_dropped(spark, tmp_path):
    stream = drop_files(spark, tmp_path / "in", [trade(1, 0)], [trade(2, 1000)], [trade(3, 2000)], [trade(4, 10), trade(5, 1990)])
    out = pipeline.run_to_end(pipeline.silver_stream(stream, stamp=False), str(tmp_path / "out"))
    assert {r.trade_id for r in out.collect()} == {"1", "2", "3", "5"}


def test_quality_hook_is_replayable(spark, tmp_path):
    stream = drop_files(spark, tmp_path / "in", [trade(1, 0), trade(2, 1)], [trade(3, 2)])
    for run in ("a", "a"):
        pipeline.start_with_quality(
            stream, str(tmp_path / "data"), str(tmp_path / "quality"), str(tmp_path / f"ck-{run}")
        ).awaitTermination()
    quality = spark.read.json(str(tmp_path / "quality")).collect()
    assert sorted((r.batch_id, r["count"]) for r in quality) == [(0, 2), (1, 1)]
    assert spark.read.parquet(str(tmp_path / "data")).count() == 3


def test_union_of_streams_and_windows(spark, tmp_path):
    ticks = drop_files(spark, tmp_path / "ticks", [trade(1, 0)])
    bars = spark.createDataFrame([("A", T0, 1.0, 2.0, 0.5, 1.5, 7, "5min", T0)], BAR)
    sinks.export_csv(bars, str(tmp_path / "bars"))
    bar_stream = readers.read_bars_csv(spark, str(tmp_path / "bars"), stream=True)
    both = pipeline.run_to_end(pipeline.union_sources(ticks, bar_stream), str(tmp_path / "out"))
    assert {(r.price, r.volume) for r in both.collect()} == {(10.0, 100.0), (1.5, 7.0)}

    log = drop_files(spark, tmp_path / "log", [trade(1, 0), trade(2, 60)], [trade(3, 4000)]).select(
        F.lit("anomaly").alias("prediction"), "timestamp", F.col("symbol").alias("model_name"), F.col("price").alias("execution_duration_ms")
    )
    rows = pipeline.run_to_end(pipeline.profile_stream(log), str(tmp_path / "windows")).collect()
    assert [(r.window_start, r.predictions, r.anomalies) for r in rows] == [(T0, 2, 2)]


def test_append_sink_needs_a_target(spark, tmp_path):
    stream = drop_files(spark, tmp_path / "in", [trade(1, 0)])
    with pytest.raises(ValueError):
        sinks.start_append(stream, str(tmp_path / "ck"))


@pytest.mark.parametrize("mode, rows_per_block", [("sma", 10**6), ("sma", 50), ("ema", 10**6)])
def test_gold_stream_equals_batch(spark, tmp_path, mode, rows_per_block):
    """Shuffled within the delay over several micro-batches, plus one hopelessly late trade."""
    rng = np.random.default_rng(8)
    rows = [
        trade(f"{i:04d}", i, symbol="HOT" if rng.random() < 0.7 else str(rng.choice(["A", "B"])), price=float(rng.lognormal(3, 0.2)))
        for i in range(600)
    ]
    order = np.argsort(np.arange(600) + rng.uniform(0, 60, 600))
    batches = [[rows[i] for i in part] for part in np.array_split(order, 4)]
    batches[2].append(trade("late", -500))
    stream = drop_files(spark, tmp_path / "in", *batches)
    gold = GoldStream(str(tmp_path / "gold"), timedelta(minutes=2), mode, rows_per_block)
    gold.start(stream).awaitTermination()
    gold.flush(spark)
    got = gold.output(spark).toPandas().sort_values("trade_id").reset_index(drop=True)
    want = ft.rolling_features(spark.createDataFrame(rows, TRADE), mode=mode).toPandas()
    want = want.sort_values("trade_id").reset_index(drop=True)
    assert list(got["trade_id"]) == list(want["trade_id"])
    for name in ft.FEATURES:
        np.testing.assert_allclose(got[name], want[name], rtol=1e-9, atol=1e-9, err_msg=name)
    assert gold.late_rows(spark).agg(F.sum("late_rows")).first()[0] == 1


def test_gold_batch_can_be_repeated(spark, tmp_path):
    batch = spark.createDataFrame([trade(i, i * 100) for i in range(20)], TRADE)
    gold = GoldStream(str(tmp_path / "gold"))
    gold.on_batch(batch.filter("cast(trade_id as int) < 10"), 0)
    gold.on_batch(batch.filter("cast(trade_id as int) >= 10"), 1)
    before = gold.output(spark).count()
    gold.on_batch(batch.filter("cast(trade_id as int) >= 10"), 1)
    assert gold.output(spark).count() == before
    gold.flush(spark)
    assert gold.output(spark).count() == 20


def _row_stream(spark, folder, rows):
    from tradeflow.sources.row_stream import RowStream

    spark.dataSource.register(RowStream)
    return spark.readStream.format("parquet_rows").schema("id long, name string").option("path", str(folder)).option("rows", rows).load()


def _file(spark, folder, name, ids):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder.mkdir(exist_ok=True)
    pq.write_table(pa.table({"name": [f"n{i}" for i in ids], "id": pa.array(ids, pa.int64()), "other": [0.5] * len(ids)}), folder / name, row_group_size=70)


def test_batches_bounded_by_rows_survive_a_restart(spark, tmp_path):
    """No batch is above the bound, and stops between and inside batches lose and repeat nothing."""
    source, seen = tmp_path / "in", []
    _file(spark, source, "a.parquet", range(250))
    _file(spark, source, "b.parquet", range(250, 253))
    _file(spark, source, "c.parquet", range(253, 700))
    (source / "_SUCCESS").write_text("")
    fail = [3]

    def on_batch(batch, number):
        rows = sorted(r.id for r in batch.collect())
        if number in fail:
            fail.remove(number)
            raise RuntimeError("stopped inside a batch")
        seen.append((number, rows))

    def run():
        writer = _row_stream(spark, source, 100).writeStream.foreachBatch(on_batch).option("checkpointLocation", str(tmp_path / "ck"))
        return writer.trigger(processingTime="0 seconds").start()

    query = run()
    try:
        query.awaitTermination(60)
    except Exception as error:  # noqa: BLE001  the planned stop
        assert "stopped inside a batch" in str(error)
    assert [n for n, _ in seen] == [0, 1, 2]
    _file(spark, source, "d.parquet", range(700, 812))
    query = run()
    for _ in range(240):
        if seen and seen[-1][1][-1] == 811:
            break
        query.awaitTermination(0.5)
    query.stop()
    assert [i for _, rows in seen for i in rows] == list(range(812))
    assert max(len(rows) for _, rows in seen) == 100 and [n for n, _ in seen] == list(range(9))


def test_row_stream_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    query = _row_stream(spark, tmp_path / "in", 10).writeStream.format("memory").queryName("no_rows").option("checkpointLocation", str(tmp_path / "ck")).start()
    query.awaitTermination(3)
    query.stop()
    assert spark.table("no_rows").count() == 0


def test_keyed_gold_over_restarts_and_late_trades(spark, tmp_path):
    """Rows of all batches equal the batch operator's; a trade behind the watermark is left out; only symbols with trades are touched."""
    import datetime as dt

    import numpy as np

    from tradeflow.operators.features import FEATURES, rolling_features
    from tradeflow.streaming.keyed_gold import KeyedGoldStream

    rng, start = np.random.default_rng(5), dt.datetime(2026, 4, 1, 9)
    rows = [(f"t{k}", "ABC"[rng.integers(3)] if k < 120 else "A", float(100 + rng.normal()), float(rng.integers(1, 90)), start + dt.timedelta(seconds=20 * k + int(rng.integers(0, 60))), "US", "regular") for k in range(240)]
    late = ("late", "B", 1.0, 1.0, start, "US", "regular")
    schema = "trade_id string, symbol string, price double, volume double, timestamp timestamp, exchange string, session_type string"
    parts = [rows[:80], rows[80:160], [late, *rows[160:200]], rows[200:]]
    gold, source = KeyedGoldStream(str(tmp_path / "gold")), str(tmp_path / "in")
    for run in (parts[:2], parts[2:]):
        for part in run:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
            query = gold.start(stream)
            query.awaitTermination()
            assert query.exception() is None
    gold.flush(spark)
    names = ["trade_id", *(f for f in FEATURES if f in gold.output(spark).columns)]
    found = {r.trade_id: tuple(r)[1:] for r in gold.output(spark).select(*names).collect()}
    expected = {r.trade_id: tuple(r)[1:] for r in rolling_features(spark.createDataFrame(rows, schema)).select(*names).collect()}
    assert found.keys() == expected.keys() and len(names) > 5
    for trade, values in expected.items():
        assert found[trade] == pytest.approx(values, rel=1e-9, abs=1e-9, nan_ok=True)
    batches = gold.output(spark).sparkSession.read.parquet(str(tmp_path / "gold/features"))
    last = batches.filter("batch = 'last'").select("symbol").distinct().collect()
    assert [r.symbol for r in last] == ["A"]
    assert not (tmp_path / "gold/state").exists()


def test_a_trigger_takes_several_bounded_batches(spark, tmp_path):
    """A backlog costs a trigger for every ``batches`` batches; rows are numbered by batch over all files."""
    from tradeflow.sources.row_stream import RowStream

    spark.range(0, 95, 1, 3).write.option("parquet.block.size", 64).parquet(str(tmp_path / "in"))
    spark.dataSource.register(RowStream)
    stream = spark.readStream.format("parquet_rows").schema("id long, batch long").option("path", str(tmp_path / "in")).option("rows", 10).option("batches", 4).option("number", "batch").load()
    triggers = []
    query = stream.writeStream.foreachBatch(lambda df, _: triggers.append([tuple(r) for r in df.collect()])).option("checkpointLocation", str(tmp_path / "ck")).start()
    query.processAllAvailable()
    query.stop()
    assert [len(t) for t in triggers] == [40, 40, 15]
    numbers = [b for t in triggers for _, b in t]
    assert [numbers.count(k) for k in range(10)] == [10] * 9 + [5] and sorted(i for t in triggers for i, _ in t) == list(range(95))
