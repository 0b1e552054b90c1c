"""Operators whose path depends on the data's size must return the same rows on every path."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tradeflow import session
from tradeflow.operators import blocks as bl
from tradeflow.operators import ema, quality
from tradeflow.operators import features as ft
from tradeflow.operators import models as md
from tradeflow.operators.asof import asof_join
from tradeflow.operators.quantiles import exact_percentiles

START = datetime(2026, 4, 1, 10)


def holes(spark, n=240, seed=3):
    """Trades of which some lack a symbol, a price or a time; several share one instant."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        symbol = None if rng.random() < 0.2 else str(rng.choice(["A", "B"], p=[0.8, 0.2]))
        price = None if rng.random() < 0.15 else float(np.round(rng.uniform(5, 9), 2))
        at = None if rng.random() < 0.1 else START + timedelta(seconds=int(rng.integers(0, 400)))
        rows.append((f"t{k:04d}", symbol, price, float(rng.integers(1, 9)), at))
    return spark.createDataFrame(rows, "trade_id string, symbol string, price double, volume double, timestamp timestamp")


def rounded(df, digits=6):
    return sorted(
        (tuple(None if v is None else round(v, digits) if isinstance(v, float) else v for v in row) for row in df.collect()),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def brute_clock(rows, seconds):
    out = {}
    for r in rows:
        same = [x for x in rows if x.symbol == r.symbol]
        near = lambda x, s: x.timestamp is None if r.timestamp is None else x.timestamp is not None and 0 <= (r.timestamp - x.timestamp).total_seconds() <= s  # noqa: B023,E731
        prices = [x.price for x in same if near(x, seconds[0]) and x.price is not None]
        out[r.trade_id] = (float(np.std(prices, ddof=1)) if len(prices) > 1 else 0.0, sum(near(x, seconds[1]) for x in same))
    return out


@pytest.mark.parametrize("rows_per_block", [None, 4, 50])
def test_clock_frames_with_holes(spark, rows_per_block):
    df = holes(spark)
    got = ft.time_range_features(df, 60, 7, rows_per_block=rows_per_block)
    assert got.columns == [*df.columns, "volatility_1h", "intensity_1m"]
    found = {r.trade_id: (r.volatility_1h, r.intensity_1m) for r in got.collect()}
    want = brute_clock(df.collect(), (60, 7))
    assert found.keys() == want.keys()
    for k, (std, n) in want.items():
        assert found[k][0] == pytest.approx(std, abs=1e-6) and found[k][1] == n


def test_clock_frames_do_not_use_a_quadratic_frame(spark):
    plan = ft.time_range_features(holes(spark))._jdf.queryExecution().toString()
    assert "RangeFrame" not in plan or "unboundedpreceding" in plan.lower().split("rangeframe", 1)[1][:80]


@pytest.mark.parametrize("direct_limit", [1, 20, 10**6])
def test_percentiles_with_null_groups(spark, direct_limit):
    df = holes(spark)
    got = exact_percentiles(df, ["symbol"], "price", [0.0, 0.3, 0.5, 1.0], direct_limit)
    rows = df.collect()
    assert got.count() == 3
    for r in got.collect():
        values = [x.price for x in rows if x.symbol == r.symbol and x.price is not None]
        assert r.n == len(values) and np.allclose(r.percentiles, np.percentile(values, [0, 30, 50, 100]))


def test_many_small_groups_beside_a_large_one(spark):
    df = spark.range(9_000).select(F.when(F.col("id") < 3_000, F.lit(-1)).otherwise(F.col("id")).alias("g"), (F.col("id") * 1.5).alias("v"))
    got = exact_percentiles(df, ["g"], "v", [0.5], direct_limit=1_000)
    assert got.count() == 6_001 and got.filter("g = -1").first().percentiles == [1.5 * 1499.5]


@pytest.mark.parametrize("rows_per_block", [None, 3, 25])
def test_asof_with_holes(spark, rows_per_block):
    left, right = holes(spark, 120, 5).select("trade_id", "symbol", "timestamp"), holes(spark, 150, 6).select("symbol", "timestamp", "price", "trade_id")
    got = asof_join(left, right, right_columns=["trade_id"], tie_break=["trade_id"], rows_per_block=rows_per_block).collect()
    pool = [r for r in right.collect() if r.symbol is not None and r.timestamp is not None]
    assert len(got) == 120
    for r in got:
        able = [x for x in pool if r.symbol == x.symbol and r.timestamp is not None and x.timestamp <= r.timestamp]
        assert r.trade_id_asof == (max(able, key=lambda x: (x.timestamp, x.trade_id)).trade_id if able else None)


@pytest.mark.parametrize("mode", ["sma", "ema"])
def test_rolling_features_of_null_symbols(spark, mode):
    df = holes(spark).filter("price IS NOT NULL AND timestamp IS NOT NULL")
    columns = ["trade_id", *ft.FEATURES]
    whole = rounded(ft.rolling_features(df, mode=mode).select(*columns))
    assert rounded(ft.rolling_features(df, mode=mode, rows_per_block=9).select(*columns)) == whole and len(whole) == df.count()


def test_row_numbers_of_a_large_null_key(spark):
    df = holes(spark).select("symbol", "trade_id")
    small, large = (rounded(bl.row_numbers(df, ["symbol"], ["trade_id"], "n", size)) for size in (6, None))
    assert small == large


def test_block_size_follows_parallelism():
    assert bl.block_rows(10**9, 1000) == 500_000
    assert bl.block_rows(10**6, 8) == bl.LEAST_ROWS and bl.block_rows(10**12, 8) == bl.ROWS_PER_BLOCK


def test_averages_of_long_and_single_spans(spark):
    pdf = holes(spark, 700).filter("price IS NOT NULL").toPandas().sort_values("trade_id")
    df = spark.createDataFrame(pdf[["trade_id", "price"]]).withColumn("symbol", F.lit("x"))
    got = ema.ema_columns(df, "price", {"one": 1, "long": 90}, bl.Blocks(("symbol",), ("trade_id",), None)).toPandas().sort_values("trade_id")
    assert np.allclose(got["one"], pdf["price"]) and np.allclose(got["long"], pdf["price"].ewm(span=90, adjust=False).mean())


def test_forest_scores_after_an_observation(spark):
    """A fitted forest must not drag the session's observations into its tasks."""
    df = spark.range(300).selectExpr("id", "cast(id % 17 as double) AS a", "cast(id % 17 > 12 as int) AS y", "double(1) AS volume")
    seen = Observation("warned")
    quality.enforce(df, [quality.Rule("small", "a < 10", "warn")], seen).count()
    assert seen.get["small"] > 0
    score = md.random_forest({"trees": 2, "depth": 3, "min_rows": 1})(df, ["a"], "y")
    assert score(df).filter("prediction = y").count() == 300


def test_shared_folder_is_demanded_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster())
    assert session.is_local("local[8]") and not session.is_local("local-cluster[2,1,1024]")


def test_fail_rule_names_itself(spark):
    df = spark.createDataFrame([("t", None)], "trade_id string, timestamp timestamp")
    with pytest.raises(PySparkException, match="valid_timestamp"):
        quality.enforce(df, [quality.Rule("valid_timestamp", "timestamp IS NOT NULL", "fail")]).collect()
