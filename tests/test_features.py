import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradeflow.operators import features as ft
from tradeflow.operators import labels as lb
from tradeflow.operators.blocks import fit_blocks, row_numbers
from tradeflow.operators.ema import history_for


def skewed(spark, n=1500, seed=3):
    """One symbol with most rows, several with few, many equal timestamps."""
    rng = np.random.default_rng(seed)
    symbol = np.where(rng.random(n) < 0.7, "HOT", rng.choice(["A", "B", "C", "D"], n))
    pdf = pd.DataFrame(
        {
            "trade_id": [f"t{i:05d}" for i in rng.permutation(n)],
            "symbol": symbol,
            "price": np.round(rng.lognormal(4, 0.3, n), 2),
            "volume": rng.integers(0, 500, n).astype(float),
            "timestamp": pd.Timestamp("2026-04-01") + pd.to_timedelta(rng.integers(0, n // 3, n), unit="s"),
        }
    )
    return pdf, spark.createDataFrame(pdf).repartition(5)


def brute_force(pdf, flat, ema):
    parts = []
    for _, one in pdf.sort_values(["symbol", "timestamp", "trade_id"]).groupby("symbol"):
        p, v = one["price"], one["volume"]
        rp, rv = p.rolling(14, min_periods=1), v.rolling(14, min_periods=1)
        prev = p.shift()
        std, vstd = rp.std(), rv.std()
        vol14 = rv.sum()
        vwap = ((p * v).rolling(14, min_periods=1).sum() / vol14).where(vol14 > 0, p)
        move = p.diff().fillna(0)
        ag = move.clip(lower=0).rolling(14, min_periods=1).mean()
        al = (-move).clip(lower=0).rolling(14, min_periods=1).mean()
        fast = p.ewm(span=12, adjust=False).mean() if ema else p.rolling(12, min_periods=1).mean()
        slow = p.ewm(span=26, adjust=False).mean() if ema else p.rolling(26, min_periods=1).mean()
        lower = rp.mean() - 2 * std
        parts.append(
            one.assign(
                price_change_pct=((p - prev) / prev * 100).fillna(0),
                volume_zscore=((v - rv.mean()) / vstd).where(vstd > 0, 0),
                price_volatility_1h=std.fillna(0),
                trade_intensity_1m=np.minimum(np.arange(1, len(p) + 1), 14),
                vwap_deviation=((p - vwap) / vwap * 100).where(vwap > 0, 0),
                rsi_14=(100 - 100 / (1 + ag / al)).where(al > 1e-12, flat),
                macd_signal=fast - slow,
                bollinger_position=((p - lower) / (4 * std)).where(std > 0, 0.5),
                bid_ask_spread_pct=(std / p * 100).fillna(0),
            )
        )
    return pd.concat(parts).sort_values("trade_id").reset_index(drop=True)


@pytest.mark.parametrize("mode, flat", [("sma", 50.0), ("ema", 0.0)])
@pytest.mark.parametrize("rows_per_block", [10**6, 200, 10])
def test_features_equal_brute_force_for_any_block_size(spark, mode, flat, rows_per_block):
    pdf, df = skewed(spark)
    got = ft.rolling_features(df, mode=mode, rows_per_block=rows_per_block).toPandas()
    got = got.sort_values("trade_id").reset_index(drop=True)
    want = brute_force(pdf, flat, mode == "ema")
    assert list(got["trade_id"]) == list(want["trade_id"])
    for name in ft.FEATURES:
        np.testing.assert_allclose(got[name], want[name], rtol=1e-7, atol=1e-7, err_msg=name)


def test_blocks_split_only_large_keys(spark):
    _, df = skewed(spark)
    blocks = fit_blocks(df, ["symbol"], ["timestamp", "trade_id"], rows_per_block=200)
    assert [r.symbol for r in blocks.cuts.collect()] == ["HOT"]
    capped = fit_blocks(df, ["symbol"], ["timestamp", "trade_id"], rows_per_block=1, max_blocks=10)
    assert capped.most_cuts <= 12


@pytest.mark.parametrize("keys", [["symbol"], []])
def test_row_numbers_over_blocks(spark, keys):
    pdf, df = skewed(spark, n=500)
    got = row_numbers(df, keys, ["timestamp", "trade_id"], "n", rows_per_block=30).toPandas()
    ordered = pdf.sort_values([*keys, "timestamp", "trade_id"])
    want = (ordered.groupby(keys).cumcount() if keys else pd.Series(range(500), index=ordered.index)) + 1
    assert dict(zip(got["trade_id"], got["n"])) == dict(zip(ordered["trade_id"], want))


def test_one_shuffle_for_the_whole_block(spark):
    _, df = skewed(spark)
    plan = ft.rolling_features(df.repartition(2))._jdf.queryExecution().executedPlan().toString()
    windows = plan.split("Window [")[-1]
    assert plan.count("Exchange hashpartitioning(symbol") == 1
    assert windows.count("Exchange hashpartitioning") == 1


def test_five_trades_have_no_nulls(trades):
    rows = ft.rolling_features(trades).collect()
    assert len(rows) == 5
    assert all(r[name] is not None for r in rows for name in ft.FEATURES)
    gold = ft.gold_features(trades)
    assert [c for c in ft.GOLD_COLUMNS if c in gold.columns] == gold.columns


def test_flat_rsi_is_a_parameter(trades):
    def first(**options):
        return ft.rolling_features(trades, **options).filter("trade_id = 't1'").first().rsi_14

    assert first() == 50.0 and first(mode="ema") == 0.0 and first(flat_rsi=42.0) == 42.0
    with pytest.raises(ValueError):
        ft.rolling_features(trades, mode="other")


def test_constant_prices_stay_neutral(spark):
    rows = [(f"t{i:02d}", "A", 0.1, 0.3, f"2026-04-01 10:00:{i:02d}") for i in range(40)]
    df = spark.createDataFrame(rows, "trade_id string, symbol string, price double, volume double, timestamp string")
    out = ft.rolling_features(df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))).collect()
    assert {(r.bollinger_position, r.volume_zscore, r.rsi_14, r.price_volatility_1h) for r in out} == {(0.5, 0.0, 50.0, 0.0)}


@pytest.mark.parametrize(
    "vz, pc, rsi, boll, label", [(4, 3, 50, 0.5, 1), (1, 1, 90, 0.5, 1), (1, 1, 50, 1.1, 1), (1, 1, 50, 0.5, 0), (-4, -3, 50, 0.5, 1)]
)
def test_labels(spark, vz, pc, rsi, boll, label):
    df = spark.createDataFrame(
        [(float(vz), float(pc), float(rsi), float(boll))],
        "volume_zscore double, price_change_pct double, rsi_14 double, bollinger_position double",
    )
    assert ft.anomaly_labels(df).first().is_anomaly == label


def test_statistical_bounds(spark):
    """With n trades a z-score is at most (n-1)/sqrt(n), so early trades cannot trigger."""
    _, df = skewed(spark)
    rows = ft.rolling_features(df).select("trade_intensity_1m", "volume_zscore", "bollinger_position").collect()
    for r in rows:
        n = r.trade_intensity_1m
        assert abs(r.volume_zscore) <= (n - 1) / math.sqrt(n) + 1e-9
        if n < 6:
            assert 0 <= r.bollinger_position <= 1


def test_history_length_reaches_rounding_error():
    for span in (12, 26):
        assert (1 - 2 / (span + 1)) ** history_for(span) <= 2**-53


@pytest.mark.parametrize("rows_per_block", [10**6, 100])
def test_time_range_features(spark, rows_per_block):
    pdf, df = skewed(spark, n=800)
    got = ft.time_range_features(df, 60, 5, rows_per_block=rows_per_block).toPandas().set_index("trade_id")
    for row in pdf.itertuples():
        mine = pdf[pdf["symbol"] == row.symbol]
        age = (row.timestamp - mine["timestamp"]).dt.total_seconds()
        hour = mine[(age >= 0) & (age <= 60)]["price"]
        std = hour.std() if len(hour) > 1 else 0.0
        assert got.loc[row.trade_id, "intensity_1m"] == ((age >= 0) & (age <= 5)).sum()
        assert got.loc[row.trade_id, "volatility_1h"] == pytest.approx(std, abs=1e-6)


def test_split_sizes(spark):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate([0, 1, 0, 1, 0])], "trade_id string, is_anomaly int")
    split = lb.stratified_split(df, test_size=0.4)
    assert split.filter("is_test").count() == 2 and split.count() == 5
    assert split.filter("is_test").select("is_anomaly").distinct().count() == 2
    with_null = df.unionByName(spark.createDataFrame([("9", None)], "trade_id string, is_anomaly int"))
    assert lb.stratified_split(with_null, test_size=0.4).count() == 5


def test_split_is_repeatable_and_exact(spark):
    df = spark.range(1000).selectExpr("CAST(id AS string) AS trade_id", "CAST(id % 7 = 0 AS int) AS is_anomaly")
    first = lb.stratified_split(df, test_size=0.3)
    again = lb.stratified_split(df.repartition(7), test_size=0.3)
    assert first.filter("is_test").count() == 300
    assert set(first.filter("is_test").collect()) == set(again.filter("is_test").collect())
    other = lb.stratified_split(df, test_size=0.3, seed=1).filter("is_test").collect()
    assert set(other) != set(first.filter("is_test").collect())


@pytest.mark.parametrize("rows_per_block", [10**6, 3])
def test_ordinal_codes(spark, rows_per_block):
    df = spark.createDataFrame([(c,) for c in "bdacfeghij"] + [(None,)], "c string")
    codes = lb.fit_ordinal(df, ["c"], rows_per_block)
    assert {r.category: r.code for r in codes.collect()} == {c: i for i, c in enumerate("abcdefghij")}
    new = spark.createDataFrame([("a",), ("zz",), (None,)], "c string")
    coded = {r.c: r.c_code for r in lb.encode_ordinal(new, codes, ["c"]).collect()}
    assert coded == {"a": 0, "zz": -1, None: -1}


def test_clock_frames_get_tasks_as_their_tape_grows(spark, monkeypatch):
    """Four lines a trade: the tape's tasks follow the number of lines, not the session's fixed number of partitions."""
    from tradeflow.operators import timerange

    df = spark.range(200).selectExpr(
        "cast(id as string) AS trade_id", "concat('S', id % 3) AS symbol", "double(id % 11) AS price", "timestamp_seconds(1700000000 + id * 30) AS timestamp"
    )
    whole = {r.trade_id: (r.volatility_1h, r.intensity_1m) for r in timerange.time_range_features(df).collect()}
    monkeypatch.setattr(timerange, "LINES", 40)
    found = timerange.time_range_features(df)
    assert found.rdd.getNumPartitions() == 20
    got = {r.trade_id: (r.volatility_1h, r.intensity_1m) for r in found.collect()}
    assert got.keys() == whole.keys() and all(got[k] == pytest.approx(whole[k], abs=1e-9) for k in got)
