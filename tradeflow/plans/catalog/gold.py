"""Rolling features, labels, training sets and point-in-time lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeflow.operators import enrich as en
from tradeflow.operators import features as ft
from tradeflow.operators import labels as lb
from tradeflow.operators.asof import asof_join
from tradeflow.plans import fixtures as fx
from tradeflow.plans.catalog import registry as reg
from tradeflow.plans.catalog.registry import query, rounded, sql_r4
from tradeflow.session import cut_lineage

SPLIT_ROWS = 1_500  # small enough to cut every symbol of the test tables into blocks

_GOLD_ROW = (
    'trade_id, symbol, price, volume, "timestamp", exchange, hour_of_day, minute_of_hour, day_of_week, '
    f"session_type, trade_type, {reg.SQL_FEATURES}"
)
_SILVER_FROM_TRADES = f"{reg.TRADES}, silver AS ({reg.enriched('trades')})"


def _silver(spark, sf_dir):
    """The given events are already clean and unique, so gold reads them straight from the scan."""
    return en.enrich(fx.trades(spark, sf_dir))


@query(f"WITH {_SILVER_FROM_TRADES}, {reg.feature_steps('silver')} SELECT {_GOLD_ROW} FROM features")
def gold_features(spark, sf_dir):
    return rounded(ft.gold_features(_silver(spark, sf_dir)), *reg.FEATURE_COLUMNS)


@query(f"WITH {_SILVER_FROM_TRADES}, {reg.feature_steps('silver')} SELECT {_GOLD_ROW} FROM features")
def gold_features_blocks(spark, sf_dir):
    gold = ft.gold_features(_silver(spark, sf_dir), rows_per_block=SPLIT_ROWS)
    return rounded(gold, *reg.FEATURE_COLUMNS)


@query(
    f"WITH RECURSIVE {_SILVER_FROM_TRADES}, {reg.feature_steps('silver', '0.0', 'ema')} SELECT {_GOLD_ROW} FROM features"
)
def gold_features_ema(spark, sf_dir):
    return rounded(ft.gold_features(_silver(spark, sf_dir), mode="ema"), *reg.FEATURE_COLUMNS)


@query(
    f"""WITH RECURSIVE {reg.TRADES}, {reg.feature_steps("trades", "0.0", "ema")}
SELECT trade_id, {sql_r4("fast", "ema_12")}, {sql_r4("slow", "ema_26")}, {sql_r4("macd_signal", "macd_signal")}
FROM features"""
)
def macd_ema_blocks(spark, sf_dir):
    wide = ft.rolling_features(fx.trades(spark, sf_dir), mode="ema", rows_per_block=SPLIT_ROWS)
    names = {"fast_average": "ema_12", "slow_average": "ema_26"}
    picked = wide.select("trade_id", *[F.col(c).alias(n) for c, n in names.items()], "macd_signal")
    return rounded(picked, "ema_12", "ema_26", "macd_signal")


_BANDS = (
    f"trade_id, {sql_r4('prev', 'prev_price')}, {sql_r4('ap', 'avg_price_14')}, {sql_r4('sp', 'std_price_14')}, "
    f"{sql_r4('vwap', 'vwap_14')}, {sql_r4('ap - 2 * sp', 'lower_band')}, {sql_r4('ap + 2 * sp', 'upper_band')}, "
    f"{reg.SQL_FEATURES}"
)


@query(f"WITH {reg.TIED}, {reg.feature_steps('tied')} SELECT {_BANDS} FROM features")
def gold_tied_times(spark, sf_dir):
    """Order lines as trades: many equal times, and repeated ids that are removed first."""
    unique = cut_lineage(en.latest_copy_free(fx.tied_trades(spark, sf_dir)))
    wide = ft.rolling_features(unique)
    inputs = ["prev_price", "avg_price_14", "std_price_14", "vwap_14", "lower_band", "upper_band"]
    picked = wide.select("trade_id", *inputs, *reg.FEATURE_COLUMNS, "trade_intensity_1m")
    return rounded(picked, *inputs, *reg.FEATURE_COLUMNS)


_USER_TRADES = f"""trades AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id, 'U' || user_id AS symbol, value AS price,
         CAST(2 * {reg.K} * {reg.K} AS DOUBLE) AS volume, ts AS "timestamp", 'US' AS exchange FROM events)"""


@query(f"WITH {_USER_TRADES}, {reg.feature_steps('trades')} SELECT trade_id, symbol, {reg.SQL_FEATURES} FROM features")
def gold_many_symbols(spark, sf_dir):
    wide = ft.rolling_features(fx.user_trades(spark, sf_dir))
    return rounded(wide.select("trade_id", "symbol", *reg.FEATURE_COLUMNS, "trade_intensity_1m"), *reg.FEATURE_COLUMNS)


@query(
    f"""WITH {reg.TRADES} SELECT trade_id,
  {sql_r4("coalesce(stddev_samp(price) OVER (PARTITION BY symbol ORDER BY timestamp RANGE INTERVAL 1 HOUR PRECEDING), 0)", "volatility_1h")},
  count(*) OVER (PARTITION BY symbol ORDER BY timestamp RANGE INTERVAL 1 MINUTE PRECEDING) AS intensity_1m
FROM trades"""
)
def time_range_features(spark, sf_dir):
    wide = ft.time_range_features(fx.trades(spark, sf_dir))
    return rounded(wide.select("trade_id", "volatility_1h", "intensity_1m"), "volatility_1h")


@query(
    f"""WITH {reg.TRADES} SELECT trade_id,
  {sql_r4("coalesce(stddev_samp(price) OVER (PARTITION BY symbol ORDER BY timestamp RANGE INTERVAL 1 HOUR PRECEDING), 0)", "volatility_1h")},
  count(*) OVER (PARTITION BY symbol ORDER BY timestamp RANGE INTERVAL 1 MINUTE PRECEDING) AS intensity_1m
FROM trades"""
)
def time_range_blocks(spark, sf_dir):
    wide = ft.time_range_features(fx.trades(spark, sf_dir), rows_per_block=5)
    return rounded(wide.select("trade_id", "volatility_1h", "intensity_1m"), "volatility_1h")


_HOLES = f"""WITH {reg.TRADES}, holes AS (
  SELECT trade_id, CASE WHEN CAST(trade_id AS BIGINT) % 5 <> 0 THEN symbol END AS symbol,
         CASE WHEN CAST(trade_id AS BIGINT) % 7 <> 0 THEN price END AS price, timestamp FROM trades)
SELECT trade_id,
  {sql_r4("coalesce(stddev_samp(price) OVER (PARTITION BY symbol ORDER BY timestamp RANGE INTERVAL 1 HOUR PRECEDING), 0)", "volatility_1h")},
  count(*) OVER (PARTITION BY symbol ORDER BY timestamp RANGE INTERVAL 1 MINUTE PRECEDING) AS intensity_1m
FROM holes"""


def _holes(spark, sf_dir, **options):
    """Clock frames over trades of which some lack a symbol or a price."""
    trades = fx.trades(spark, sf_dir)
    number = F.col("trade_id").cast("bigint")
    trades = trades.withColumn("symbol", F.when(number % 5 != 0, F.col("symbol"))).withColumn("price", F.when(number % 7 != 0, F.col("price")))
    wide = ft.time_range_features(trades, **options)
    return rounded(wide.select("trade_id", "volatility_1h", "intensity_1m"), "volatility_1h")


@query(_HOLES)
def time_range_nulls(spark, sf_dir):
    return _holes(spark, sf_dir)


@query(_HOLES)
def time_range_nulls_blocks(spark, sf_dir):
    return _holes(spark, sf_dir, rows_per_block=7)


@query(
    f"""WITH {reg.TRADES}, {reg.feature_steps("trades")}, {reg.LABELLED}
SELECT trade_id, volume_price_surge, rsi_extreme, bollinger_break, is_anomaly FROM labelled"""
)
def anomaly_labels(spark, sf_dir):
    labelled = ft.anomaly_labels(ft.rolling_features(fx.trades(spark, sf_dir)))
    return labelled.select("trade_id", "volume_price_surge", "rsi_extreme", "bollinger_break", "is_anomaly")


@query(
    f"""WITH {reg.TRADES}, {reg.feature_steps("trades")}, {reg.LABELLED}
SELECT symbol, count(*) AS trades, CAST(sum(is_anomaly) AS BIGINT) AS anomalies, {sql_r4("avg(is_anomaly)", "rate", 6)}
FROM labelled GROUP BY symbol"""
)
def anomaly_rate(spark, sf_dir):
    labelled = ft.anomaly_labels(ft.rolling_features(fx.trades(spark, sf_dir)))
    return rounded(ft.anomaly_rate(labelled, "symbol"), "rate", digits=6)


_SPLIT = f"""{reg.TRADES}, y AS (
  SELECT trade_id, CAST(volume >= 10000 AS INTEGER) AS is_anomaly FROM trades),
q AS (
  SELECT is_anomaly, count(*) AS rows, sum(count(*)) OVER () AS n FROM y GROUP BY is_anomaly),
i AS (SELECT *, ceil(n * 0.2) AS tests, ceil(n * 0.2) * rows / n AS ideal FROM q),
quota AS (
  SELECT is_anomaly, floor(ideal) + CASE WHEN row_number() OVER (ORDER BY ideal - floor(ideal) DESC, is_anomaly)
           <= tests - sum(floor(ideal)) OVER () THEN 1 ELSE 0 END AS quota FROM i)
SELECT trade_id, is_anomaly,
       row_number() OVER (PARTITION BY is_anomaly ORDER BY md5('42:' || trade_id), trade_id) <= quota AS is_test
FROM y JOIN quota USING (is_anomaly)"""


@query(f"WITH {_SPLIT}")
def stratified_split(spark, sf_dir):
    labelled = fx.trades(spark, sf_dir).select("trade_id", (F.col("volume") >= 10000).cast("int").alias("is_anomaly"))
    return lb.stratified_split(labelled)


@query(
    f"""WITH {reg.TRADES}, silver AS ({reg.enriched("trades")}),
codes AS (
  SELECT trade_type, CAST(dense_rank() OVER (ORDER BY trade_type) - 1 AS INTEGER) AS trade_type_code
  FROM (SELECT DISTINCT trade_type FROM silver WHERE symbol <> 'CLICK' AND trade_type <> 'block'))
SELECT trade_id, trade_type, coalesce(trade_type_code, -1) AS trade_type_code,
       CAST(CASE symbol WHEN 'ERROR' THEN 0 WHEN 'PURCHASE' THEN 1 WHEN 'SIGNUP' THEN 2 WHEN 'VIEW' THEN 3 ELSE -1 END AS INTEGER)
         AS symbol_code
FROM silver LEFT JOIN codes USING (trade_type)"""
)
def ordinal_codes(spark, sf_dir):
    """Codes fitted without one symbol and one size band, then applied to all trades (unseen: -1)."""
    silver = _silver(spark, sf_dir)
    seen = silver.filter((F.col("symbol") != "CLICK") & (F.col("trade_type") != "block"))
    coded = lb.encode_ordinal(silver, lb.fit_ordinal(seen, ["symbol", "trade_type"]), ["symbol", "trade_type"])
    return coded.select("trade_id", "trade_type", "trade_type_code", "symbol_code")


_ASOF = f"""SELECT CAST(p.event_id AS VARCHAR) AS trade_id, p.user_id, p.ts AS "timestamp",
       v.value AS price_asof, v.ts AS timestamp_asof
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type <> 'purchase') v ON p.user_id = v.user_id AND p.ts >= v.ts"""


def _asof(spark, sf_dir, **options):
    rows = fx.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("trade_id"),
        "user_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("price"),
        "event_type",
    )
    bought = F.col("event_type") == "purchase"
    left = rows.filter(bought).select("trade_id", "user_id", "timestamp")
    right = rows.filter(~bought).select("user_id", "timestamp", "price")
    return asof_join(left, right, key="user_id", right_columns=["price", "timestamp"], **options)


@query(_ASOF)
def asof_features(spark, sf_dir):
    return _asof(spark, sf_dir)


@query(_ASOF)
def asof_features_blocks(spark, sf_dir):
    return _asof(spark, sf_dir, rows_per_block=20)


_ASOF_HOLES = """WITH e AS (
  SELECT *, CASE WHEN event_id % 5 <> 0 THEN user_id END AS u, CASE WHEN event_id % 7 <> 0 THEN ts END AS t FROM events),
p AS (SELECT * FROM e WHERE event_type = 'purchase'), v AS (SELECT * FROM e WHERE event_type <> 'purchase' AND u IS NOT NULL AND t IS NOT NULL)
SELECT CAST(p.event_id AS VARCHAR) AS trade_id, v.value AS price_asof
FROM (SELECT * FROM p WHERE u IS NOT NULL AND t IS NOT NULL) p ASOF LEFT JOIN v ON p.u = v.u AND p.t >= v.t
UNION ALL SELECT CAST(event_id AS VARCHAR), NULL FROM p WHERE u IS NULL OR t IS NULL"""


def _asof_holes(spark, sf_dir, **options):
    """As-of lookup where keys and times are missing on both sides."""
    number = F.col("event_id")
    rows = fx.table(spark, sf_dir, "events").select(
        number.cast("string").alias("trade_id"),
        F.when(number % 5 != 0, F.col("user_id")).alias("user_id"),
        F.when(number % 7 != 0, F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("value").alias("price"),
        "event_type",
    )
    bought = F.col("event_type") == "purchase"
    left = rows.filter(bought).select("trade_id", "user_id", "timestamp")
    right = rows.filter(~bought).select("user_id", "timestamp", "price")
    return asof_join(left, right, key="user_id", right_columns=["price"], **options).select("trade_id", "price_asof")


@query(_ASOF_HOLES)
def asof_nulls(spark, sf_dir):
    return _asof_holes(spark, sf_dir)


@query(_ASOF_HOLES)
def asof_nulls_blocks(spark, sf_dir):
    return _asof_holes(spark, sf_dir, rows_per_block=20)
