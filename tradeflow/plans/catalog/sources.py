"""Feed decoding and file sources. Payloads are built by Spark from the given events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeflow.plans import fixtures as fx
from tradeflow.plans.catalog import registry as reg
from tradeflow.plans.catalog.registry import query
from tradeflow.session import fresh_path
from tradeflow.sources import decode, readers, sinks


def tick_lines(spark, sf_dir):
    """One feed line per event: trades with one or two elements, pings, broken lines, missing fields."""
    e = fx.table(spark, sf_dir, "events")
    venue = F.concat(F.lit("BINANCE:"), F.upper("event_type"))
    symbol = F.when(F.col("event_id") % 5 == 0, venue).otherwise(F.upper("event_type"))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first = F.struct(
        F.when(F.col("event_id") % 17 != 0, symbol).alias("s"),
        F.when(F.col("event_id") % 19 != 0, F.col("value")).alias("p"),
        F.when(F.col("event_id") % 23 != 0, F.col("user_id").cast("double")).alias("v"),
        F.floor(micros / 1000).alias("t"),
    )
    second = F.struct(
        F.lit("X").alias("s"), F.lit(1.5).alias("p"), F.lit(2.0).alias("v"), F.col("event_id").alias("t")
    )
    data = F.when(F.col("event_id") % 3 == 0, F.array(first, second)).otherwise(F.array(first))
    trade = F.to_json(F.struct(F.lit("trade").alias("type"), data.alias("data")))
    line = (
        F.when(F.col("event_id") % 11 == 0, '{"type":"ping"}')
        .when(F.col("event_id") % 13 == 0, F.concat(F.lit('{"type":"trade","data":['), F.col("event_id").cast("string")))
        .otherwise(trade)
    )
    return e.select(line.alias("value"))


_USED = "event_id % 11 <> 0 AND event_id % 13 <> 0"
_SYMBOL = "CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 5 = 0 THEN 'BINANCE:' || upper(event_type) ELSE upper(event_type) END"


@query(
    f"""SELECT {_SYMBOL} AS symbol, CASE WHEN event_id % 19 = 0 THEN 0.0 ELSE value END AS price,
       CASE WHEN event_id % 23 = 0 THEN 0.0 ELSE CAST(user_id AS DOUBLE) END AS volume,
       date_trunc('millisecond', ts) AS "timestamp",
       CASE WHEN event_id % 17 <> 0 AND event_id % 5 = 0 THEN 'BINANCE' ELSE 'US' END AS exchange
FROM events WHERE {_USED}
UNION ALL
SELECT 'X', 1.5, 2.0, make_timestamp(event_id * 1000), 'US' FROM events WHERE {_USED} AND event_id % 3 = 0"""
)
def decode_ticks(spark, sf_dir):
    return decode.decode_ticks(tick_lines(spark, sf_dir)).drop("trade_id")


@query(
    f"""SELECT CASE WHEN event_id % 11 = 0 THEN 'other' WHEN event_id % 13 = 0 THEN 'malformed' ELSE 'trade' END AS kind,
       count(*) AS lines, CAST(sum(CASE WHEN {_USED} THEN 1 + CAST(event_id % 3 = 0 AS INTEGER) ELSE 0 END) AS BIGINT) AS trades
FROM events GROUP BY kind"""
)
def classify_ticks(spark, sf_dir):
    return decode.classify_ticks(tick_lines(spark, sf_dir))


def bar_payloads(spark, sf_dir):
    """One payload per symbol and day (a day has at most 24 hourly bars), plus failed answers."""
    hourly = fx.bars(spark, sf_dir, "1 hour")
    entry = F.map_from_arrays(
        F.array(*[F.lit(k) for k in decode.BAR_FIELDS.values()]),
        F.array(*[F.col(c).cast("string") for c in decode.BAR_FIELDS]),
    )
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    daily = hourly.groupBy("symbol", F.to_date("timestamp").alias("day")).agg(
        F.map_from_entries(F.collect_list(F.struct(stamp, entry))).alias("series")
    )
    series = F.to_json(F.create_map(F.concat(F.lit(decode.SERIES_PREFIX), F.lit(" (60min)")), F.col("series")))
    day = F.dayofmonth("day")
    payload = (
        F.when(day == 13, '{"Error Message":"bad call"}')
        .when(day == 14, '{"Note":"slow down"}')
        .when(day == 15, '{"Information":"limit"}')
        .when(day == 16, '{"Meta Data":{}}')
        .otherwise(series)
    )
    return daily.select("symbol", payload.alias("payload"))


_BARS = f"""{reg.TRADES}, bars AS (
  SELECT symbol, date_trunc('hour', "timestamp") AS "timestamp", arg_min(price, "timestamp") AS open, max(price) AS high,
         min(price) AS low, arg_max(price, "timestamp") AS close, CAST(sum(volume) AS BIGINT) AS volume
  FROM trades GROUP BY symbol, date_trunc('hour', "timestamp"))"""
_KEPT = 'day("timestamp") NOT BETWEEN 13 AND 16'


@query(f"WITH {_BARS} SELECT *, '60min' AS interval FROM bars WHERE {_KEPT}")
def decode_bars(spark, sf_dir):
    return decode.decode_bars(bar_payloads(spark, sf_dir), interval="60min")


@query(f"WITH {_BARS} SELECT *, '60min' AS interval FROM bars WHERE {_KEPT}")
def decode_bars_variant(spark, sf_dir):
    return decode.decode_bars_variant(bar_payloads(spark, sf_dir), interval="60min")


@query(
    f"""WITH {_BARS}, days AS (SELECT DISTINCT symbol, day("timestamp") AS d FROM bars)
SELECT CASE WHEN d = 13 THEN 'error' WHEN d IN (14, 15) THEN 'rate_limited' WHEN d = 16 THEN 'unknown' ELSE 'data' END AS kind,
       count(*) AS payloads FROM days GROUP BY kind"""
)
def classify_bars(spark, sf_dir):
    return decode.classify_bars(bar_payloads(spark, sf_dir))


_MAPPED = """SELECT md5(symbol || '_' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')) AS trade_id, symbol, close AS price,
       CAST(volume AS DOUBLE) AS volume, "timestamp", 'US' AS exchange FROM bars"""


@query(f"WITH {_BARS} {_MAPPED}")
def bars_to_trades(spark, sf_dir):
    return decode.bars_to_trades(fx.bars(spark, sf_dir))


@query(f"WITH {_BARS} SELECT * FROM trades UNION ALL {_MAPPED}")
def all_trades(spark, sf_dir):
    return decode.all_trades(fx.trades(spark, sf_dir), fx.bars(spark, sf_dir))


@query(f'WITH {reg.TRADES} SELECT * REPLACE (date_trunc(\'millisecond\', "timestamp") AS "timestamp") FROM trades')
def json_source(spark, sf_dir):
    """Trades written as JSON files in symbol-time order and read back under the declared schema."""
    folder = fresh_path(spark, "json-trades")
    sinks.cluster_layout(fx.trades(spark, sf_dir)).write.json(folder)
    return readers.read_trades_json(spark, folder).drop("_ingested_at", "_source_file")


@query(f"WITH {_BARS} SELECT *, '1h' AS interval FROM bars")
def csv_source(spark, sf_dir):
    """Bars exported as CSV with a header and read back under the declared schema."""
    folder = fresh_path(spark, "csv-bars")
    bars = fx.bars(spark, sf_dir).withColumn("interval", F.lit("1h"))
    sinks.export_csv(bars.withColumn("fetch_timestamp", F.col("timestamp")), folder)
    return readers.read_bars_csv(spark, folder).drop("_ingested_at", "fetch_timestamp")


@query("SELECT count(*) AS rows, TRUE AS stamped_in_the_run, TRUE AS file_named FROM events")
def ingest_metadata(spark, sf_dir):
    """Arrival time and source file of rows read from JSON files."""
    folder = fresh_path(spark, "arrivals")
    fx.trades(spark, sf_dir).write.json(folder)
    begun = F.lit(spark.range(1).select(F.current_timestamp()).first()[0])
    rows = readers.read_trades_json(spark, folder)
    within = F.col("_ingested_at").between(begun, begun + F.expr("INTERVAL 1 HOUR"))
    return rows.agg(
        F.count("*").alias("rows"), F.bool_and(within).alias("stamped_in_the_run"), F.bool_and(F.col("_source_file").contains("/arrivals-")).alias("file_named")
    )


@query(f"""WITH {reg.TRADES} SELECT * FROM trades WHERE symbol = 'CLICK' OR "timestamp" >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY""")
def zorder_rows(spark, sf_dir):
    """Trades of one symbol or of the last days, read back from files laid out along a z-curve."""
    folder, trades = fresh_path(spark, "zorder"), fx.trades(spark, sf_dir)
    sinks.zorder_layout(trades, partitions=16).write.parquet(folder)
    newest = trades.agg(F.max("timestamp")).first()[0]
    stored = spark.read.schema(trades.schema).parquet(folder)
    return stored.filter((F.col("symbol") == "CLICK") | (F.col("timestamp") >= F.lit(newest) - F.expr("INTERVAL 3 DAYS")))
