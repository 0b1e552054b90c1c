"""Decoders for raw feed payloads held as text lines. Batch and stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.functions.scalar import bar_key, exchange_of

TICK_ENVELOPE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("s", T.StringType()),
                        T.StructField("p", T.DoubleType()),
                        T.StructField("v", T.DoubleType()),
                        T.StructField("t", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)

# Payload keys of the bar service.
SERIES_PREFIX = "Time Series"
ERROR_KEYS = ["Error Message"]
LIMIT_KEYS = ["Note", "Information"]
BAR_FIELDS = {"open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close", "volume": "5. volume"}


def _envelope(line: Column) -> Column:
    return F.from_json(line, TICK_ENVELOPE, {"mode": "PERMISSIVE"})


def decode_ticks(lines: DataFrame, text: str = "value") -> DataFrame:
    """One trade per element of a ``trade`` envelope; pings and malformed lines give no rows.

    Missing fields take neutral values. The trade id is a digest of the line and the element's
    position, so decoding the same line again gives the same id and later deduplication works.
    """
    ticks = lines.select(F.col(text).alias("_line"), _envelope(F.col(text)).alias("_e")).filter(
        F.col("_e.type") == "trade"
    )
    each = ticks.select("_line", F.posexplode("_e.data").alias("_pos", "_tick"))
    symbol = F.coalesce(F.col("_tick.s"), F.lit(""))
    return each.select(
        F.md5(F.concat_ws("#", "_line", "_pos")).alias("trade_id"),
        symbol.alias("symbol"),
        F.coalesce(F.col("_tick.p"), F.lit(0.0)).alias("price"),
        F.coalesce(F.col("_tick.v"), F.lit(0.0)).alias("volume"),
        F.timestamp_millis(F.coalesce(F.col("_tick.t"), F.lit(0))).alias("timestamp"),
        exchange_of(symbol).alias("exchange"),
    )


def classify_ticks(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines per kind (trade, other, malformed) and the trades they carry, so nothing vanishes unseen."""
    kind = F.when(F.col("_e.type").isNull(), "malformed").when(F.col("_e.type") == "trade", "trade").otherwise("other")
    size = F.when(kind == "trade", F.greatest(F.coalesce(F.size("_e.data"), F.lit(0)), F.lit(0))).otherwise(0)
    return (
        lines.select(_envelope(F.col(text)).alias("_e"))
        .groupBy(kind.alias("kind"))
        .agg(F.count(F.lit(1)).alias("lines"), F.sum(size).cast("bigint").alias("trades"))
    )


def payload_kind(payload: Column) -> Column:
    """data / error / rate_limited / unknown, by the keys of the payload."""
    keys = F.json_object_keys(payload)

    def has_any(names: list[str]) -> Column:
        return F.arrays_overlap(keys, F.array(*[F.lit(n) for n in names]))

    return F.coalesce(
        F.when(has_any(ERROR_KEYS), "error")
        .when(has_any(LIMIT_KEYS), "rate_limited")
        .when(F.exists(keys, lambda k: k.startswith(SERIES_PREFIX)), "data"),
        F.lit("unknown"),
    )


def classify_bars(payloads: DataFrame, text: str = "payload") -> DataFrame:
    return payloads.groupBy(payload_kind(F.col(text)).alias("kind")).agg(F.count(F.lit(1)).alias("payloads"))


def decode_bars(
    payloads: DataFrame, text: str = "payload", symbol: str = "symbol", interval: str = "5min"
) -> DataFrame:
    """One bar per entry of the payload's time series, whatever its interval key is called."""
    sections = F.from_json(F.col(text), "map<string,string>")
    series_name = F.get(F.filter(F.map_keys(sections), lambda k: k.startswith(SERIES_PREFIX)), F.lit(0))
    data = payloads.filter(payload_kind(F.col(text)) == "data").select(
        F.col(symbol).alias("symbol"),
        F.from_json(F.element_at(sections, series_name), "map<string,map<string,string>>").alias("_series"),
    )
    each = data.select("symbol", F.explode("_series").alias("_at", "_bar"))
    prices = [
        F.col("_bar").getItem(BAR_FIELDS[name]).try_cast("double").alias(name) for name in ("open", "high", "low", "close")
    ]
    return each.select(
        "symbol",
        F.col("_at").try_cast("timestamp").alias("timestamp"),
        *prices,
        F.col("_bar").getItem(BAR_FIELDS["volume"]).try_cast("bigint").alias("volume"),
        F.lit(interval).alias("interval"),
    )


def decode_bars_variant(
    payloads: DataFrame, text: str = "payload", symbol: str = "symbol", interval: str = "5min"
) -> DataFrame:
    """The rows of ``decode_bars`` by the VARIANT type: each payload is parsed once, whatever its keys are called.

    Payloads that don't parse, or whose series isn't an object, give no rows; a field that doesn't parse is NULL.
    """
    tvf = payloads.sparkSession.tvf
    # The first series of a payload counts; a variant's own keys are sorted.
    name = F.get(F.filter(F.json_object_keys(F.col(text)), lambda k: k.startswith(SERIES_PREFIX)), F.lit(0))
    data = payloads.filter(payload_kind(F.col(text)) == "data")
    parsed = data.select(F.col(symbol).alias("symbol"), name.alias("_name"), F.try_parse_json(F.col(text)).alias("_payload"))
    sections = parsed.lateralJoin(tvf.variant_explode(F.col("_payload").outer()))
    series = sections.filter(F.col("key") == F.col("_name")).select("symbol", F.col("value").alias("_series"))
    each = series.lateralJoin(tvf.variant_explode(F.col("_series").outer())).select("symbol", F.col("key").alias("_at"), F.col("value").alias("_bar"))

    def field(name: str, kind: str) -> Column:
        # Text first: a number given as text parses like one given as a number.
        return F.try_variant_get("_bar", f"$['{BAR_FIELDS[name]}']", "string").try_cast(kind).alias(name)

    prices = [field(name, "double") for name in ("open", "high", "low", "close")]
    return each.select("symbol", F.col("_at").try_cast("timestamp").alias("timestamp"), *prices, field("volume", "bigint"), F.lit(interval).alias("interval"))


def bars_to_trades(bars: DataFrame) -> DataFrame:
    """Bars in trade shape: the close is the price, and the key is a digest of symbol and time."""
    return bars.select(
        bar_key(F.col("symbol"), F.col("timestamp")).alias("trade_id"),
        "symbol",
        F.col("close").alias("price"),
        F.col("volume").cast("double").alias("volume"),
        "timestamp",
        F.lit("US").alias("exchange"),
    )


def all_trades(ticks: DataFrame, bars: DataFrame) -> DataFrame:
    """Ticks and bars as one table of trades (union by column name)."""
    return ticks.select(*bars_to_trades(bars).columns).unionByName(bars_to_trades(bars))
