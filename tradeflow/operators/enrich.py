"""Raw trades to clean, enriched, de-duplicated trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions import scalar
from tradeflow.operators.quality import enforce, silver_rules

CLEAN_COLUMNS = ["trade_id", "symbol", "price", "volume", "timestamp", "exchange"]


def typed(raw: DataFrame) -> DataFrame:
    """Cast to the trade types; text that does not parse becomes NULL rather than an error."""

    def to(name: str, kind: str) -> Column:
        return F.col(name).try_cast(kind).alias(name)

    return raw.select(
        "trade_id", "symbol", to("price", "double"), to("volume", "double"), to("timestamp", "timestamp"), "exchange"
    )


def enrich(trades: DataFrame, session: str = "utc", zone: str | None = None) -> DataFrame:
    """Clock fields, session and size band, then the NULL fills (a missing volume is an odd lot)."""
    ts = F.col("timestamp")
    return trades.select(
        "*",
        F.hour(ts).alias("hour_of_day"),
        F.minute(ts).alias("minute_of_hour"),
        F.dayofweek(ts).alias("day_of_week"),
        scalar.is_weekend(ts).alias("is_weekend"),
        scalar.session_type(ts, session, zone).alias("session_type"),
        scalar.trade_type(F.col("volume")).alias("trade_type"),
    ).fillna({"volume": 0.0, "exchange": scalar.DEFAULT_EXCHANGE})


def latest_copy_free(trades: DataFrame, key: str = "trade_id") -> DataFrame:
    """Keep one row per key: the earliest by time, ties broken by the remaining columns.

    The rank-1 filter also runs before the shuffle, so the copies of one key shrink to one row per
    task and a key with very many copies does not overload the task that finishes it.
    """
    rest = sorted(c for c in trades.columns if c not in (key, "timestamp"))
    first = Window.partitionBy(key).orderBy("timestamp", *rest)
    return trades.withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") == 1).drop("_nth")


def bronze_to_silver(
    bronze: DataFrame,
    session: str = "utc",
    zone: str | None = None,
    allow_empty_symbol: bool = False,
    stamp: bool = True,
) -> DataFrame:
    """The batch plan: cast, drop or fail on the quality rules, de-duplicate, enrich.

    Rules run before the de-duplication, so an invalid copy never hides a valid one.
    """
    valid = enforce(typed(bronze), silver_rules(allow_empty_symbol))
    silver = enrich(latest_copy_free(valid), session, zone)
    return silver.withColumn("_processed_at", F.current_timestamp()) if stamp else silver


def session_summary(silver: DataFrame) -> DataFrame:
    """Trades, volume and mean price per session and size band."""
    return silver.groupBy("session_type", "trade_type").agg(
        F.count(F.lit(1)).alias("trades"),
        F.sum("volume").alias("total_volume"),
        F.avg("price").alias("avg_price"),
    )
