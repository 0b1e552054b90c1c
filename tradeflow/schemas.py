"""Declared table contracts. Sources never infer a schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TRADE = T.StructType(
    [
        T.StructField("trade_id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("exchange", T.StringType()),
    ]
)

BAR = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("interval", T.StringType()),
        T.StructField("fetch_timestamp", T.TimestampType()),
    ]
)

INFERENCE_LOG = T.StructType(
    [
        T.StructField("prediction", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("execution_duration_ms", T.DoubleType()),
    ]
)

DRIFT_AUDIT = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("reference_size", T.LongType()),
        T.StructField("current_size", T.LongType()),
        T.StructField("overall_drift", T.BooleanType()),
        T.StructField("drifted_features", T.StringType()),
        T.StructField("feature_drift_details", T.StringType()),
    ]
)

RETRAINING_AUDIT = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)

CHAMPION_AUDIT = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("decision", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("challenger_model_type", T.StringType()),
        T.StructField("challenger_run_id", T.StringType()),
        T.StructField("primary_metric_value", T.DoubleType()),
        T.StructField("improvement", T.StringType()),
    ]
)

ALERT_AUDIT = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("data", T.StringType()),
    ]
)

# The feature contract (column names and their order).
NUMERIC_FEATURES = [
    "price",
    "volume",
    "price_change_pct",
    "volume_zscore",
    "price_volatility_1h",
    "trade_intensity_1m",
    "vwap_deviation",
    "bid_ask_spread_pct",
    "rsi_14",
    "macd_signal",
    "bollinger_position",
    "hour_of_day",
    "minute_of_hour",
]
CATEGORICAL_FEATURES = ["symbol", "exchange", "trade_type", "session_type"]
TARGET = "is_anomaly"

# Columns that the layer checks require.
REQUIRED_SILVER = ["trade_id", "symbol", "price", "volume", "timestamp", "session_type", "trade_type"]
REQUIRED_GOLD = [
    "price_change_pct",
    "volume_zscore",
    "price_volatility_1h",
    "trade_intensity_1m",
    "vwap_deviation",
    "rsi_14",
    "macd_signal",
    "bollinger_position",
]


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise naming every column of the contract it lacks."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return df


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Select and cast the contract's columns in order; a missing column is an error."""
    require_columns(df, contract.names)
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in contract.fields])
