"""Rolling per-symbol features and anomaly rules.

Every feature reads a fixed number of earlier trades of the symbol, so the block computes over
``(symbol, block)`` windows with copied history and needs a single shuffle of the trades.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.functions.scalar import safe_div
from tradeflow.operators.blocks import HALO, Blocks, fit_blocks, with_history
from tradeflow.operators.ema import EMA_HISTORY, ema_columns
from tradeflow.operators.timerange import time_range_features  # noqa: F401

KEYS = ("symbol",)
ORDER = ("timestamp", "trade_id")

# Frame lengths in trades, and the neutral readings of empty frames.
FRAME = 14
FAST, SLOW = 12, 26
NEUTRAL_BOLLINGER = 0.5
FLAT_RSI = {"sma": 50.0, "ema": 0.0}
BAND_WIDTHS = 2
SMA_HISTORY = SLOW - 1

# The output contract.
FEATURES = [
    "price_change_pct",
    "volume_zscore",
    "price_volatility_1h",
    "trade_intensity_1m",
    "vwap_deviation",
    "rsi_14",
    "macd_signal",
    "bollinger_position",
    "bid_ask_spread_pct",
]
GOLD_COLUMNS = [
    "trade_id",
    "symbol",
    "price",
    "volume",
    "timestamp",
    "exchange",
    "hour_of_day",
    "minute_of_hour",
    "day_of_week",
    "session_type",
    "trade_type",
    *FEATURES,
    "_processed_at",
]

# A spread below this share of the level is rounding noise of a constant frame, not variation.
_NOISE = 1e-9


def _spread(std: Column, level: Column) -> Column:
    """The standard deviation, with the rounding noise of constant frames set to exactly 0."""
    return F.when(std <= _NOISE * F.abs(level), F.lit(0.0)).otherwise(std)


def rolling_features(
    trades: DataFrame,
    mode: str = "sma",
    flat_rsi: float | None = None,
    rows_per_block: int | None = None,
    blocks: Blocks | None = None,
) -> DataFrame:
    """All input columns plus the nine features and their inputs (previous price, bands, vwap).

    ``mode`` picks the MACD averages: plain means of the last 12 and 26 trades (``sma``) or
    recursive exponential averages (``ema``). ``flat_rsi`` is the RSI of a frame without losses;
    by default 50 in ``sma`` mode and 0 in ``ema`` mode. Equal timestamps are ordered by trade id.
    """
    if mode not in FLAT_RSI:
        raise ValueError(f"mode must be one of {sorted(FLAT_RSI)}, not {mode!r}")
    flat = FLAT_RSI[mode] if flat_rsi is None else flat_rsi
    blocks = blocks or fit_blocks(trades, KEYS, ORDER, rows_per_block)
    rows = with_history(trades, blocks, EMA_HISTORY if mode == "ema" else SMA_HISTORY)

    trail = blocks.window()
    frame = trail.rowsBetween(1 - FRAME, 0)
    price, volume = F.col("price"), F.col("volume")

    # Stage 1: everything that reads the raw columns. One sort serves all of these frames.
    stage = rows.select(
        "*",
        F.lag("price").over(trail).alias("prev_price"),
        F.avg("price").over(frame).alias("avg_price_14"),
        F.stddev_samp("price").over(frame).alias("_std_price"),
        F.avg("volume").over(frame).alias("avg_volume_14"),
        F.stddev_samp("volume").over(frame).alias("_std_volume"),
        F.sum("volume").over(frame).alias("_volume_14"),
        F.sum(price * volume).over(frame).alias("_value_14"),
        F.count(F.lit(1)).over(frame).alias("trade_intensity_1m"),
        *_macd_inputs(mode, blocks),
    )

    # Stage 2: row arithmetic, and the one derived series (price moves) that needs a frame again.
    prev = F.col("prev_price")
    move = price - F.coalesce(prev, price)
    stage = stage.select(
        "*",
        _spread(F.col("_std_price"), F.col("avg_price_14")).alias("std_price_14"),
        _spread(F.col("_std_volume"), F.col("avg_volume_14")).alias("std_volume_14"),
        safe_div(F.col("_value_14"), F.col("_volume_14"), default=price).alias("vwap_14"),
        F.avg(F.greatest(move, F.lit(0.0))).over(frame).alias("avg_gain"),
        F.avg(F.greatest(-move, F.lit(0.0))).over(frame).alias("avg_loss"),
    )

    # The recursive averages sort runs of rows anew, so they come after every time-ordered frame.
    if mode == "ema":
        stage = ema_columns(stage, "price", {"fast_average": FAST, "slow_average": SLOW}, blocks)

    # Stage 3: the features themselves. NULL inputs (first trade of a symbol) give the neutral value.
    level, std, vwap = F.col("avg_price_14"), F.col("std_price_14"), F.col("vwap_14")
    lower, upper = level - BAND_WIDTHS * std, level + BAND_WIDTHS * std
    strength = F.col("avg_gain") / F.col("avg_loss")
    zero = F.lit(0.0)
    features = {
        "price_change_pct": safe_div((price - prev) * 100, prev),
        "volume_zscore": safe_div(volume - F.col("avg_volume_14"), F.col("std_volume_14")),
        "price_volatility_1h": std,
        "trade_intensity_1m": F.col("trade_intensity_1m"),
        "vwap_deviation": safe_div((price - vwap) * 100, vwap),
        "rsi_14": F.when(F.col("avg_loss") > 0, 100 - 100 / (1 + strength)).otherwise(F.lit(flat)),
        "macd_signal": F.col("fast_average") - F.col("slow_average"),
        "bollinger_position": safe_div(price - lower, upper - lower, default=NEUTRAL_BOLLINGER),
        "bid_ask_spread_pct": safe_div(std * 100, price),
    }
    inputs = ["prev_price", "avg_price_14", "std_price_14", "avg_volume_14", "std_volume_14", "vwap_14"]
    own = stage.filter(~F.col(HALO)) if blocks.cuts is not None else stage
    return own.select(
        *trades.columns,
        *inputs,
        lower.alias("lower_band"),
        upper.alias("upper_band"),
        *["avg_gain", "avg_loss", "fast_average", "slow_average"],
        *[
            (expr if name == "trade_intensity_1m" else F.coalesce(expr, zero)).alias(name)
            for name, expr in features.items()
        ],
    )


def _macd_inputs(mode: str, blocks: Blocks) -> list[Column]:
    if mode == "ema":
        return []
    trail = blocks.window()
    return [
        F.avg("price").over(trail.rowsBetween(1 - FAST, 0)).alias("fast_average"),
        F.avg("price").over(trail.rowsBetween(1 - SLOW, 0)).alias("slow_average"),
    ]


def gold_features(silver: DataFrame, mode: str = "sma", **options) -> DataFrame:
    """The 21-column gold table from enriched trades. Columns the input lacks are left out."""
    wide = rolling_features(silver, mode=mode, **options)
    return wide.select([c for c in GOLD_COLUMNS if c in wide.columns])


# Limits of the anomaly rules.
VOLUME_Z, PRICE_MOVE_PCT = 3.0, 2.0
RSI_LOW, RSI_HIGH = 15, 85


def anomaly_labels(
    features: DataFrame, volume_threshold: float = VOLUME_Z, price_threshold: float = PRICE_MOVE_PCT
) -> DataFrame:
    """Add one flag per reason and ``is_anomaly`` (1 if any reason holds)."""
    surge = (F.abs("volume_zscore") > volume_threshold) & (F.abs("price_change_pct") > price_threshold)
    rsi = (F.col("rsi_14") > RSI_HIGH) | (F.col("rsi_14") < RSI_LOW)
    band = (F.col("bollinger_position") > 1.0) | (F.col("bollinger_position") < 0.0)
    return features.select(
        "*",
        surge.alias("volume_price_surge"),
        rsi.alias("rsi_extreme"),
        band.alias("bollinger_break"),
        (surge | rsi | band).cast("int").alias("is_anomaly"),
    )


def anomaly_rate(labelled: DataFrame, *by: str) -> DataFrame:
    """Trades, anomalies and their share, overall or per ``by``."""
    return labelled.groupBy(*by).agg(
        F.count(F.lit(1)).alias("trades"),
        F.sum("is_anomaly").cast("bigint").alias("anomalies"),
        F.avg("is_anomaly").alias("rate"),
    )
