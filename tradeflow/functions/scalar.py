"""Scalar expressions of the trade domain. All built-ins: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Session hours [open, close) per clock profile, size bands, risk bands.
SESSION_HOURS = {"utc": (14, 21), "local": (9, 16)}
BLOCK_VOLUME = 10000
STANDARD_VOLUME = 100
RISK_BANDS = [(0.8, "critical"), (0.5, "high"), (0.2, "medium")]
DEFAULT_EXCHANGE = "US"


def safe_div(num: Column, den: Column, default: Column | float = 0.0) -> Column:
    """``num / den`` where the denominator is positive, else ``default`` (also for NULL)."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.when(den > 0, num / den).otherwise(fallback)


def banded(value: Column, bands: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first band whose lower bound ``value`` reaches; bands run from high to low."""
    label = F.lit(otherwise)
    for floor, name in reversed(bands):
        label = F.when(value >= floor, F.lit(name)).otherwise(label)
    return label


def session_type(ts: Column, profile: str = "utc", zone: str | None = None) -> Column:
    """regular / pre_market / after_hours by whole hour, optionally in an exchange's time zone."""
    opens, closes = SESSION_HOURS[profile]
    hour = F.hour(F.from_utc_timestamp(ts, zone) if zone else ts)
    return (
        F.when(hour < opens, "pre_market").when(hour < closes, "regular").otherwise("after_hours")
    )


def trade_type(volume: Column) -> Column:
    return banded(volume, [(BLOCK_VOLUME, "block"), (STANDARD_VOLUME, "standard")], "odd_lot")


def is_weekend(ts: Column) -> Column:
    return F.coalesce(F.dayofweek(ts).isin(1, 7), F.lit(False))


def exchange_of(symbol: Column) -> Column:
    """Venue prefix of ``VENUE:PAIR``, else the default exchange."""
    return F.when(symbol.contains(":"), F.split_part(symbol, F.lit(":"), F.lit(1))).otherwise(DEFAULT_EXCHANGE)


def bar_key(symbol: Column, ts: Column) -> Column:
    return F.md5(F.concat_ws("_", symbol, ts))


def risk_level(probability: Column) -> Column:
    return banded(probability, RISK_BANDS, "low")


def prediction_label(flag: Column) -> Column:
    return F.when(flag == 1, "anomaly").otherwise("normal")


def sigmoid_calibrated(raw: Column) -> Column:
    """Logistic of ``-2 * raw``: a low decision value becomes a high anomaly score."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(2.0) * raw))


def report_round(value: Column, digits: int = 4) -> Column:
    """Half-even rounding for reports; thresholds compare the unrounded value."""
    return F.bround(value, digits)


def gauge(value: Column, threshold: Column | float) -> Column:
    """Percent of the threshold used, capped at 100."""
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.least(value / limit * 100, F.lit(100.0))


def gauge_state(percent: Column) -> Column:
    return F.when(percent > 80, "danger").when(percent > 50, "warning").otherwise("ok")


def short_run_id(run_id: Column) -> Column:
    return F.when(F.length(run_id) > 0, F.substring(run_id, 1, 8)).otherwise("N/A")


def alert_message(*lines: Column, limit: int | None = 500) -> Column:
    """Lines as one text, cut at ``limit`` characters; None keeps all of it."""
    text = F.concat_ws("\n", *lines)
    return text if limit is None else F.substring(text, 1, limit)


def utc_now() -> Column:
    return F.to_utc_timestamp(F.current_timestamp(), "UTC")


def hash_bucket(salt: str, key: Column, buckets: int = 100) -> Column:
    """Stable bucket 0..buckets-1 from the first 32 bits of an md5."""
    digest = F.md5(F.concat(F.lit(salt), key.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")
