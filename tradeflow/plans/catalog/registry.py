"""Registration of catalogue queries and the SQL fragments they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a plan under its function name, with the SQL that must give the same rows."""

    def add(plan: Query) -> Query:
        QUERIES[plan.__name__] = plan
        if sql is not None:
            ORACLES[plan.__name__] = sql
        return plan

    return add


def _nudge(digits: int) -> str:
    """A small shift that keeps exact halves (averages over 8 trades, say) off the rounding edge."""
    return f"1.37e-{digits + 2}"


def r4(column: Column | str, digits: int = 4) -> Column:
    """Rounded for comparison; adding 0 turns a negative zero into a plain one."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column + F.lit(float(_nudge(digits))), digits) + F.lit(0.0)


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.select([r4(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


def sql_r4(expr: str, name: str, digits: int = 4) -> str:
    return f"round(({expr}) + {_nudge(digits)}, {digits}) + 0.0 AS {name}"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# Shared CTEs. Each ends without a comma.
TRADES = f"""trades AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id, upper(event_type) AS symbol, value AS price,
         CAST(2 * {K} * {K} AS DOUBLE) AS volume, ts AS "timestamp", 'US' AS exchange
  FROM events)"""

DIRTY = f"""dirty AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id,
         CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN '' ELSE upper(event_type) END AS symbol,
         CASE WHEN event_id % 97 = 0 THEN -value ELSE value END AS price,
         CASE WHEN event_id % 79 = 0 THEN NULL ELSE CAST(2 * {K} * {K} AS DOUBLE) END AS volume,
         ts AS "timestamp", CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'US' END AS exchange
  FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 50 = 0))"""

TIED = """tied AS (
  SELECT DISTINCT ON (trade_id) * FROM (
    SELECT l_orderkey || '-' || l_linenumber AS trade_id, CAST(l_suppkey AS VARCHAR) AS symbol,
           l_extendedprice AS price, l_quantity AS volume, l_shipdate AS "timestamp", 'US' AS exchange
    FROM lineitem)
  ORDER BY trade_id, "timestamp", exchange, price, symbol, volume)"""


def enriched(source: str, opens: int = 14, closes: int = 21) -> str:
    """SELECT of a trade table plus clock fields, session, size band and NULL fills."""
    return f"""SELECT trade_id, symbol, price, coalesce(volume, 0.0) AS volume, "timestamp",
       coalesce(exchange, 'US') AS exchange,
       CAST(hour("timestamp") AS INTEGER) AS hour_of_day, CAST(minute("timestamp") AS INTEGER) AS minute_of_hour,
       CAST(dayofweek("timestamp") + 1 AS INTEGER) AS day_of_week,
       dayofweek("timestamp") IN (0, 6) AS is_weekend,
       CASE WHEN hour("timestamp") < {opens} THEN 'pre_market' WHEN hour("timestamp") < {closes} THEN 'regular'
            ELSE 'after_hours' END AS session_type,
       CASE WHEN volume >= 10000 THEN 'block' WHEN volume >= 100 THEN 'standard' ELSE 'odd_lot' END AS trade_type
  FROM {source}"""


def silver(session: tuple[int, int] = (14, 21), symbol_rule: str = "symbol IS NOT NULL AND symbol != ''") -> str:
    return f"""{DIRTY}, valid AS (
  SELECT DISTINCT * FROM dirty WHERE price > 0 AND {symbol_rule}),
silver AS ({enriched("valid", *session)})"""


def feature_steps(source: str, flat_rsi: str = "50.0", macd: str = "sma", extra: str = "") -> str:
    """CTEs ending in ``features``: the nine rolling features over ``source``."""
    averages = (
        "avg(price) OVER (t ROWS 11 PRECEDING) AS fast, avg(price) OVER (t ROWS 25 PRECEDING) AS slow"
        if macd == "sma"
        else "row_number() OVER t AS rn"
    )
    joined = "" if macd == "sma" else "JOIN ema USING (symbol, rn)"
    recursion = (
        ""
        if macd == "sma"
        else f"""numbered AS MATERIALIZED (
  SELECT symbol, price, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp", trade_id) AS rn FROM {source}),
ema AS (
  SELECT symbol, rn, price AS fast, price AS slow FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n.rn, n.price * (2.0 / 13) + e.fast * (1 - 2.0 / 13), n.price * (2.0 / 27) + e.slow * (1 - 2.0 / 27)
  FROM ema e JOIN numbered n ON n.symbol = e.symbol AND n.rn = e.rn + 1),
"""
    )
    return f"""{recursion}framed AS (
  SELECT *, lag(price) OVER t AS prev, avg(price) OVER f AS ap, stddev_samp(price) OVER f AS sp0,
         avg(volume) OVER f AS av, stddev_samp(volume) OVER f AS sv0, sum(volume) OVER f AS vol14,
         sum(price * volume) OVER f AS val14, count(*) OVER f AS trade_intensity_1m, {averages}
  FROM {source}
  WINDOW t AS (PARTITION BY symbol ORDER BY "timestamp", trade_id),
         f AS (PARTITION BY symbol ORDER BY "timestamp", trade_id ROWS 13 PRECEDING)),
moved AS (
  SELECT *, CASE WHEN sp0 <= 1e-9 * abs(ap) THEN 0.0 ELSE sp0 END AS sp,
         CASE WHEN sv0 <= 1e-9 * abs(av) THEN 0.0 ELSE sv0 END AS sv,
         CASE WHEN vol14 > 0 THEN val14 / vol14 ELSE price END AS vwap,
         greatest(price - coalesce(prev, price), 0.0) AS gain,
         greatest(coalesce(prev, price) - price, 0.0) AS loss
  FROM framed),
strength AS (
  SELECT *, avg(gain) OVER f AS ag, avg(loss) OVER f AS al FROM moved
  WINDOW f AS (PARTITION BY symbol ORDER BY "timestamp", trade_id ROWS 13 PRECEDING)),
features AS (
  SELECT *{extra},
    CASE WHEN prev > 0 THEN (price - prev) * 100 / prev ELSE 0.0 END AS price_change_pct,
    CASE WHEN sv > 0 THEN (volume - av) / sv ELSE 0.0 END AS volume_zscore,
    coalesce(sp, 0.0) AS price_volatility_1h,
    CASE WHEN vwap > 0 THEN (price - vwap) * 100 / vwap ELSE 0.0 END AS vwap_deviation,
    CASE WHEN al > 0 THEN 100 - 100 / (1 + ag / al) ELSE {flat_rsi} END AS rsi_14,
    fast - slow AS macd_signal,
    CASE WHEN sp > 0 THEN (price - (ap - 2 * sp)) / ((ap + 2 * sp) - (ap - 2 * sp)) ELSE 0.5 END AS bollinger_position,
    CASE WHEN price > 0 THEN coalesce(sp, 0.0) * 100 / price ELSE 0.0 END AS bid_ask_spread_pct
  FROM strength {joined})"""


FEATURE_COLUMNS = [
    "price_change_pct",
    "volume_zscore",
    "price_volatility_1h",
    "vwap_deviation",
    "rsi_14",
    "macd_signal",
    "bollinger_position",
    "bid_ask_spread_pct",
]
SQL_FEATURES = ", ".join(sql_r4(c, c) for c in FEATURE_COLUMNS) + ", trade_intensity_1m"

LABELLED = """labelled AS (
  SELECT *, (abs(volume_zscore) > 3 AND abs(price_change_pct) > 2) AS volume_price_surge,
         (rsi_14 > 85 OR rsi_14 < 15) AS rsi_extreme,
         (bollinger_position > 1 OR bollinger_position < 0) AS bollinger_break,
         CAST((abs(volume_zscore) > 3 AND abs(price_change_pct) > 2) OR rsi_14 > 85 OR rsi_14 < 15
              OR bollinger_position > 1 OR bollinger_position < 0 AS INTEGER) AS is_anomaly
  FROM features)"""

LOG = f"""log AS (
  SELECT CASE WHEN {K} >= 50 THEN 'anomaly' ELSE 'normal' END AS prediction, ts AS "timestamp",
         event_type AS model_name, value AS execution_duration_ms, user_id AS key
  FROM events)"""

SCORED_EVENTS = f"""scored AS (
  SELECT event_type AS model_type, event_type || '-' || (user_id % 8) AS run_id,
         (({K} * (user_id % 8 + 3) + event_id % 41) % 100) / 100.0::DOUBLE AS score,
         CAST({K} >= 70 AS INTEGER) AS y
  FROM events)"""

# Metrics of every run in long form; values are rounded so that ranks agree across engines.
RUN_METRICS = f"""{SCORED_EVENTS},
steps AS (SELECT model_type, run_id, score, sum(y) AS hits, count(*) AS n FROM scored GROUP BY ALL),
summed AS (
  SELECT *, sum(hits) OVER w AS tp, sum(n) OVER w AS seen FROM steps
  WINDOW w AS (PARTITION BY model_type, run_id ORDER BY score DESC)),
area AS (
  SELECT model_type, run_id, CASE WHEN sum(hits) > 0 THEN sum(hits * tp / seen) / sum(hits) ELSE 0 END AS pr_auc
  FROM summed GROUP BY ALL),
counted AS (
  SELECT model_type, run_id, count(*) AS n,
         count(*) FILTER (WHERE y = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE y = 0 AND score >= 0.5) AS fp,
         count(*) FILTER (WHERE y = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE y = 0 AND score < 0.5) AS tn
  FROM scored GROUP BY ALL),
wide AS (
  SELECT model_type, run_id, round(pr_auc + 1.37e-8, 6) AS pr_auc,
         round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END + 1.37e-8, 6) AS f1_score,
         round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END + 1.37e-8, 6) AS "precision",
         round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END + 1.37e-8, 6) AS recall,
         round((tp + tn) / n + 1.37e-8, 6) AS accuracy
  FROM area JOIN counted USING (model_type, run_id)),
metrics AS (
  SELECT model_type, run_id, metric, value FROM wide
  UNPIVOT (value FOR metric IN (pr_auc, f1_score, "precision", recall, accuracy)))"""
