"""Cleaning, quality and layer checks."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tradeflow.functions import scalar
from tradeflow.operators import enrich as en
from tradeflow.operators import quality
from tradeflow.operators.features import gold_features
from tradeflow.plans import fixtures as fx
from tradeflow.plans.catalog import registry as reg
from tradeflow.plans.catalog.registry import query, r4, rounded, sql_r4
from tradeflow.schemas import REQUIRED_SILVER, require_columns
from tradeflow.session import cut_lineage, fresh_path

SILVER = reg.silver()


@query(f"WITH {SILVER} SELECT * FROM silver")
def silver_enrich(spark, sf_dir):
    silver = en.bronze_to_silver(fx.dirty_trades(spark, sf_dir), stamp=False)
    return require_columns(silver, REQUIRED_SILVER)


@query(f"WITH {reg.silver((9, 16), 'symbol IS NOT NULL')} SELECT * FROM silver")
def silver_local_session(spark, sf_dir):
    return en.bronze_to_silver(fx.dirty_trades(spark, sf_dir), session="local", allow_empty_symbol=True, stamp=False)


@query(
    """SELECT CAST(event_id AS VARCHAR) AS trade_id,
  CASE WHEN hour(ts - INTERVAL 5 HOUR) < 9 THEN 'pre_market' WHEN hour(ts - INTERVAL 5 HOUR) < 16 THEN 'regular'
       ELSE 'after_hours' END AS session_type
FROM events"""
)
def session_in_exchange_zone(spark, sf_dir):
    trades = fx.trades(spark, sf_dir)
    local = scalar.session_type(F.col("timestamp"), "local", zone="America/New_York")
    return trades.select("trade_id", local.alias("session_type"))


@query(
    f"""WITH {reg.DIRTY}, n AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE price > 0) AS a,
         count(*) FILTER (WHERE symbol IS NOT NULL AND symbol != '') AS b,
         count(*) FILTER (WHERE "timestamp" IS NOT NULL) AS c, count(*) FILTER (WHERE volume >= 0) AS d FROM dirty)
SELECT 'valid_price' AS rule, 'drop' AS action, a AS passed, total - a AS failed FROM n
UNION ALL SELECT 'valid_symbol', 'drop', b, total - b FROM n
UNION ALL SELECT 'valid_timestamp', 'fail', c, total - c FROM n
UNION ALL SELECT 'valid_volume', 'warn', d, total - d FROM n"""
)
def quality_report(spark, sf_dir):
    return quality.rule_report(fx.dirty_trades(spark, sf_dir))


@query(f"WITH {reg.TIED} SELECT * FROM tied")
def dedup_trades(spark, sf_dir):
    return en.latest_copy_free(fx.tied_trades(spark, sf_dir))


@query(
    f"""WITH {SILVER}
SELECT session_type, trade_type, count(*) AS trades, sum(volume) AS total_volume, {sql_r4("avg(price)", "avg_price", 6)}
FROM silver GROUP BY ALL"""
)
def session_summary(spark, sf_dir):
    silver = en.bronze_to_silver(fx.dirty_trades(spark, sf_dir), stamp=False)
    return rounded(en.session_summary(silver), "avg_price", digits=6)


@query(
    f"""WITH {SILVER}
SELECT 'bronze' AS table_name, count(*) AS row_count, CAST(count(*) > 0 AS INTEGER) AS ok FROM dirty
UNION ALL SELECT 'silver', count(*), CAST(count(*) > 0 AS INTEGER) FROM silver
UNION ALL SELECT 'gold', count(*), CAST(count(*) > 0 AS INTEGER) FROM silver"""
)
def layer_counts(spark, sf_dir):
    return quality.layer_counts(_layers(spark, sf_dir))


@query(
    f"""WITH {SILVER}
SELECT (SELECT CAST(count(*) > 0 AS INTEGER) FROM dirty) AS bronze_ok,
       (SELECT CAST(count(*) > 0 AS INTEGER) FROM silver) AS silver_ok,
       (SELECT CAST(count(*) > 0 AS INTEGER) FROM silver) AS gold_ok"""
)
def layer_flags(spark, sf_dir):
    return quality.layer_flags(_layers(spark, sf_dir))


def _layers(spark, sf_dir):
    bronze = fx.dirty_trades(spark, sf_dir)
    silver = cut_lineage(en.bronze_to_silver(bronze, stamp=False))
    return {"bronze": bronze, "silver": silver, "gold": gold_features(silver)}


@query(
    """SELECT count(*) AS duplicate_keys FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
)
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(fx.tied_trades(spark, sf_dir))


@query(
    f"""WITH {reg.DIRTY}
SELECT count(*) FILTER (WHERE price <= 0) AS invalid_price,
       count(*) FILTER (WHERE symbol IS NULL OR symbol = '') AS invalid_symbol,
       count(*) FILTER (WHERE "timestamp" IS NULL) AS invalid_timestamp FROM dirty"""
)
def invalid_rows(spark, sf_dir):
    return quality.invalid_rows(fx.dirty_trades(spark, sf_dir))


@query(
    f"""WITH {reg.TRADES}, {reg.feature_steps("trades")}
SELECT count(*) FILTER (WHERE symbol IS NULL OR "timestamp" IS NULL) AS null_critical_features,
       {sql_r4("min(price_volatility_1h)", "min_volatility")}, {sql_r4("max(price_volatility_1h)", "max_volatility")},
       min(trade_intensity_1m) AS min_intensity, max(trade_intensity_1m) AS max_intensity FROM features"""
)
def gold_completeness(spark, sf_dir):
    checks = quality.gold_completeness(gold_features(fx.trades(spark, sf_dir)))
    return rounded(checks, "min_volatility", "max_volatility")


@query(
    """SELECT (SELECT max(ts) FROM events) AS latest_bronze_ingest,
       (SELECT max(l_shipdate) FROM lineitem) AS latest_silver_process"""
)
def freshness(spark, sf_dir):
    return quality.freshness(fx.trades(spark, sf_dir), fx.tied_trades(spark, sf_dir), "timestamp", "timestamp")


@query(
    f"""WITH {reg.TRADES}, p AS (SELECT trade_id, volume / 20000 AS p FROM trades)
SELECT trade_id, CASE WHEN p >= 0.8 THEN 'critical' WHEN p >= 0.5 THEN 'high' WHEN p >= 0.2 THEN 'medium' ELSE 'low' END
         AS risk_level,
       CASE WHEN p >= 0.5 THEN 'anomaly' ELSE 'normal' END AS label,
       {sql_r4("1 / (1 + exp(2 * (p - 0.5)))", "calibrated")},
       {sql_r4("least(p / 0.8 * 100, 100)", "gauge_pct")},
       CASE WHEN least(p / 0.8 * 100, 100) > 80 THEN 'danger' WHEN least(p / 0.8 * 100, 100) > 50 THEN 'warning'
            ELSE 'ok' END AS gauge_state,
       CASE WHEN length(trade_id) > 0 THEN substr(md5(trade_id), 1, 8) ELSE 'N/A' END AS run
FROM p"""
)
def risk_scoring(spark, sf_dir):
    p = fx.trades(spark, sf_dir).select("trade_id", (F.col("volume") / 20000).alias("p"))
    used = scalar.gauge(F.col("p"), 0.8)
    return p.select(
        "trade_id",
        scalar.risk_level(F.col("p")).alias("risk_level"),
        scalar.prediction_label((F.col("p") >= 0.5).cast("int")).alias("label"),
        r4(scalar.sigmoid_calibrated(F.col("p") - 0.5)).alias("calibrated"),
        r4(used).alias("gauge_pct"),
        scalar.gauge_state(used).alias("gauge_state"),
        scalar.short_run_id(F.md5("trade_id")).alias("run"),
    )


@query(
    f"""WITH {reg.DIRTY} SELECT 'valid_volume' AS rule, count(*) FILTER (WHERE volume IS NULL OR volume < 0) AS warned, count(*) AS kept
FROM dirty WHERE price > 0 AND symbol IS NOT NULL AND symbol <> ''"""
)
def warn_rule(spark, sf_dir):
    """Rows that only draw a warning, counted while the kept rows are written."""
    seen = Observation("silver")
    kept = fresh_path(spark, "kept")
    quality.enforce(fx.dirty_trades(spark, sf_dir), quality.silver_rules(), seen).write.parquet(kept)
    rows = spark.read.parquet(kept).agg(F.count("*").alias("kept"))
    return rows.select(F.lit("valid_volume").alias("rule"), F.lit(seen.get["valid_volume"]).cast("bigint").alias("warned"), "kept")


@query("SELECT count(*) AS rows, TRUE AS stopped, 'valid_timestamp' AS rule FROM events")
def fail_rule(spark, sf_dir):
    """A row without a time stops the job, and the error names the rule."""
    trades = fx.trades(spark, sf_dir)
    broken = trades.withColumn("timestamp", F.when(F.col("trade_id").cast("bigint") % 100 != 0, F.col("timestamp")))
    try:
        quality.enforce(broken, quality.silver_rules()).write.format("noop").mode("overwrite").save()
        error = ""
    except PySparkException as found:
        error = str(found)
    named = F.lit("valid_timestamp" if "rule failed: valid_timestamp" in error else "")
    return trades.agg(F.count("*").alias("rows")).select("rows", F.lit(bool(error)).alias("stopped"), named.alias("rule"))
