"""Versioned feature tables and dashboard extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeflow.operators import dashboard, differences, drift, snapshots
from tradeflow.operators import labels as lb
from tradeflow.operators import monitoring as mon
from tradeflow.plans import fixtures as fx
from tradeflow.plans.catalog import registry as reg
from tradeflow.plans.catalog.decisions import gate_audit
from tradeflow.plans.catalog.drift import _CAT, _NUM, _drifted
from tradeflow.plans.catalog.gold import _SPLIT
from tradeflow.plans.catalog.monitoring import run_metrics_table
from tradeflow.plans.catalog.registry import query
from tradeflow.schemas import CHAMPION_AUDIT, RETRAINING_AUDIT
from tradeflow.session import cut_lineage, fresh_path


@query(
    """SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS rows FROM events
UNION ALL SELECT 1, 'WRITE', count(*) FROM events WHERE event_type <> 'view'
UNION ALL SELECT 2, 'RESTORE 0', count(*) FROM events"""
)
def snapshot_history(spark, sf_dir):
    """Two versions, then the first restored as a third."""
    path = fresh_path(spark, "features")
    _three_versions(spark, sf_dir, path)
    return snapshots.history(spark, path).select("version", "operation", "rows")


def _three_versions(spark, sf_dir, path):
    trades = fx.trades(spark, sf_dir)
    snapshots.write_version(trades, path)
    snapshots.write_version(trades.filter(F.col("symbol") != "VIEW"), path)
    snapshots.restore_version(spark, path, 0)


@query(f"WITH {reg.TRADES} SELECT * FROM trades")
def snapshot_restored(spark, sf_dir):
    """The current rows after the restore, once it is verified."""
    path = fresh_path(spark, "features")
    _three_versions(spark, sf_dir, path)
    if not snapshots.verify_restore(spark, path, 0):
        raise AssertionError("restored version differs from its source")
    return snapshots.read_version(spark, path).drop("update_timestamp_utc")


@query(f"WITH s AS (WITH {_SPLIT}) SELECT is_test, is_anomaly, count(*) AS n FROM s GROUP BY ALL")
def train_test_tables(spark, sf_dir):
    path = fresh_path(spark, "split")
    labelled = fx.trades(spark, sf_dir).select("trade_id", (F.col("volume") >= 10000).cast("int").alias("is_anomaly"))
    snapshots.write_train_test(cut_lineage(lb.stratified_split(labelled)), path)
    train, test = snapshots.read_train_test(spark, path)
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return both.groupBy("is_test", "is_anomaly").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT event_type, count(*) AS n FROM (
  SELECT CASE WHEN event_type = 'signup' AND user_id < 10 THEN 'retraining_triggered' ELSE 'checked' END AS event_type
  FROM events) GROUP BY event_type"""
)
def audit_append(spark, sf_dir):
    """The audit log appended in two parts and read back."""
    path = fresh_path(spark, "audit")
    log = fx.retraining_log(spark, sf_dir)
    started = F.col("event_type") == "retraining_triggered"
    for part in (log.filter(started), log.filter(~started)):
        mon.append_audit(part, RETRAINING_AUDIT, path)
    stored = spark.read.schema(RETRAINING_AUDIT).parquet(path)
    return stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT 'champion_history' AS extract, CAST(1 AS BIGINT) AS rows
UNION ALL SELECT 'deployment_events', 1 + count(*) FROM events WHERE event_type = 'signup' AND user_id < 10
UNION ALL SELECT 'drift_metrics', 8
UNION ALL SELECT 'performance_timeline', count(*) FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) FROM events)
UNION ALL SELECT 'tournament_results', count(*) FROM (SELECT DISTINCT event_type, user_id % 8 FROM events)"""
)
def dashboard_extracts(spark, sf_dir):
    """The five extracts written as JSON; their row counts."""
    folder = fresh_path(spark, "dashboard")
    audit = fx.retraining_log(spark, sf_dir)
    gate = mon.conform(gate_audit(spark, sf_dir, audit), CHAMPION_AUDIT)
    report = drift.drift_report(_drifted(spark, sf_dir), _NUM, _CAT)
    names = dashboard.export_extracts(
        folder, cut_lineage(run_metrics_table(spark, sf_dir)), gate, report, fx.inference_log(spark, sf_dir), audit
    )
    counts = None
    for name in names:
        n = spark.read.text(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("rows"))
        row = n.select(F.lit(name).alias("extract"), "rows")
        counts = row if counts is None else counts.unionByName(row)
    return counts


@query(
    """SELECT 'v7' AS model_version, 'scoring' AS endpoint, CAST(0 AS BIGINT) AS feature_version
UNION ALL SELECT 'v8', 'scoring', 1 FROM (SELECT count(*) AS n FROM events) WHERE n > 0"""
)
def deployment_states(spark, sf_dir):
    """Which feature version was live with which model, recorded after each of two writes."""
    path = fresh_path(spark, "features")
    trades = fx.trades(spark, sf_dir)
    for model in ("v7", "v8"):
        snapshots.write_version(trades, path)
        snapshots.capture_state(spark, path, f"{path}-log", model, "scoring")
    return snapshots.captured_states(spark, f"{path}-log").select("model_version", "endpoint", "feature_version")


_CHANGED = """changed AS (
  SELECT trade_id, symbol, CASE WHEN CAST(trade_id AS BIGINT) % 89 = 0 THEN price + 1 ELSE price END AS price, volume, "timestamp", exchange
  FROM trades WHERE CAST(trade_id AS BIGINT) % 97 <> 0
  UNION ALL SELECT 'new-' || trade_id, symbol, price, volume, "timestamp", exchange FROM trades WHERE CAST(trade_id AS BIGINT) % 113 = 0
  UNION ALL SELECT * FROM trades WHERE CAST(trade_id AS BIGINT) % 211 = 0 AND CAST(trade_id AS BIGINT) % 97 <> 0 AND CAST(trade_id AS BIGINT) % 89 <> 0)"""


@query(
    f"""WITH {reg.TRADES}, {_CHANGED},
was AS (SELECT trade_id, list_sort(list((symbol, price, volume, "timestamp", exchange))) AS all_rows FROM trades GROUP BY trade_id),
now AS (SELECT trade_id, list_sort(list((symbol, price, volume, "timestamp", exchange))) AS all_rows FROM changed GROUP BY trade_id)
SELECT trade_id, CASE WHEN n.all_rows IS NULL THEN 'removed' WHEN w.all_rows IS NULL THEN 'added' ELSE 'changed' END AS difference
FROM was w FULL JOIN now n USING (trade_id) WHERE w.all_rows IS DISTINCT FROM n.all_rows"""
)
def version_differences(spark, sf_dir):
    """Keys that were removed, added or changed (a repeated row counts as a change) between two versions."""
    trades, number = fx.trades(spark, sf_dir), F.try_to_number("trade_id", F.lit("999999999999"))
    price = F.when(number % 89 == 0, F.col("price") + 1).otherwise(F.col("price"))
    now = trades.filter(number % 97 != 0).withColumn("price", price)
    now = now.unionByName(trades.filter(number % 113 == 0).withColumn("trade_id", F.concat(F.lit("new-"), "trade_id")))
    now = now.unionByName(trades.filter((number % 211 == 0) & (number % 97 != 0) & (number % 89 != 0)))
    return differences.locate(trades, now, ["trade_id"])
