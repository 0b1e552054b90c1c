"""Micro-batch and inference-log metrics, the retraining decision, alerts and audit appends."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.functions.scalar import alert_message
from tradeflow.schemas import ALERT_AUDIT, conform
from tradeflow.sources.sinks import write_table

# Retraining policy.
MIN_NEW_RECORDS = 5000
COOLDOWN_HOURS = 6
MAX_RUNS_PER_DAY = 4
DEGRADATION = 0.05
WATCHED_METRICS = ("pr_auc", "f1_score")
TRIGGERED = "retraining_triggered"


def batch_quality(batch: DataFrame, batch_id: int | Column = 0) -> DataFrame:
    """One row of quality metrics, from one aggregation (no separate count)."""
    number = batch_id if isinstance(batch_id, Column) else F.lit(batch_id).cast("bigint")
    zero = F.lit(0.0)
    return batch.agg(
        F.count(F.lit(1)).alias("count"),
        F.count_distinct("symbol").alias("distinct_symbols"),
        F.coalesce(F.avg("price"), zero).alias("avg_price"),
        F.coalesce(F.stddev_samp("price"), zero).alias("stddev_price"),
        F.coalesce(F.sum("volume"), zero).alias("total_volume"),
        F.min("timestamp").alias("min_timestamp"),
        F.max("timestamp").alias("max_timestamp"),
    ).select(number.alias("batch_id"), "*")


def live_metrics(log: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Totals over the inference log; the tail latency is an approximate percentile."""
    return log.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.coalesce(F.avg("execution_duration_ms"), F.lit(0.0)).alias("avg_latency_ms"),
        F.coalesce(F.percentile_approx("execution_duration_ms", 0.99, accuracy), F.lit(0.0)).alias("p99_latency_ms"),
        F.count_distinct("model_name").alias("active_models"),
    )


def inference_profile(log: DataFrame, granularity: str = "30 minutes", watermark: str | None = None) -> DataFrame:
    """Predictions per model and tumbling window. Give a watermark for a stream."""
    if watermark:
        log = log.withWatermark("timestamp", watermark)
    return (
        log.groupBy(F.window("timestamp", granularity).alias("w"), "model_name")
        .agg(
            F.count(F.lit(1)).alias("predictions"),
            F.count_if(F.col("prediction") == "anomaly").alias("anomalies"),
            F.avg("execution_duration_ms").alias("avg_latency_ms"),
            F.max("execution_duration_ms").alias("max_latency_ms"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "model_name",
            "predictions",
            "anomalies",
            "avg_latency_ms",
            "max_latency_ms",
        )
    )


def performance_timeline(log: DataFrame) -> DataFrame:
    """Daily totals per model."""
    return log.groupBy(F.to_date("timestamp").alias("date"), "model_name").agg(
        F.count(F.lit(1)).alias("predictions"),
        F.avg(F.when(F.col("prediction") == "anomaly", 1.0).otherwise(0.0)).alias("anomaly_rate"),
        F.avg("execution_duration_ms").alias("avg_latency_ms"),
    )


def audit_activity(audit: DataFrame, as_of: datetime | Column, event_type: str = TRIGGERED) -> DataFrame:
    """Newest event of a type, and how many fall on the day of ``as_of``: one pass over the log."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    past = audit.filter((F.col("event_type") == event_type) & (F.col("timestamp") <= now))
    return past.agg(
        F.max("timestamp").alias("last_run"),
        F.count_if(F.to_date("timestamp") == F.to_date(now)).alias("runs_today"),
    )


def _merge_rows(*rows: DataFrame) -> DataFrame:
    """Fold one-row tables with different columns into one row."""
    stacked = rows[0]
    for row in rows[1:]:
        stacked = stacked.unionByName(row, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def degraded_metrics(
    current: DataFrame, baseline: DataFrame, threshold: float = DEGRADATION, metrics: Sequence[str] = WATCHED_METRICS
) -> DataFrame:
    """Metrics (name, value) present on both sides that fell by more than ``threshold``."""
    was = baseline.select("metric", F.col("value").alias("baseline"))
    return (
        current.filter(F.col("metric").isin(*metrics))
        .join(was, "metric")
        .withColumn("drop", F.col("baseline") - F.col("value"))
        .filter(F.col("drop") > threshold)
        .select("metric", "drop")
    )


def retrain_decision(
    as_of: datetime | Column,
    report: DataFrame | None = None,
    current: DataFrame | None = None,
    baseline: DataFrame | None = None,
    new_rows: DataFrame | None = None,
    audit: DataFrame | None = None,
    min_records: int = MIN_NEW_RECORDS,
    cooldown_hours: float = COOLDOWN_HOURS,
    max_per_day: int = MAX_RUNS_PER_DAY,
    degradation: float = DEGRADATION,
) -> DataFrame:
    """One row: reasons, whether cooldown and daily limit allow a run, and the decision.

    A run needs at least one reason, at least ``cooldown_hours`` since the last run, and fewer than
    ``max_per_day`` runs on the day. Missing inputs give no reason and no restriction.
    """
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    known: dict[str, DataFrame] = {}
    if report is not None:
        known["drifted"] = report.agg(F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drifted"))
    if current is not None and baseline is not None:
        fallen = degraded_metrics(current, baseline, degradation)
        known["fallen"] = fallen.agg(F.sort_array(F.collect_set("metric")).alias("fallen"))
    if new_rows is not None:
        known["records"] = new_rows.agg(F.count(F.lit(1)).alias("records"))
    if audit is not None:
        known["audit"] = audit_activity(audit, now)
    if not known:
        raise ValueError("give at least one input to decide on")

    row = _merge_rows(*known.values())
    have = set(row.columns)

    def value(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in have else default

    metric_reasons = [
        F.when(F.array_contains(value("fallen", F.array().cast("array<string>")), m), f"performance_degradation_{m}")
        for m in WATCHED_METRICS
    ]
    reasons = F.array_compact(
        F.array(
            F.when(value("drifted", F.lit(False)), "data_drift"),
            *metric_reasons,
            F.when(value("records", F.lit(0)) >= min_records, "sufficient_new_data"),
        )
    )
    last_run = value("last_run", F.lit(None).cast("timestamp"))
    idle_hours = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(last_run)) / 3_600_000_000
    return row.select(
        F.array_join(reasons, ",").alias("reasons"),
        F.coalesce(idle_hours >= cooldown_hours, F.lit(True)).alias("cooldown_ok"),
        (value("runs_today", F.lit(0)) < max_per_day).alias("daily_limit_ok"),
        (F.size(reasons) > 0).alias("has_reason"),
    ).withColumn("retrain", F.col("has_reason") & F.col("cooldown_ok") & F.col("daily_limit_ok"))


def append_audit(rows: DataFrame, contract: T.StructType, path: str | None = None, table: str | None = None) -> None:
    """Append to an audit table after casting to its contract."""
    write_table(conform(rows, contract), path, table, mode="append")


def drift_alerts(summaries: DataFrame) -> DataFrame:
    """One alert per drift audit row that reports drift."""
    names = F.array_join(F.from_json("drifted_features", "array<string>"), ", ")
    message = alert_message(
        F.lit("Data drift detected"),
        F.concat(F.lit("Drifted features: "), names),
        F.concat(F.lit("Reference size: "), F.col("reference_size").cast("string")),
        F.concat(F.lit("Current size: "), F.col("current_size").cast("string")),
    )
    return _alerts(summaries.filter("overall_drift"), "drift_alert", message, F.col("feature_drift_details"))


def performance_alerts(fallen: DataFrame, at: Column, threshold: float = DEGRADATION) -> DataFrame:
    """One alert per degraded metric."""
    message = alert_message(
        F.lit("Model performance degradation"),
        F.concat(F.lit("Metric: "), F.col("metric")),
        F.concat(F.lit("Drop: "), F.format_number("drop", 4)),
        F.lit(f"Threshold: {threshold}"),
    )
    return _alerts(fallen.withColumn("timestamp", at), "performance_alert", message, F.to_json(F.struct("metric", "drop")))


def retraining_alerts(decisions: DataFrame, at: Column, model_type: str = "") -> DataFrame:
    message = alert_message(
        F.lit("Retraining triggered"), F.concat(F.lit("Reason: "), F.col("reasons")), F.lit(f"Model: {model_type}")
    )
    data = F.to_json(F.struct(F.col("reasons").alias("reason"), F.lit(model_type).alias("model_type")))
    return _alerts(decisions.filter("retrain").withColumn("timestamp", at), "retraining_trigger", message, data)


def deployment_alerts(gate: DataFrame) -> DataFrame:
    """One alert per champion-gate audit row."""
    message = alert_message(
        F.concat(F.lit("Deployment decision: "), F.col("decision")),
        F.concat(F.lit("Model: "), F.col("challenger_model_type"), F.lit(" v"), F.col("challenger_run_id")),
    )
    data = F.to_json(
        F.struct(
            F.col("challenger_run_id").alias("version"), F.col("challenger_model_type").alias("model_type"), "decision"
        )
    )
    return _alerts(gate, "deployment", message, data)


def _alerts(rows: DataFrame, kind: str, message: Column, data: Column) -> DataFrame:
    named = rows.select(
        "timestamp", F.lit(kind).alias("alert_type"), message.alias("message"), F.coalesce(data, F.lit("{}")).alias("data")
    )
    return conform(named, ALERT_AUDIT)
