"""The five extracts a dashboard reads, derived from the real tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.functions.scalar import gauge, gauge_state, report_round
from tradeflow.operators.gates import comparison_table
from tradeflow.operators.monitoring import performance_timeline


def tournament_results(metrics: DataFrame) -> DataFrame:
    return comparison_table(metrics)


def champion_history(gate_audit: DataFrame) -> DataFrame:
    return gate_audit.select("timestamp", "challenger_model_type", "challenger_run_id", "decision", "improvement")


def drift_metrics(report: DataFrame) -> DataFrame:
    """Each feature with its rounded value and how much of its threshold is used."""
    used = gauge(F.col("value"), F.col("threshold"))
    return report.select(
        "feature",
        "metric",
        report_round(F.col("value")).alias("value"),
        "threshold",
        "drifted",
        F.round(used, 2).alias("gauge_pct"),
        gauge_state(used).alias("gauge_state"),
    )


def deployment_events(gate_audit: DataFrame, retraining: DataFrame) -> DataFrame:
    """Deployments and retraining runs in one time-ordered list."""
    deploys = gate_audit.select(
        "timestamp",
        F.when(F.col("decision") == "PROMOTE", "deploy").otherwise("rejected").alias("type"),
        F.col("challenger_model_type").alias("model"),
        F.col("reason"),
    )
    runs = retraining.filter(F.col("event_type") == "retraining_triggered").select(
        "timestamp", F.lit("retrain").alias("type"), F.lit(None).cast("string").alias("model"), F.col("details").alias("reason")
    )
    return deploys.unionByName(runs).orderBy(F.col("timestamp").desc())


def export_extracts(
    folder: str, metrics: DataFrame, gate_audit: DataFrame, report: DataFrame, log: DataFrame, retraining: DataFrame
) -> list[str]:
    """Write the five extracts as JSON below ``folder`` and return their names."""
    extracts = {
        "tournament_results": tournament_results(metrics),
        "champion_history": champion_history(gate_audit),
        "drift_metrics": drift_metrics(report),
        "performance_timeline": performance_timeline(log),
        "deployment_events": deployment_events(gate_audit, retraining),
    }
    for name, df in extracts.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")
    return list(extracts)
