from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradeflow.operators import dashboard, gates
from tradeflow.operators import metrics as mt
from tradeflow.operators import monitoring as mon
from tradeflow.operators.asof import asof_join

NOW = datetime(2026, 4, 1, 12)


def values(spark, **named):
    return spark.createDataFrame(list(named.items()), "metric string, value double")


def report(spark, drifted):
    return spark.createDataFrame([("f", drifted)], "feature string, drifted boolean")


def audit(spark, *hours_ago):
    rows = [(NOW - timedelta(hours=h), "retraining_triggered") for h in hours_ago] + [(NOW, "checked")]
    return spark.createDataFrame(rows, "timestamp timestamp, event_type string")


def decide(spark, **options):
    return mon.retrain_decision(NOW, **options).first()


def test_retrain_reasons(spark):
    assert decide(spark, report=report(spark, True)).retrain
    assert not decide(spark, report=report(spark, False)).retrain
    base = values(spark, pr_auc=0.8, f1_score=0.8)
    fell = decide(spark, current=values(spark, pr_auc=0.7, f1_score=0.7), baseline=base)
    assert fell.reasons == "performance_degradation_pr_auc,performance_degradation_f1_score"
    assert not decide(spark, current=values(spark, pr_auc=0.79), baseline=base).retrain
    assert decide(spark, current=values(spark, pr_auc=0.79), baseline=base, degradation=0.005).retrain
    assert decide(spark, new_rows=spark.range(5000)).reasons == "sufficient_new_data"
    assert not decide(spark, new_rows=spark.range(4999)).retrain
    with pytest.raises(ValueError):
        mon.retrain_decision(NOW)


@pytest.mark.parametrize(
    "hours, cooldown, daily",
    [((6,), True, True), ((5.99,), False, True), ((7, 8, 9), True, True), ((7, 8, 9, 10), True, False), ((), True, True)],
)
def test_retrain_limits(spark, hours, cooldown, daily):
    row = decide(spark, report=report(spark, True), audit=audit(spark, *hours))
    assert (row.cooldown_ok, row.daily_limit_ok, row.retrain) == (cooldown, daily, cooldown and daily)


def test_runs_of_yesterday_do_not_count(spark):
    row = mon.audit_activity(audit(spark, 7, 13, 20), NOW).first()
    assert row.runs_today == 1 and row.last_run == NOW - timedelta(hours=7)


def gate(spark, challenger, champion, **options):
    return gates.champion_gate(challenger, champion, **options).first()


def test_champion_gate(spark):
    none = values(spark, pr_auc=0.0).limit(0)
    assert gate(spark, values(spark, pr_auc=0.8), none).decision == "PROMOTE"
    old = values(spark, pr_auc=0.80, f1_score=0.7)
    row = gate(spark, values(spark, pr_auc=0.82, f1_score=0.6), old, threshold=0.01)
    assert row.decision == "PROMOTE" and row.gain == pytest.approx(0.02)
    assert '"f1_score":-0.1' in row.improvement
    assert gate(spark, values(spark, pr_auc=0.805), old, threshold=0.01).decision == "REJECT"
    assert gate(spark, values(spark, pr_auc=0.81), old, threshold=0.01).decision == "PROMOTE"
    strict = gate(spark, values(spark, pr_auc=0.82, f1_score=0.6), old, threshold=0.01, require_all=True)
    assert strict.decision == "REJECT"


def test_ranking_and_tables(spark):
    rows = [("lgbm", "run-lgbm-1", "pr_auc", 0.8), ("xgb", "run-xgb-22", "pr_auc", 0.9), ("rf", None, "pr_auc", 0.85)]
    rows += [("lgbm", "run-lgbm-1", "recall", 0.5), ("dead", "run-dead", "recall", 0.9)]
    metrics = spark.createDataFrame(rows, "model_type string, run_id string, metric string, value double")
    ranked = gates.tournament_rank(metrics).orderBy("rank").collect()
    assert [r.model_type for r in ranked] == ["xgb", "rf", "lgbm", "dead"]
    assert [r.winner for r in ranked] == [True, False, False, False] and ranked[3].pr_auc == 0.0
    table = gates.comparison_table(metrics).collect()
    assert [(r.model_type, r.run_id, r.run_id_short) for r in table][:2] == [("xgb", "run-xgb-22", "run-xgb-"), ("rf", None, "N/A")]
    top = gates.top_architectures(metrics.filter("run_id IS NOT NULL")).orderBy("place").collect()
    assert [r.model_type for r in top] == ["xgb", "lgbm"]
    spare = gates.top_architectures(metrics, known=["nothing"]).orderBy("place").collect()
    assert [r.model_type for r in spare] == ["lightgbm", "xgboost"]


def test_validation_gate(spark):
    good = values(spark, pr_auc=0.6, f1_score=0.4)
    checks = {r.check: r for r in gates.validation_gate(good).collect()}
    assert all(r.passed and r.all_passed for r in checks.values()) and checks["latency"].detail == "Skipped"
    slow = spark.createDataFrame([(51.0,)], "p99_latency_ms double")
    need = spark.createDataFrame([("A",), ("B",)], "symbol string")
    checks = {r.check: r for r in gates.validation_gate(good, slow, need, need.limit(1)).collect()}
    assert not checks["latency"].passed and not checks["data_coverage"].passed
    assert not checks["performance_f1"].all_passed and checks["performance_f1"].passed
    bad = {r.check: r.passed for r in gates.validation_gate(values(spark, pr_auc=0.4)).collect()}
    assert (bad["performance_pr_auc"], bad["performance_f1"]) == (False, False)


def test_ab(spark):
    def conclude(rows, **options):
        return gates.ab_decision(spark.createDataFrame(rows, "variant string, pr_auc double"), **options).first().decision

    assert conclude([("control", 0.8), ("treatment", 0.9)]) == "PROMOTE_TREATMENT"
    assert conclude([("control", 0.9), ("treatment", 0.9)]) == "KEEP_CONTROL"
    assert conclude([("control", 0.9)]) == "NEEDS_MORE_DATA"
    table = spark.createDataFrame(
        [("e1", "control", 0.8), ("e1", "treatment", 0.9)], "experiment_id string, variant string, pr_auc double"
    )
    assert gates.experiment_decision(table, "e1").first().decision == "PROMOTE_TREATMENT"
    assert gates.experiment_decision(table, "e2").first().decision == "ERROR"
    runs = spark.createDataFrame(
        [("a", "pr_auc", 0.8), ("b", "pr_auc", 0.8)], "run_id string, metric string, value double"
    )
    assert gates.swap_decision(runs, "a", "b").first().decision == "ROLLBACK"
    assert gates.swap_decision(runs, "missing", "b").first().decision == "PROMOTE"


def test_chi2(spark):
    def run(control, treatment, n=1000, **options):
        rows = [("control", int(i < control)) for i in range(n)] + [("treatment", int(i < treatment)) for i in range(n)]
        return gates.ab_chi2(spark.createDataFrame(rows, "variant string, success int"), **options).first()

    row = run(500, 560)
    assert row.decision == "PROMOTE_TREATMENT" and row.chi2 == pytest.approx(7.2255, abs=1e-3)
    assert run(500, 510).decision == "KEEP_CONTROL"
    assert run(560, 500).decision == "KEEP_CONTROL"
    assert run(5, 9, n=10).decision == "NEEDS_MORE_DATA"


def test_traffic_split(spark):
    keys = spark.range(20000)
    share = gates.assign_variant(keys, "id", 20).filter("variant = 'treatment'").count() / 20000
    assert abs(share - 0.2) < 0.01
    again = gates.assign_variant(keys.repartition(3), "id", 20)
    assert gates.assign_variant(keys, "id", 20).exceptAll(again).count() == 0


@pytest.mark.parametrize("rows_per_block", [10**6, 100, 7])
def test_average_precision_with_ties_and_skew(spark, rows_per_block):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame(
        {
            "model": np.where(rng.random(2000) < 0.8, "hot", "cold"),
            "score": np.where(rng.random(2000) < 0.4, 0.5, rng.integers(0, 300, 2000) / 300),
            "y": rng.integers(0, 2, 2000),
        }
    )
    got = mt.average_precision(spark.createDataFrame(pdf), rows_per_block=rows_per_block).collect()
    for row in got:
        steps = pdf[pdf.model == row.model].groupby("score").y.agg(["sum", "count"]).sort_index(ascending=False)
        tp, seen = steps["sum"].cumsum(), steps["count"].cumsum()
        assert row.pr_auc == pytest.approx((steps["sum"] * tp / seen).sum() / steps["sum"].sum(), rel=1e-12)


def test_confusion_zero_division(spark):
    df = spark.createDataFrame([("m", 0, 0), ("m", 0, 0)], "model string, prediction int, y int")
    row = mt.confusion_metrics(df).first()
    assert (row.precision, row.recall, row.f1_score, row.accuracy) == (0.0, 0.0, 0.0, 1.0)


@pytest.mark.parametrize("rows_per_block", [10**6, 40, 5])
def test_asof_join(spark, rows_per_block):
    rng = np.random.default_rng(7)

    def side(n, prefix):
        return pd.DataFrame(
            {
                "symbol": np.where(rng.random(n) < 0.8, "HOT", rng.choice(["A", "B"], n)),
                "timestamp": pd.Timestamp("2026-04-01") + pd.to_timedelta(rng.integers(0, 400, n), unit="s"),
                prefix: np.arange(n, dtype=float),
            }
        )

    left, right = side(300, "id"), side(150, "f")
    right = right.drop_duplicates(["symbol", "timestamp"])
    right.loc[right.index % 5 == 0, "f"] = np.nan
    frame = spark.createDataFrame(right).withColumn("f", F.when(~F.isnan("f"), F.col("f")))
    got = asof_join(spark.createDataFrame(left), frame, right_columns=["f", "timestamp"], rows_per_block=rows_per_block)
    got = got.toPandas().sort_values("id").reset_index(drop=True)
    want = pd.merge_asof(
        left.sort_values("timestamp"),
        right.assign(at=right["timestamp"]).sort_values("timestamp"),
        on="timestamp",
        by="symbol",
    ).sort_values("id")
    np.testing.assert_allclose(got["f_asof"].astype(float), want["f"], equal_nan=True)
    assert list(got["timestamp_asof"].astype("datetime64[us]").fillna(pd.Timestamp(0))) == list(
        want["at"].astype("datetime64[us]").fillna(pd.Timestamp(0))
    )


def test_batch_and_live_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "symbol string, price double, volume double, timestamp timestamp")
    row = mon.batch_quality(empty, 7).first()
    assert (row.batch_id, row["count"], row.avg_price, row.total_volume, row.max_timestamp) == (7, 0, 0.0, 0.0, None)
    log = spark.createDataFrame([], "model_name string, execution_duration_ms double")
    assert mon.live_metrics(log).first().total_predictions == 0


def test_alerts_and_audits(spark, tmp_path):
    from tradeflow.schemas import ALERT_AUDIT, CHAMPION_AUDIT

    fallen = mon.degraded_metrics(values(spark, pr_auc=0.6), values(spark, pr_auc=0.8))
    alerts = mon.performance_alerts(fallen, F.lit(NOW))
    decisions = mon.retrain_decision(NOW, report=report(spark, True))
    alerts = alerts.unionByName(mon.retraining_alerts(decisions, F.lit(NOW), "xgb"))
    gate_row = gates.champion_gate(values(spark, pr_auc=0.8), values(spark, pr_auc=0.7)).select(
        F.lit(NOW).alias("timestamp"),
        "*",
        F.lit("xgb").alias("challenger_model_type"),
        F.lit("13").alias("challenger_run_id"),
    )
    alerts = alerts.unionByName(mon.deployment_alerts(gate_row))
    mon.append_audit(alerts, ALERT_AUDIT, str(tmp_path / "alerts"))
    mon.append_audit(gate_row, CHAMPION_AUDIT, str(tmp_path / "gates"))
    stored = {r.alert_type: r for r in spark.read.parquet(str(tmp_path / "alerts")).collect()}
    assert set(stored) == {"performance_alert", "retraining_trigger", "deployment"}
    assert "0.2000" in stored["performance_alert"].message and "PROMOTE" in stored["deployment"].message
    events = dashboard.deployment_events(spark.read.parquet(str(tmp_path / "gates")), audit(spark, 2).withColumn("details", F.lit("{}")))
    assert [r.type for r in events.collect()] == ["deploy", "retrain"]
