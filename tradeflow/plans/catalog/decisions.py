"""Rankings, gates and the retraining decision."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeflow.operators import dashboard, drift, gates
from tradeflow.operators import monitoring as mon
from tradeflow.operators.metrics import average_precision, latency_p99
from tradeflow.plans import fixtures as fx
from tradeflow.plans.catalog import registry as reg
from tradeflow.plans.catalog.drift import _CAT, _DRIFTED, _NUM, _drifted
from tradeflow.plans.catalog.monitoring import run_metrics_table
from tradeflow.plans.catalog.registry import query, r4, rounded, sql_r4
from tradeflow.session import cut_lineage

_PR = "SELECT model_type, run_id, value AS pr_auc FROM metrics WHERE metric = 'pr_auc'"


@query(
    f"""WITH {reg.RUN_METRICS}, pr AS ({_PR}),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY pr_auc DESC, model_type, run_id) AS INTEGER) AS rank FROM pr)
SELECT model_type, run_id, pr_auc, rank, rank = 1 AS winner FROM r"""
)
def tournament_rank(spark, sf_dir):
    return gates.tournament_rank(run_metrics_table(spark, sf_dir), ["model_type", "run_id"])


@query(
    f"""WITH {reg.RUN_METRICS}
SELECT model_type, run_id, substr(run_id, 1, 8) AS run_id_short, pr_auc, f1_score, "precision", recall, accuracy,
       round(length(run_id) / 4, 1) AS training_time_s
FROM wide"""
)
def comparison_table(spark, sf_dir):
    metrics = run_metrics_table(spark, sf_dir).select("model_type", "run_id", "metric", "value")
    times = metrics.select("model_type", "run_id").distinct().select(
        "*", F.lit("training_time_s").alias("metric"), (F.length("run_id") / 4).alias("value")
    )
    return gates.comparison_table(metrics.unionByName(times))


@query(
    f"""WITH {reg.RUN_METRICS}, pr AS ({_PR}), best AS (SELECT * FROM pr ORDER BY pr_auc DESC, run_id LIMIT 20),
firsts AS (SELECT model_type, pr_auc, run_id FROM best
           QUALIFY row_number() OVER (PARTITION BY model_type ORDER BY pr_auc DESC, run_id) = 1)
SELECT model_type, CAST(row_number() OVER (ORDER BY pr_auc DESC, run_id) AS INTEGER) AS place FROM firsts
QUALIFY place <= 2"""
)
def top2_architectures(spark, sf_dir):
    return gates.top_architectures(run_metrics_table(spark, sf_dir))


def _metrics(spark, sf_dir):
    """The metric table (one row per run and metric) computed once for all its readers."""
    return cut_lineage(run_metrics_table(spark, sf_dir))


def _run(metrics, run_id):
    return metrics.filter(F.col("run_id") == run_id).select("metric", "value")


_CHANGES = f"""WITH {reg.RUN_METRICS}, sides AS (
  SELECT metric, coalesce(max(value) FILTER (WHERE run_id = 'click-2'), 0.0) AS challenger,
         coalesce(max(value) FILTER (WHERE run_id = 'view-1'), 0.0) AS champion
  FROM metrics WHERE metric <> 'accuracy' GROUP BY metric)"""


@query(
    f"""{_CHANGES} SELECT metric, challenger, champion, {sql_r4("challenger - champion", "improvement", 6)} FROM sides"""
)
def metric_changes(spark, sf_dir):
    metrics = _metrics(spark, sf_dir)
    changes = gates.metric_changes(_run(metrics, "click-2"), _run(metrics, "view-1"))
    return rounded(changes.select("metric", "challenger", "champion", "improvement"), "improvement", digits=6)


def _gate_sql(challenger: str, champion: str) -> str:
    return f"""WITH {reg.RUN_METRICS}, g AS (
  SELECT (SELECT value FROM metrics WHERE run_id = '{challenger}' AND metric = 'pr_auc') AS primary_metric_value,
         (SELECT value FROM metrics WHERE run_id = '{challenger}' AND metric = 'pr_auc')
         - coalesce((SELECT value FROM metrics WHERE run_id = '{champion}' AND metric = 'pr_auc'), 0) AS gain,
         (SELECT count(*) FROM metrics WHERE run_id = '{champion}') AS n)
SELECT CASE WHEN n = 0 OR gain >= 0.005 - 1e-12 THEN 'PROMOTE' ELSE 'REJECT' END AS decision, primary_metric_value,
       {sql_r4("gain", "gain", 6)} FROM g"""


def _gate(spark, sf_dir, challenger, champion):
    metrics = _metrics(spark, sf_dir)
    row = gates.champion_gate(_run(metrics, challenger), _run(metrics, champion))
    return rounded(row.select("decision", "primary_metric_value", "gain"), "gain", digits=6)


@query(_gate_sql("click-2", "view-1"))
def champion_gate(spark, sf_dir):
    return _gate(spark, sf_dir, "click-2", "view-1")


@query(_gate_sql("view-1", "click-2"))
def champion_gate_reverse(spark, sf_dir):
    return _gate(spark, sf_dir, "view-1", "click-2")


@query(_gate_sql("signup-3", "nobody"))
def champion_gate_first(spark, sf_dir):
    return _gate(spark, sf_dir, "signup-3", "nobody")


@query(
    f"""WITH {reg.RUN_METRICS}, {reg.LOG},
m AS (SELECT max(value) FILTER (WHERE metric = 'pr_auc') AS pr, max(value) FILTER (WHERE metric = 'f1_score') AS f1
      FROM metrics WHERE run_id = 'click-2'),
l AS (SELECT max(p) AS p99 FROM (SELECT quantile_cont(execution_duration_ms, 0.99) AS p FROM log GROUP BY model_name)),
c AS (SELECT count(*) AS missing FROM (
        SELECT DISTINCT 'U' || (c_custkey % 200) AS symbol FROM customer
        EXCEPT SELECT 'U' || user_id FROM events)),
checks AS (
  SELECT 'performance_pr_auc' AS "check", pr >= 0.5 AS passed FROM m
  UNION ALL SELECT 'performance_f1', f1 >= 0.3 FROM m
  UNION ALL SELECT 'latency', p99 <= 50 FROM l
  UNION ALL SELECT 'data_coverage', missing = 0 FROM c)
SELECT *, bool_and(passed) OVER () AS all_passed FROM checks"""
)
def validation_gate(spark, sf_dir):
    metrics = _run(_metrics(spark, sf_dir), "click-2")
    latency = latency_p99(fx.inference_log(spark, sf_dir))
    checks = gates.validation_gate(metrics, latency, _required(spark, sf_dir), fx.user_trades(spark, sf_dir))
    return checks.select("check", "passed", "all_passed")


def _required(spark, sf_dir):
    customers = fx.table(spark, sf_dir, "customer")
    return customers.select(F.concat(F.lit("U"), (F.col("c_custkey") % 200).cast("string")).alias("symbol"))


@query(
    """SELECT DISTINCT 'U' || (c_custkey % 200) AS symbol FROM customer
EXCEPT SELECT 'U' || user_id FROM events"""
)
def symbol_coverage(spark, sf_dir):
    return gates.missing_symbols(_required(spark, sf_dir), fx.user_trades(spark, sf_dir))


_VARIANT = (
    "CASE WHEN CAST('0x' || substr(md5('ab' || {key}), 1, 8) AS BIGINT) % 100 < 20 THEN 'treatment' ELSE 'control' END"
)


@query(f"SELECT user_id, event_id, {_VARIANT.format(key='user_id')} AS variant FROM events")
def traffic_split(spark, sf_dir):
    return gates.assign_variant(fx.table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id")


_SCORED_VARIANTS = f"""scored AS (
  SELECT {_VARIANT.format(key="user_id")} AS model, (({reg.K} * 3 + event_id % 41) % 100) / 100.0::DOUBLE AS score,
         CAST({reg.K} >= 70 AS INTEGER) AS y FROM events)"""


@query(
    f"""WITH {_SCORED_VARIANTS},
steps AS (SELECT model, score, sum(y) AS hits, count(*) AS n FROM scored GROUP BY ALL),
summed AS (SELECT *, sum(hits) OVER w AS tp, sum(n) OVER w AS seen FROM steps
           WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
ap AS (SELECT model, round(sum(hits * tp / seen) / sum(hits) + 1.37e-10, 8) AS v FROM summed GROUP BY model),
s AS (SELECT max(v) FILTER (WHERE model = 'control') AS control, max(v) FILTER (WHERE model = 'treatment') AS treatment FROM ap)
SELECT *, CASE WHEN control IS NULL OR treatment IS NULL THEN 'NEEDS_MORE_DATA'
               WHEN treatment > control THEN 'PROMOTE_TREATMENT' ELSE 'KEEP_CONTROL' END AS decision FROM s"""
)
def ab_decision(spark, sf_dir):
    k = fx.k_of_props()
    split = gates.assign_variant(fx.table(spark, sf_dir, "events"), "user_id")
    scored = split.select(
        "variant", ((k * 3 + F.col("event_id") % 41) % 100 / 100).alias("score"), (k >= 70).cast("int").alias("y")
    )
    areas = average_precision(scored, ["variant"])
    return gates.ab_decision(rounded(areas, "pr_auc", digits=8))


@query(
    f"""WITH v AS (
  SELECT {_VARIANT.format(key="user_id")} AS variant, CAST({reg.K} >= 50 AS INTEGER) AS success FROM events),
t AS (SELECT count(*) FILTER (WHERE variant = 'control' AND success = 1)::DOUBLE AS a,
             count(*) FILTER (WHERE variant = 'control' AND success = 0)::DOUBLE AS b,
             count(*) FILTER (WHERE variant = 'treatment' AND success = 1)::DOUBLE AS c,
             count(*) FILTER (WHERE variant = 'treatment' AND success = 0)::DOUBLE AS d FROM v),
x AS (SELECT *, CASE WHEN (a+b)*(c+d)*(a+c)*(b+d) > 0
                     THEN (a+b+c+d) * (a*d - b*c) * (a*d - b*c) / ((a+b)*(c+d)*(a+c)*(b+d)) ELSE 0 END AS chi2 FROM t)
SELECT CAST(a + b AS BIGINT) AS control_n, CAST(c + d AS BIGINT) AS treatment_n, {sql_r4("a / (a + b)", "control_rate", 6)},
       {sql_r4("c / (c + d)", "treatment_rate", 6)}, {sql_r4("chi2", "chi2", 6)}, least(a + b, c + d) >= 1000 AS enough,
       CASE WHEN least(a + b, c + d) < 1000 THEN 'NEEDS_MORE_DATA' WHEN chi2 <= 3.841 THEN 'KEEP_CONTROL'
            WHEN c / (c + d) > a / (a + b) THEN 'PROMOTE_TREATMENT' ELSE 'KEEP_CONTROL' END AS decision
FROM x"""
)
def ab_chi2(spark, sf_dir):
    split = gates.assign_variant(fx.table(spark, sf_dir, "events"), "user_id")
    k = fx.k_of_props()
    outcome = gates.ab_chi2(split.select("variant", (k >= 50).cast("int").alias("success")))
    return rounded(outcome, "control_rate", "treatment_rate", "chi2", digits=6)


@query(
    f"""WITH {reg.RUN_METRICS}, s AS (
  SELECT coalesce(max(value) FILTER (WHERE run_id = 'view-1'), 0) AS champion,
         coalesce(max(value) FILTER (WHERE run_id = 'click-2'), 0) AS challenger FROM metrics WHERE metric = 'pr_auc')
SELECT *, CASE WHEN challenger > champion THEN 'PROMOTE' ELSE 'ROLLBACK' END AS decision FROM s"""
)
def swap_decision(spark, sf_dir):
    return gates.swap_decision(_metrics(spark, sf_dir), "view-1", "click-2")


_AUDIT = """audit AS (
  SELECT ts AS "timestamp", CASE WHEN event_type = 'signup' AND user_id < 10 THEN 'retraining_triggered' ELSE 'checked' END
         AS event_type, props AS details FROM events), now AS (SELECT max(ts) AS t FROM events)"""
_ACTIVITY = """activity AS (
  SELECT max("timestamp") AS last_run, count(*) FILTER (WHERE CAST("timestamp" AS DATE) = CAST(t AS DATE)) AS runs_today
  FROM audit, now WHERE event_type = 'retraining_triggered' AND "timestamp" <= t)"""


@query(f"WITH {_AUDIT}, {_ACTIVITY} SELECT * FROM activity")
def audit_activity(spark, sf_dir):
    audit = fx.retraining_log(spark, sf_dir)
    return mon.audit_activity(audit, _now(audit))


def _now(df):
    return df.agg(F.max("timestamp")).first()[0]


@query(
    f"""WITH {_AUDIT}, {_ACTIVITY}, {_DRIFTED}, {reg.RUN_METRICS},
f AS (SELECT c.metric FROM metrics c JOIN metrics b ON c.metric = b.metric
      WHERE c.run_id = 'view-1' AND b.run_id = 'click-2' AND c.metric IN ('pr_auc', 'f1_score') AND b.value - c.value > 0.05),
r AS (SELECT concat_ws(',', CASE WHEN (SELECT bool_or(drifted) FROM report) THEN 'data_drift' END,
        CASE WHEN EXISTS (SELECT 1 FROM f WHERE metric = 'pr_auc') THEN 'performance_degradation_pr_auc' END,
        CASE WHEN EXISTS (SELECT 1 FROM f WHERE metric = 'f1_score') THEN 'performance_degradation_f1_score' END,
        CASE WHEN (SELECT count(*) FROM events) >= 5000 THEN 'sufficient_new_data' END) AS reasons,
      coalesce(epoch_us(t) - epoch_us(last_run) >= 6 * 3600000000, true) AS cooldown_ok, runs_today < 4 AS daily_limit_ok
      FROM activity, now)
SELECT *, reasons <> '' AS has_reason, reasons <> '' AND cooldown_ok AND daily_limit_ok AS retrain FROM r"""
)
def retrain_decision(spark, sf_dir):
    metrics = _metrics(spark, sf_dir)
    audit = fx.retraining_log(spark, sf_dir)
    return mon.retrain_decision(
        _now(audit),
        report=drift.drift_report(_drifted(spark, sf_dir), _NUM, _CAT),
        current=_run(metrics, "view-1"),
        baseline=_run(metrics, "click-2"),
        new_rows=fx.trades(spark, sf_dir),
        audit=audit,
    )


@query(
    f"""WITH {_DRIFTED}, s AS (
  SELECT string_agg(feature, ', ' ORDER BY feature) FILTER (WHERE drifted) AS names FROM report),
n AS (SELECT count(*) FILTER (WHERE side = 'reference') AS r, count(*) FILTER (WHERE side = 'current') AS c FROM moved)
SELECT 'drift_alert' AS alert_type, substr('Data drift detected' || chr(10) || 'Drifted features: ' || names || chr(10)
       || 'Reference size: ' || r || chr(10) || 'Current size: ' || c, 1, 500) AS message FROM s, n WHERE names IS NOT NULL"""
)
def drift_alerts(spark, sf_dir):
    sides = _drifted(spark, sf_dir)
    summary = drift.drift_summary(sides, drift.drift_report(sides, _NUM, _CAT))
    return mon.drift_alerts(summary).select("alert_type", "message")


@query(
    f"""WITH {_AUDIT}, {reg.RUN_METRICS}, gate AS (
  SELECT CASE WHEN max(value) FILTER (WHERE run_id = 'click-2') - max(value) FILTER (WHERE run_id = 'view-1') >= 0.005 - 1e-12
         THEN 'deploy' ELSE 'rejected' END AS type FROM metrics WHERE metric = 'pr_auc')
SELECT t AS "timestamp", type, 'click' AS model FROM gate, now
UNION ALL SELECT "timestamp", 'retrain', NULL FROM audit WHERE event_type = 'retraining_triggered'"""
)
def deployment_events(spark, sf_dir):
    audit = fx.retraining_log(spark, sf_dir)
    events = dashboard.deployment_events(gate_audit(spark, sf_dir, audit), audit)
    return events.select("timestamp", "type", "model")


def gate_audit(spark, sf_dir, audit):
    metrics = _metrics(spark, sf_dir)
    gate = gates.champion_gate(_run(metrics, "click-2"), _run(metrics, "view-1"))
    return gate.select(
        F.lit(_now(audit)).alias("timestamp"),
        "decision",
        "reason",
        F.lit("click").alias("challenger_model_type"),
        F.lit("click-2").alias("challenger_run_id"),
        r4("primary_metric_value", 6).alias("primary_metric_value"),
        "improvement",
    )


@query(
    f"""WITH {_DRIFTED}, r AS (SELECT CASE WHEN bool_or(drifted) THEN 'data_drift' ELSE '' END AS reasons FROM report)
SELECT reasons, TRUE AS cooldown_ok, TRUE AS daily_limit_ok, reasons <> '' AS has_reason, reasons <> '' AS retrain FROM r"""
)
def retrain_on_drift(spark, sf_dir):
    """The rule that looks at drift alone."""
    as_of = _now(fx.retraining_log(spark, sf_dir))
    return mon.retrain_decision(as_of, report=drift.drift_report(_drifted(spark, sf_dir), _NUM, _CAT))


_FALLEN = f"""{reg.RUN_METRICS}, f AS (
  SELECT c.metric, b.value - c.value AS fall FROM metrics c JOIN metrics b ON c.metric = b.metric
  WHERE c.run_id = 'view-1' AND b.run_id = 'click-2' AND c.metric IN ('pr_auc', 'f1_score') AND b.value - c.value > 0.0001)"""


@query(
    f"""WITH {_FALLEN} SELECT (SELECT max(ts) FROM events) AS "timestamp", 'performance_alert' AS alert_type,
       'Model performance degradation' || chr(10) || 'Metric: ' || metric || chr(10) || 'Drop: ' || printf('%.4f', fall) || chr(10)
       || 'Threshold: 0.0001' AS message FROM f"""
)
def performance_alerts(spark, sf_dir):
    """One alert for each metric that fell (with a small threshold, so that some do)."""
    metrics, now = _metrics(spark, sf_dir), _now(fx.retraining_log(spark, sf_dir))
    fallen = mon.degraded_metrics(_run(metrics, "view-1"), _run(metrics, "click-2"), 0.0001)
    return mon.performance_alerts(fallen, F.lit(now), 0.0001).select("timestamp", "alert_type", "message")


@query(
    f"""WITH {_DRIFTED} SELECT 'retraining_trigger' AS alert_type,
       'Retraining triggered' || chr(10) || 'Reason: data_drift' || chr(10) || 'Model: boosted_a' AS message,
       '{{"reason":"data_drift","model_type":"boosted_a"}}' AS data FROM report HAVING bool_or(drifted)"""
)
def retraining_alerts(spark, sf_dir):
    now = _now(fx.retraining_log(spark, sf_dir))
    decision = mon.retrain_decision(now, report=drift.drift_report(_drifted(spark, sf_dir), _NUM, _CAT))
    return mon.retraining_alerts(decision, F.lit(now), "boosted_a").select("alert_type", "message", "data")


@query(
    f"""WITH {reg.RUN_METRICS}, gate AS (
  SELECT CASE WHEN max(value) FILTER (WHERE run_id = 'click-2') - max(value) FILTER (WHERE run_id = 'view-1') >= 0.005 - 1e-12
         THEN 'PROMOTE' ELSE 'REJECT' END AS decision FROM metrics WHERE metric = 'pr_auc')
SELECT (SELECT max(ts) FROM events) AS "timestamp", 'deployment' AS alert_type,
       'Deployment decision: ' || decision || chr(10) || 'Model: click vclick-2' AS message FROM gate"""
)
def deployment_alerts(spark, sf_dir):
    gate = gate_audit(spark, sf_dir, fx.retraining_log(spark, sf_dir))
    return mon.deployment_alerts(gate).select("timestamp", "alert_type", "message")
