"""Batch quality, inference-log metrics and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeflow.operators import metrics as mt
from tradeflow.operators import monitoring as mon
from tradeflow.operators import rollups
from tradeflow.plans import fixtures as fx
from tradeflow.plans.catalog import registry as reg
from tradeflow.plans.catalog.registry import query, r4, rounded, sql_r4
from tradeflow.session import cut_lineage


@query(
    f"""WITH {reg.DIRTY}
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS count, count(DISTINCT symbol) AS distinct_symbols,
       {sql_r4("avg(price)", "avg_price", 6)}, {sql_r4("stddev_samp(price)", "stddev_price", 6)},
       sum(volume) AS total_volume, min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp FROM dirty"""
)
def batch_quality(spark, sf_dir):
    return rounded(mon.batch_quality(fx.dirty_trades(spark, sf_dir)), "avg_price", "stddev_price", digits=6)


@query(
    f"""WITH {reg.LOG}
SELECT count(*) AS total_predictions, {sql_r4("avg(execution_duration_ms)", "avg_latency_ms", 6)},
       quantile_disc(execution_duration_ms, 0.99) AS p99_latency_ms, count(DISTINCT model_name) AS active_models FROM log"""
)
def live_metrics(spark, sf_dir):
    return rounded(mon.live_metrics(fx.inference_log(spark, sf_dir), accuracy=1_000_000), "avg_latency_ms", digits=6)


_PROFILE = f"""SELECT time_bucket(INTERVAL 30 MINUTE, "timestamp") AS window_start,
       time_bucket(INTERVAL 30 MINUTE, "timestamp") + INTERVAL 30 MINUTE AS window_end, model_name,
       count(*) AS predictions, count(*) FILTER (WHERE prediction = 'anomaly') AS anomalies,
       {sql_r4("avg(execution_duration_ms)", "avg_latency_ms", 6)}, max(execution_duration_ms) AS max_latency_ms
FROM log GROUP BY ALL"""


@query(f"WITH {reg.LOG} {_PROFILE}")
def inference_30m(spark, sf_dir):
    return rounded(mon.inference_profile(fx.inference_log(spark, sf_dir)), "avg_latency_ms", digits=6)


@query(
    f"""WITH {reg.LOG}
SELECT strftime("timestamp", '%Y-%m-%d') AS date, model_name, count(*) AS predictions,
       {sql_r4("avg(CASE WHEN prediction = 'anomaly' THEN 1.0::DOUBLE ELSE 0 END)", "anomaly_rate", 6)},
       {sql_r4("avg(execution_duration_ms)", "avg_latency_ms", 6)}
FROM log GROUP BY ALL"""
)
def performance_timeline(spark, sf_dir):
    daily = mon.performance_timeline(fx.inference_log(spark, sf_dir)).withColumn("date", F.col("date").cast("string"))
    return rounded(daily, "anomaly_rate", "avg_latency_ms", digits=6)


@query(
    f"""WITH {reg.LOG}
SELECT model_name, {sql_r4("quantile_cont(execution_duration_ms, 0.99)", "p99_latency_ms")} FROM log GROUP BY model_name"""
)
def latency_p99(spark, sf_dir):
    return rounded(mt.latency_p99(fx.inference_log(spark, sf_dir)), "p99_latency_ms")


_AP = f"""steps AS (SELECT model, score, sum(y) AS hits, count(*) AS n FROM scored GROUP BY ALL),
summed AS (
  SELECT *, sum(hits) OVER w AS tp, sum(n) OVER w AS seen FROM steps
  WINDOW w AS (PARTITION BY model ORDER BY score DESC))
SELECT model, {sql_r4("CASE WHEN sum(hits) > 0 THEN sum(hits * tp / seen) / sum(hits) ELSE 0 END", "pr_auc", 8)}
FROM summed GROUP BY model"""

_SCORED_LABELS = """scored AS (
  SELECT lang AS model, (n_chars % 1000) / 1000.0::DOUBLE AS score, toxic AS y FROM labels JOIN documents USING (doc_id))"""


@query(f"WITH {_SCORED_LABELS}, {_AP}")
def pr_auc(spark, sf_dir):
    return rounded(mt.average_precision(fx.scored_labels(spark, sf_dir)), "pr_auc", digits=8)


_SCORED_LINES = """scored AS (
  SELECT l_returnflag AS model, l_extendedprice AS score, CAST(l_discount > 0.05 AS INTEGER) AS y FROM lineitem)"""


@query(f"WITH {_SCORED_LINES}, {_AP}")
def pr_auc_lines(spark, sf_dir):
    return rounded(mt.average_precision(_scored_lines(spark, sf_dir)), "pr_auc", digits=8)


@query(f"WITH {_SCORED_LINES}, {_AP}")
def pr_auc_blocks(spark, sf_dir):
    return rounded(mt.average_precision(_scored_lines(spark, sf_dir), rows_per_block=4_000), "pr_auc", digits=8)


def _scored_lines(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("model"),
        F.col("l_extendedprice").alias("score"),
        (F.col("l_discount") > 0.05).cast("int").alias("y"),
    )


@query(
    f"""WITH {_SCORED_LABELS}, c AS (
  SELECT model, count(*) AS n, count(*) FILTER (WHERE y = 1 AND score >= 0.5) AS tp,
         count(*) FILTER (WHERE y = 0 AND score >= 0.5) AS fp, count(*) FILTER (WHERE y = 1 AND score < 0.5) AS fn,
         count(*) FILTER (WHERE y = 0 AND score < 0.5) AS tn FROM scored GROUP BY model)
SELECT *, {sql_r4("CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END", '"precision"', 6)},
       {sql_r4("CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END", "recall", 6)},
       {sql_r4("CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END", "f1_score", 6)},
       {sql_r4("(tp + tn) / n", "accuracy", 6)} FROM c"""
)
def confusion_metrics(spark, sf_dir):
    scored = fx.scored_labels(spark, sf_dir).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return rounded(mt.confusion_metrics(scored), "precision", "recall", "f1_score", "accuracy", digits=6)


@query(f"WITH {reg.RUN_METRICS} SELECT model_type, run_id, metric, value + 0.0 AS value FROM metrics")
def run_metrics(spark, sf_dir):
    return run_metrics_table(spark, sf_dir)


def run_metrics_table(spark, sf_dir):
    """(model_type, run_id, metric, value) for the forty runs found in the events."""
    wide = mt.model_metrics(fx.scored_events(spark, sf_dir), ["model_type", "run_id"])
    names = ["pr_auc", "f1_score", "precision", "recall", "accuracy"]
    wide = wide.select("model_type", "run_id", *[r4(c, 6).alias(c) for c in names])
    return wide.unpivot(["model_type", "run_id"], names, "metric", "value")


_LATER = """"timestamp" >= (SELECT time_bucket(INTERVAL 30 MINUTE, min(ts)) FROM events) + INTERVAL 10 DAY"""
_SKETCH = f"""celled AS (
  SELECT model_name, CAST(CASE WHEN v > 0 THEN ceil(ln(v) / {rollups.log(rollups.GROWTH)!r}) + 200000
         WHEN v < 0 THEN -(ceil(ln(-v) / {rollups.log(rollups.GROWTH)!r}) + 200000) ELSE 0 END AS BIGINT) AS cell, v
  FROM (SELECT model_name, CAST(execution_duration_ms AS DOUBLE) AS v FROM log WHERE {_LATER})),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY cell) - 1 AS place, row_number() OVER (PARTITION BY model_name ORDER BY v) - 1 AS exact_place,
         count(*) OVER (PARTITION BY model_name) AS n FROM celled),
valued AS (SELECT *, sign(cell) * exp((abs(cell) - 200000) * {rollups.log(rollups.GROWTH)!r}) * {2 / (rollups.GROWTH + 1)!r} AS stands FROM ranked)"""


def _rollups(spark, sf_dir):
    """Stored half-hour rollups of the log, and the instant from which some are read."""
    log = fx.inference_log(spark, sf_dir)
    stored = cut_lineage(rollups.rollup(log, ["model_name"], "execution_duration_ms", "key"))
    return log, stored, F.lit(stored.agg(F.min("window_start")).first()[0]) + F.expr("INTERVAL 10 DAYS")


@query(
    f"""WITH {reg.LOG}, {_SKETCH}
SELECT model_name, any_value(n) AS rows, {sql_r4("avg(v)", "average", 6)},
       {sql_r4("max(stands) FILTER (WHERE place = floor(0.5 * (n - 1)))", "q50", 6)}, {sql_r4("max(stands) FILTER (WHERE place = floor(0.99 * (n - 1)))", "q99", 6)}
FROM valued GROUP BY model_name"""
)
def latency_rollup(spark, sf_dir):
    """Tail latencies of a range of windows, merged from half-hour sketches."""
    _, stored, start = _rollups(spark, sf_dir)
    found = rollups.merged(stored.filter(F.col("window_start") >= start), ["model_name"]).drop("distinct_keys")
    return rounded(found, "average", "q50", "q99", digits=6)


@query(
    f"""WITH {reg.LOG}, {_SKETCH}
SELECT model_name, {sql_r4("max(v) FILTER (WHERE exact_place = floor(0.99 * (n - 1)))", "exact_q99", 6)}, TRUE AS within_error FROM valued GROUP BY model_name"""
)
def latency_rollup_bounds(spark, sf_dir):
    """Merged tail latencies against the exact ones: never further off than the stated error."""
    log, stored, start = _rollups(spark, sf_dir)
    found = rollups.merged(stored.filter(F.col("window_start") >= start), ["model_name"], [0.99])
    exact = log.filter(F.col("timestamp") >= start).groupBy("model_name").agg(F.sort_array(F.collect_list("execution_duration_ms")).alias("all"))
    exact = exact.select("model_name", F.get("all", F.floor(F.lit(0.99) * (F.size("all") - 1)).cast("int")).alias("exact_q99"))
    both = found.join(exact, "model_name")
    near = F.abs(F.col("q99") - F.col("exact_q99")) <= F.abs("exact_q99") * (rollups.ERROR + 1e-9)
    return rounded(both.select("model_name", "exact_q99", near.alias("within_error")), "exact_q99", digits=6)


@query(f"WITH {reg.LOG} SELECT model_name, count(*) AS rows, count(DISTINCT key) AS keys, TRUE AS within_bound FROM log GROUP BY model_name")
def distinct_keys_rollup(spark, sf_dir):
    """Distinct keys of all windows from their sketches, within four standard errors of the exact number."""
    log, stored, _ = _rollups(spark, sf_dir)
    exact = log.groupBy("model_name").agg(F.count_distinct("key").alias("keys"))
    both = rollups.merged(stored, ["model_name"]).join(exact, "model_name")
    near = F.abs(F.col("distinct_keys") - F.col("keys")) <= 4 * 1.04 / 2 ** (rollups.LOG_K / 2) * F.col("keys") + 1
    return both.select("model_name", "rows", "keys", near.alias("within_bound"))


@query(
    f"""WITH {reg.DIRTY}
SELECT count(*) AS count, count(DISTINCT symbol) AS distinct_symbols, {sql_r4("avg(price)", "avg_price", 6)}, {sql_r4("stddev_samp(price)", "stddev_price", 6)},
       sum(volume) AS total_volume, min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp FROM dirty"""
)
def batch_quality_merged(spark, sf_dir):
    """Quality of seven micro-batches together, from one stored row each."""
    dirty = fx.dirty_trades(spark, sf_dir)
    parts = [rollups.batch_rollup(dirty.filter(F.crc32("trade_id") % 7 == k), k) for k in range(7)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rounded(rollups.merged_quality(cut_lineage(rows)), "avg_price", "stddev_price", digits=6)
