"""Trained models. Scores depend on random draws; their checks do not and have SQL twins.

All four models of the tournament run as configured. ``boosted_checks`` and ``boosted_stop_checks`` run fewer, larger steps.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tradeflow.functions.scalar import prediction_label, risk_level, utc_now
from tradeflow.operators import boosting
from tradeflow.operators import features as ft
from tradeflow.operators import labels as lb
from tradeflow.operators import models as md
from tradeflow.operators.enrich import enrich
from tradeflow.operators.iforest import TREES
from tradeflow.plans import fixtures as fx
from tradeflow.plans.catalog import registry as reg
from tradeflow.plans.catalog.registry import query, rounded
from tradeflow.session import cut_lineage, stored

FOREST, ISOLATION_TREES = md.FOREST, TREES
BOOSTED = md.boosted_trees(replace(md.BOOSTED_B, rounds=6, step=0.3, depth=3))
MODELS = md.DEFAULT_MODELS


def prepared(spark, sf_dir):
    labelled = ft.anomaly_labels(ft.gold_features(enrich(fx.trades(spark, sf_dir))))
    # The split reads its rows three times, and the models read it once for each pass.
    split = stored(lb.stratified_split(stored(lb.contract_columns(labelled, keep=["trade_id"]), "labelled")), "split")
    return md.prepare(split.filter(~split.is_test), split.filter(split.is_test))


# Test rows of each class: the quota of the stratified split.
_TESTS = f"""{reg.TRADES}, {reg.feature_steps("trades")}, {reg.LABELLED},
q AS (SELECT is_anomaly, count(*) AS rows, sum(count(*)) OVER () AS n FROM labelled GROUP BY is_anomaly),
i AS (SELECT *, ceil(n * 0.2) AS tests, ceil(n * 0.2) * rows / n AS ideal FROM q),
quota AS (
  SELECT is_anomaly, rows, CAST(floor(ideal) + CASE WHEN row_number() OVER (ORDER BY ideal - floor(ideal) DESC, is_anomaly)
           <= tests - sum(floor(ideal)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM i)"""


@query()
def model_tournament(spark, sf_dir):
    """Metrics of all four models on the held-out rows."""
    result = md.run_tournament(prepared(spark, sf_dir), MODELS)
    if result.errors:
        raise RuntimeError(str(result.errors))
    return rounded(result.metrics.filter("metric != 'training_time_s'").drop("error"), "value", digits=6)


@query(
    """SELECT model_type, metric, TRUE AS within_range
FROM (VALUES ('boosted_a'), ('boosted_b'), ('random_forest'), ('isolation_forest')) m(model_type),
     (VALUES ('pr_auc'), ('f1_score'), ('precision'), ('recall'), ('accuracy'), ('training_time_s')) k(metric)"""
)
def tournament_checks(spark, sf_dir):
    """Every model has every metric, rates within 0..1 and a training time."""
    metrics = md.run_tournament(prepared(spark, sf_dir), MODELS).metrics
    good = F.col("error").isNull() & (F.col("value") >= 0) & ((F.col("value") <= 1) | (F.col("metric") == "training_time_s"))
    return metrics.select("model_type", "metric", good.alias("within_range"))


def _scores(spark, sf_dir, trainer):
    data = prepared(spark, sf_dir)
    score = trainer(data.train, data.features, "is_anomaly")
    return rounded(md.score_output(score(data.test)).select("trade_id", "prediction", "probability", "risk_level"), "probability")


def _checks(spark, sf_dir, trainer):
    """Scored test rows of each class, and whether every label and risk level follows from its score."""
    data = prepared(spark, sf_dir)
    scored = trainer(data.train, data.features, "is_anomaly")(data.test)
    served = cut_lineage(md.score_output(scored.withColumn("said", F.col("prediction"))))
    p = F.col("probability")
    consistent = (F.col("prediction") == prediction_label(F.col("said"))) & (F.col("risk_level") == risk_level(p))
    return served.groupBy("is_anomaly").agg(
        F.count("*").alias("rows"), F.bool_and(p.between(0, 1)).alias("scores_in_range"), F.bool_and(consistent).alias("labels_follow")
    )


_CHECKS = f"WITH {_TESTS} SELECT is_anomaly, quota AS rows, TRUE AS scores_in_range, TRUE AS labels_follow FROM quota WHERE quota > 0"


@query()
def isolation_forest_scores(spark, sf_dir):
    return _scores(spark, sf_dir, md.isolation_forest(ISOLATION_TREES))


@query(_CHECKS)
def isolation_forest_checks(spark, sf_dir):
    return _checks(spark, sf_dir, md.isolation_forest(ISOLATION_TREES))


@query()
def forest_scores(spark, sf_dir):
    return _scores(spark, sf_dir, md.random_forest(FOREST))


@query(_CHECKS)
def forest_checks(spark, sf_dir):
    return _checks(spark, sf_dir, md.random_forest(FOREST))


@query(_CHECKS)
def boosted_checks(spark, sf_dir):
    return _checks(spark, sf_dir, BOOSTED)


@query(
    f"""WITH {_TESTS}, train AS (SELECT CAST(sum(rows - quota) AS BIGINT) AS n FROM quota)
SELECT n AS train_rows, TRUE AS share_met FROM train"""
)
def contamination_checks(spark, sf_dir):
    """The share of flagged training rows equals the contamination, up to one row and ties at the threshold."""
    data = prepared(spark, sf_dir)
    scored = cut_lineage(md.isolation_forest(ISOLATION_TREES)(data.train, data.features, "is_anomaly")(data.train).select("score", "prediction"))
    n, flagged = F.count("*"), F.sum("prediction")
    least = F.min(F.when(F.col("prediction") == 1, F.col("score")))
    found = scored.agg(n.alias("n"), flagged.alias("flagged"), least.alias("least"))
    ties = scored.join(F.broadcast(found), F.col("score") == F.col("least")).agg(F.count("*").alias("tied"))
    both = found.withColumn("k", F.lit(0)).join(ties.withColumn("k", F.lit(0)), "k")  # one row each
    return both.select(F.col("n").alias("train_rows"), (F.abs(F.col("flagged") - 0.015 * F.col("n")) <= F.col("tied") + 1).alias("share_met"))


_SCREENED = ["price", "volume", "hour_of_day", "spread"]
_SPREAD = "CASE WHEN minute_of_hour % 5 = 0 THEN NULL ELSE price * minute_of_hour END"
GAINS = boosting.Settings(bins=16, min_rows=20, l2=1.0, positive_weight=10.0)


@query(
    f"""WITH {reg.TRADES}, silver AS ({reg.enriched("trades")}),
d AS (SELECT CAST(trade_type = 'block' AS INTEGER) AS y, price, volume, hour_of_day, {_SPREAD} AS spread FROM silver),
pairs AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v, y FROM d" for f in _SCREENED)}),
cuts AS (
  SELECT feature, unnest(list_distinct(quantile_cont(v, [{", ".join(f"{k}/16.0" for k in range(1, 16))}]))) AS cut FROM pairs WHERE v IS NOT NULL GROUP BY feature
  UNION ALL SELECT DISTINCT feature, 'infinity'::DOUBLE FROM pairs),
counted AS (
  SELECT feature, cut, missing_left, count(*) FILTER (WHERE l) AS nl, coalesce(sum(y) FILTER (WHERE l), 0) AS pl, count(*) AS n, sum(y) AS pos
  FROM (SELECT feature, cut, missing_left, y, CASE WHEN v IS NULL THEN missing_left ELSE v <= cut END AS l
        FROM pairs JOIN cuts USING (feature), (VALUES (FALSE), (TRUE)) m(missing_left))
  GROUP BY feature, cut, missing_left),
sums AS (
  SELECT *, 10 * pl * (p - 1) + (nl - pl) * p AS gl, (10 * pl + nl - pl) * p * (1 - p) AS hl,
         10 * pos * (p - 1) + (n - pos) * p AS g, (10 * pos + n - pos) * p * (1 - p) AS h
  FROM counted, (SELECT avg(y) AS p FROM d)),
gains AS (
  SELECT *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain
  FROM sums WHERE nl >= 20 AND n - nl >= 20 AND hl >= 1 AND h - hl >= 1)
SELECT feature, CASE WHEN isfinite(cut) THEN round(cut + 1.37e-6, 4) END AS cut, missing_left, {reg.sql_r4("gain", "gain", 2)},
       nl AS left_rows, n - nl AS right_rows
FROM gains WHERE gain > 1e-9
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(gain, 6) DESC, cut, missing_left) = 1"""
)
def boosted_split_gains(spark, sf_dir):
    """The first split of every feature, with missing values sent to the better side."""
    silver = enrich(fx.trades(spark, sf_dir))
    rows = silver.select("price", "volume", "hour_of_day", F.expr(_SPREAD).alias("spread"), (F.col("trade_type") == "block").cast("int").alias("y"))
    gains = boosting.split_gains(rows, _SCREENED, "y", GAINS)
    return rounded(rounded(gains, "gain", digits=2), "cut")


@query(f"WITH {_TESTS} SELECT CAST(sum(quota) AS BIGINT) AS test_rows, TRUE AS stopped_early, TRUE AS kept_the_best FROM quota")
def boosted_stop_checks(spark, sf_dir):
    """Training ends once two checks of the held-out PR-AUC bring nothing better, and keeps the rounds of the best one."""
    data = prepared(spark, sf_dir)
    rows = data.train.withColumn("is_test", F.lit(False)).unionByName(data.test.withColumn("is_test", F.lit(True)))
    settings = replace(md.BOOSTED_B, rounds=30, step=1.0, depth=3, patience=2, check_every=1)
    model = boosting.fit(cut_lineage(rows), data.features, "is_anomaly", settings, valid="is_test")
    best = max(model.history, key=lambda check: check[1])[0]
    return data.test.agg(F.count("*").alias("test_rows")).select("test_rows", F.lit(len(model.history) == best + 2).alias("stopped_early"), F.lit(len(model.trees) == best).alias("kept_the_best"))


_CODED = ["symbol", "exchange", "trade_type", "session_type"]


@query(
    f"""WITH {reg.TRADES}, silver AS ({reg.enriched("trades")}), train AS (SELECT * FROM silver WHERE symbol <> 'VIEW'),
{", ".join(f"{c}_codes AS (SELECT {c}, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}_code FROM (SELECT DISTINCT {c} FROM train))" for c in _CODED)}
SELECT trade_id, price, volume, hour_of_day, minute_of_hour, {", ".join(f"coalesce({c}_code, -1) AS {c}_code" for c in _CODED)}, CAST(price > 50 AS INTEGER) AS is_anomaly
FROM silver {" ".join(f"LEFT JOIN {c}_codes USING ({c})" for c in _CODED)}"""
)
def prepared_features(spark, sf_dir):
    """Model rows: the contract's columns that are there, categories as codes of the training rows, -1 for unknown ones."""
    rows = enrich(fx.trades(spark, sf_dir)).withColumn("is_anomaly", (F.col("price") > 50).cast("int"))
    return md.prepare(rows.filter("symbol <> 'VIEW'"), rows).test


@query("SELECT count(*) AS trades, TRUE AS is_now FROM events")
def utc_now_stamp(spark, sf_dir):
    """The stamp of a run is the present instant, whatever the session's time zone."""
    stamped = fx.trades(spark, sf_dir).select(F.abs(F.unix_micros(utc_now()) - F.unix_micros(F.current_timestamp())).alias("off"))
    return stamped.agg(F.count("*").alias("trades"), (F.max("off") < 60_000_000).alias("is_now"))
