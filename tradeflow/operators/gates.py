"""Ranking and promotion decisions over model-metric tables.

Metric tables are long: one row per ``(run, metric)``. Decisions come back as one-row tables whose
reasons are text built by Spark, ready to append to an audit table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions.scalar import hash_bucket, short_run_id
from tradeflow.operators.blocks import row_numbers

# Gate parameters.
PRIMARY = "pr_auc"
SECONDARY = ("f1_score", "precision", "recall")
MIN_IMPROVEMENT = 0.005
MIN_PR_AUC, MIN_F1, MAX_LATENCY_MS = 0.5, 0.3, 50.0
CHI2_CRITICAL_5PCT = 3.841
FALLBACK_ARCHITECTURES = ("lightgbm", "xgboost")
# Differences of decimal metrics such as .82 - .81 fall just short of their decimal value in binary.
TOLERANCE = 1e-12


def tournament_rank(metrics: DataFrame, run: Sequence[str] = ("model_type",), primary: str = PRIMARY) -> DataFrame:
    """Runs by primary metric, best first; a run without it (a failed model) counts as 0."""
    value = F.coalesce(F.max(F.when(F.col("metric") == primary, F.col("value"))), F.lit(0.0))
    scores = metrics.groupBy(*run).agg(value.alias(primary)).withColumn("_worse", -F.col(primary))
    ranked = row_numbers(scores, [], ["_worse", *run], "rank").drop("_worse")
    return ranked.withColumn("rank", F.col("rank").cast("int")).withColumn("winner", F.col("rank") == 1)


def comparison_table(
    metrics: DataFrame, names: Sequence[str] = (PRIMARY, *SECONDARY, "accuracy"), seconds: str = "training_time_s"
) -> DataFrame:
    """One row per run with its metrics as columns and the training time at one decimal, best ``pr_auc`` first.

    ``run_id`` stays whole; ``run_id_short`` is its displayed form.
    """
    wide = metrics.groupBy("model_type", "run_id").pivot("metric", [*names, seconds]).agg(F.first("value"))
    shown = wide.withColumn("run_id_short", short_run_id(F.col("run_id"))).withColumn(seconds, F.round(seconds, 1))
    return shown.orderBy(F.col(PRIMARY).desc_nulls_last(), "model_type", "run_id")


def top_architectures(
    metrics: DataFrame,
    primary: str = PRIMARY,
    best_runs: int = 20,
    keep: int = 2,
    known: Sequence[str] | None = None,
    fallback: Sequence[str] = FALLBACK_ARCHITECTURES,
) -> DataFrame:
    """The first ``keep`` distinct model types among the ``best_runs`` best runs, or the fallback pair."""
    runs = metrics.filter(F.col("metric") == primary).orderBy(F.col("value").desc(), "run_id").limit(best_runs)
    if known is not None:
        runs = runs.filter(F.col("model_type").isin(*known))
    best = (
        runs.filter(F.col("model_type").isNotNull())
        .groupBy("model_type")
        .agg(F.max("value").alias("best"), F.min_by("run_id", F.struct(-F.col("value"), "run_id")).alias("run_id"))
    )
    place = F.row_number().over(Window.orderBy(F.col("best").desc(), "run_id"))  # at most best_runs rows
    chosen = best.withColumn("place", place).filter(F.col("place") <= keep).select("model_type", "place")
    spare = metrics.sparkSession.createDataFrame(
        [(name, i) for i, name in enumerate(fallback, 1)], "model_type string, place int"
    )
    found = chosen.agg(F.count(F.lit(1)).alias("found"))
    spare = spare.join(F.broadcast(found), F.col("found") == 0).select("model_type", "place")  # found has one row
    return chosen.unionByName(spare)


def metric_changes(
    challenger: DataFrame, champion: DataFrame, names: Sequence[str] = (PRIMARY, *SECONDARY)
) -> DataFrame:
    """Both sides of each metric and the improvement; a missing metric counts as 0."""
    spine = challenger.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], "metric string, place int")
    both = challenger.select("metric", F.col("value").alias("challenger")).join(
        champion.select("metric", F.col("value").alias("champion")), "metric", "full_outer"
    )
    filled = spine.join(both, "metric", "left").fillna(0.0, subset=["challenger", "champion"])
    return filled.withColumn("improvement", F.col("challenger") - F.col("champion"))


def champion_gate(
    challenger: DataFrame,
    champion: DataFrame,
    threshold: float = MIN_IMPROVEMENT,
    primary: str = PRIMARY,
    secondary: Sequence[str] = SECONDARY,
    require_all: bool = False,
) -> DataFrame:
    """PROMOTE or REJECT, the reason, and every improvement as JSON.

    Without a champion the challenger is promoted. Otherwise the primary metric must gain at least
    ``threshold``; ``require_all`` also asks that no secondary metric falls.
    """
    changes = metric_changes(challenger, champion, (primary, *secondary))
    gain = F.max(F.when(F.col("metric") == primary, F.col("improvement")))
    worst = F.min(F.when(F.col("metric") != primary, F.col("improvement")))
    entries = F.sort_array(F.collect_list(F.struct("place", "metric", F.bround("improvement", 6).alias("gain"))))
    summary = changes.agg(
        gain.alias("gain"),
        F.coalesce(worst, F.lit(0.0)).alias("worst"),
        F.max(F.when(F.col("metric") == primary, F.col("challenger"))).alias("primary_metric_value"),
        F.to_json(
            F.map_from_entries(F.transform(entries, lambda e: F.struct(e["metric"], e["gain"])))
        ).alias("improvement"),
    )
    exists = champion.limit(1).agg(F.count(F.lit(1)).alias("champions"))
    row = summary.unionByName(exists, allowMissingColumns=True)
    row = row.agg(*[F.max(c).alias(c) for c in row.columns])

    enough = F.col("gain") >= threshold - TOLERANCE
    if require_all:
        enough = enough & (F.col("worst") >= -TOLERANCE)
    shown = F.format_string("%.4f", F.col("gain"))
    reason = (
        F.when(F.col("champions") == 0, "No existing champion: first model promoted")
        .when(enough, F.concat(F.lit(f"{primary} improves by "), shown, F.lit(f" (threshold {threshold})")))
        .otherwise(F.concat(F.lit(f"{primary} improves only by "), shown, F.lit(f" (threshold {threshold})")))
    )
    decision = F.when((F.col("champions") == 0) | enough, "PROMOTE").otherwise("REJECT")
    return row.select(
        decision.alias("decision"), reason.alias("reason"), "primary_metric_value", F.col("gain"), "improvement"
    )


def missing_symbols(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required symbols that do not occur."""
    return required.select("symbol").distinct().join(present.select("symbol").distinct(), "symbol", "left_anti")


def validation_gate(
    metrics: DataFrame,
    latency: DataFrame | None = None,
    required: DataFrame | None = None,
    present: DataFrame | None = None,
    min_pr_auc: float = MIN_PR_AUC,
    min_f1: float = MIN_F1,
    max_latency_ms: float = MAX_LATENCY_MS,
) -> DataFrame:
    """One row per check with its detail, plus ``all_passed``. A check without input passes as skipped.

    ``latency`` has one row with ``p99_latency_ms``.
    """

    def of(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("metric") == name, F.col("value"))), F.lit(0.0))

    def limit_text(label: str, name: str, bound: str) -> Column:
        return F.concat(F.lit(f"{label}: "), F.format_string("%.4f", F.col(name)), F.lit(f" ({bound})"))

    values = metrics.agg(of("pr_auc").alias("pr_auc"), of("f1_score").alias("f1"))
    spark = metrics.sparkSession
    rows = [
        values.select(
            F.inline(
                F.array(
                    F.struct(
                        F.lit("performance_pr_auc").alias("check"),
                        (F.col("pr_auc") >= min_pr_auc).alias("passed"),
                        limit_text("PR-AUC", "pr_auc", f"min: {min_pr_auc}").alias("detail"),
                    ),
                    F.struct(
                        F.lit("performance_f1").alias("check"),
                        (F.col("f1") >= min_f1).alias("passed"),
                        limit_text("F1", "f1", f"min: {min_f1}").alias("detail"),
                    ),
                )
            )
        )
    ]
    skipped = []
    if latency is not None:
        slowest = latency.agg(F.max("p99_latency_ms").alias("p99"))
        rows.append(
            slowest.select(
                F.lit("latency").alias("check"),
                F.coalesce(F.col("p99") <= max_latency_ms, F.lit(True)).alias("passed"),
                limit_text("p99 ms", "p99", f"max: {max_latency_ms}").alias("detail"),
            )
        )
    else:
        skipped.append("latency")
    if required is not None and present is not None:
        # The names can be many; ``missing_symbols`` lists them.
        missing = missing_symbols(required, present).agg(F.count(F.lit(1)).alias("n"))
        rows.append(
            missing.select(
                F.lit("data_coverage").alias("check"),
                (F.col("n") == 0).alias("passed"),
                F.concat(F.lit("Missing symbols: "), F.col("n").cast("string")).alias("detail"),
            )
        )
    else:
        skipped.append("data_coverage")
    if skipped:
        rows.append(
            spark.createDataFrame([(s, True, "Skipped") for s in skipped], "check string, passed boolean, detail string")
        )
    checks = rows[0]
    for row in rows[1:]:
        checks = checks.unionByName(row)
    return checks.withColumn("all_passed", F.every("passed").over(Window.partitionBy()))  # four rows


def assign_variant(df: DataFrame, key: str, treatment_pct: int = 20, salt: str = "ab") -> DataFrame:
    """Fixed control / treatment variant per key."""
    bucket = hash_bucket(salt, F.col(key))
    return df.withColumn("variant", F.when(bucket < treatment_pct, "treatment").otherwise("control"))


def ab_decision(variants: DataFrame, metric: str = PRIMARY) -> DataFrame:
    """Conclusion from one row per variant (``variant``, ``<metric>``), strictly better wins."""

    def of(name: str) -> Column:
        return F.max(F.when(F.col("variant") == name, F.col(metric)))

    both = variants.agg(of("control").alias("control"), of("treatment").alias("treatment"))
    decision = (
        F.when(F.col("control").isNull() | F.col("treatment").isNull(), "NEEDS_MORE_DATA")
        .when(F.col("treatment") > F.col("control"), "PROMOTE_TREATMENT")
        .otherwise("KEEP_CONTROL")
    )
    return both.select("control", "treatment", decision.alias("decision"))


def experiment_decision(experiments: DataFrame, experiment_id: str, metric: str = PRIMARY) -> DataFrame:
    """``ab_decision`` for one experiment of a table; an unknown id concludes with ERROR."""
    mine = experiments.filter(F.col("experiment_id") == experiment_id)
    known = mine.limit(1).agg((F.count(F.lit(1)) > 0).alias("known"))
    row = ab_decision(mine, metric).unionByName(known, allowMissingColumns=True)
    row = row.agg(*[F.max(c).alias(c) for c in row.columns])
    return row.select(
        "control", "treatment", F.when(F.col("known"), F.col("decision")).otherwise("ERROR").alias("decision")
    )


def swap_decision(metrics: DataFrame, champion_run: str, challenger_run: str, primary: str = PRIMARY) -> DataFrame:
    """PROMOTE if the challenger's run metric is strictly higher, else ROLLBACK; missing counts as 0."""

    def of(run: str) -> Column:
        mine = (F.col("run_id") == run) & (F.col("metric") == primary)
        return F.coalesce(F.max(F.when(mine, F.col("value"))), F.lit(0.0))

    both = metrics.agg(of(champion_run).alias("champion"), of(challenger_run).alias("challenger"))
    better = F.col("challenger") > F.col("champion")
    return both.withColumn("decision", F.when(better, "PROMOTE").otherwise("ROLLBACK"))


def ab_chi2(outcomes: DataFrame, success: str = "success", min_samples: int = 1000) -> DataFrame:
    """Chi-square test of the success rates of two variants against the 5 % critical value."""

    def n(variant: str, ok: int) -> Column:
        return F.count_if((F.col("variant") == variant) & (F.col(success) == ok)).cast("double")

    table = outcomes.agg(
        n("control", 1).alias("a"), n("control", 0).alias("b"), n("treatment", 1).alias("c"), n("treatment", 0).alias("d")
    )
    a, b, c, d = (F.col(x) for x in "abcd")
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    cross = a * d - b * c
    chi2 = F.when(margins > 0, (a + b + c + d) * cross * cross / margins).otherwise(0.0)
    enough = F.least(a + b, c + d) >= min_samples
    decision = (
        F.when(~F.col("enough"), "NEEDS_MORE_DATA")
        .when(F.col("chi2") <= CHI2_CRITICAL_5PCT, "KEEP_CONTROL")
        .when(F.col("treatment_rate") > F.col("control_rate"), "PROMOTE_TREATMENT")
        .otherwise("KEEP_CONTROL")
    )
    return (
        table.select(
            (a + b).cast("bigint").alias("control_n"),
            (c + d).cast("bigint").alias("treatment_n"),
            F.when(a + b > 0, a / (a + b)).alias("control_rate"),
            F.when(c + d > 0, c / (c + d)).alias("treatment_rate"),
            chi2.alias("chi2"),
            enough.alias("enough"),
        )
        .withColumn("decision", decision)
    )


def long_metrics(wide: DataFrame, ids: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Metric columns to ``(ids..., metric, value)`` rows."""
    return wide.unpivot(list(ids), list(names), "metric", "value")
