"""Classification metrics per model, on tables of scores of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions.scalar import safe_div
from tradeflow.operators.blocks import BLOCK, assign_blocks, fit_blocks, match_keys, preceding_totals
from tradeflow.operators.quantiles import DIRECT_LIMIT, exact_percentiles


def average_precision(
    scored: DataFrame,
    by: Sequence[str] = ("model",),
    score: str = "score",
    label: str = "y",
    rows_per_block: int | None = None,
    count: str | None = None,
) -> DataFrame:
    """Area under the precision-recall steps: sum of (recall gained) * precision per distinct score.
    A model without positives gets 0. ``count`` names how many scored rows a row stands for; ``label`` then counts its positives.

    Equal scores form one step. The running counts of a large model are taken block by block and
    start from the totals of the blocks above, so no model is sorted in a single task.
    """
    by = list(by)
    rows = scored.select(*by, (-F.col(score)).alias("_rank"), F.col(label).cast("bigint").alias("_y"), (F.col(count) if count else F.lit(1)).cast("bigint").alias("_n"))
    blocks = fit_blocks(rows, by, ["_rank"], rows_per_block)
    placed = assign_blocks(rows, blocks) if blocks.cuts is not None else rows

    steps = placed.groupBy(*blocks.partition, "_rank").agg(
        F.sum("_y").alias("_hits"), F.sum("_n").alias("_rows")
    )
    so_far = blocks.window().rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.select(
        *blocks.partition, "_hits", F.sum("_hits").over(so_far).alias("_tp"), F.sum("_rows").over(so_far).alias("_seen")
    )
    above = preceding_totals(
        placed, blocks, {"_tp_above": F.sum("_y"), "_seen_above": F.sum("_n")}
    )
    if above is not None:
        # One row per block of a large model: at most max_blocks rows.
        steps = match_keys(steps, above, [*by, BLOCK], "left").select(
            *by,
            "_hits",
            (F.col("_tp") + F.coalesce("_tp_above", F.lit(0))).alias("_tp"),
            (F.col("_seen") + F.coalesce("_seen_above", F.lit(0))).alias("_seen"),
        )
    return steps.groupBy(*by).agg(
        safe_div(F.sum(F.col("_hits") * F.col("_tp") / F.col("_seen")), F.sum("_hits")).alias("pr_auc")
    )


def confusion_metrics(
    scored: DataFrame, by: Sequence[str] = ("model",), predicted: str = "prediction", label: str = "y"
) -> DataFrame:
    """Precision, recall, F1 (0 where undefined) and accuracy from one aggregation."""
    hit, said = F.col(label) == 1, F.col(predicted) == 1
    counts = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(hit & said).alias("tp"),
        F.count_if(~hit & said).alias("fp"),
        F.count_if(hit & ~said).alias("fn"),
        F.count_if(~hit & ~said).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "*",
        safe_div(tp, tp + fp).alias("precision"),
        safe_div(tp, tp + fn).alias("recall"),
        safe_div(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        safe_div(tp + F.col("tn"), F.col("n")).alias("accuracy"),
    )


def model_metrics(
    scored: DataFrame,
    by: Sequence[str],
    score: str = "score",
    label: str = "y",
    predicted: str | None = None,
    cutoff: float = 0.5,
) -> DataFrame:
    """All metrics of every run: ``pr_auc``, ``f1_score``, ``precision``, ``recall``, ``accuracy``.

    Without a ``predicted`` column, scores from ``cutoff`` up count as positive.
    """
    if predicted is None:
        predicted = "prediction"
        scored = scored.withColumn(predicted, (F.col(score) >= cutoff).cast("int"))
    rates = confusion_metrics(scored, by, predicted, label)
    area = average_precision(scored, by, score, label)
    return match_keys(area, rates, list(by), small=False).select(*by, "pr_auc", "f1_score", "precision", "recall", "accuracy")


def latency_p99(
    log: DataFrame, by: Sequence[str] = ("model_name",), latency: str = "execution_duration_ms",
    direct_limit: int = DIRECT_LIMIT,
) -> DataFrame:
    """Exact 99th percentile with linear interpolation."""
    exact = exact_percentiles(log, by, latency, [0.99], direct_limit)
    return exact.select(*by, F.col("percentiles")[0].alias("p99_latency_ms"))
