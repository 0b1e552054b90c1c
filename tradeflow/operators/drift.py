"""Distribution drift: PSI for numbers, Jensen-Shannon for categories, and the report over both.

All features are handled in one pass each: rows are turned into (feature, value) pairs and reduced
to counts before anything is shuffled. What follows works on tables of features times bins.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.functions.scalar import report_round
from tradeflow.functions.search import with_upper_bound
from tradeflow.operators.quantiles import DIRECT_LIMIT, exact_percentiles
from tradeflow.session import cut_lineage

# Thresholds and smoothing of the two measures.
PSI_THRESHOLD = 0.2
JS_THRESHOLD = 0.1
PSI_BINS = 10
JS_SMOOTHING = 1e-10
REFERENCE_DAYS = 30


def drift_windows(
    df: DataFrame, as_of: datetime | Column | None = None, days: int = REFERENCE_DAYS, time: str = "timestamp"
) -> DataFrame:
    """Rows of the last day (``side = 'current'``) and of the ``days`` before it (``'reference'``).

    ``as_of`` defaults to the newest time in ``df``. Both bounds are constants in the scan filter.
    """
    if as_of is None:
        as_of = df.agg(F.max(time)).first()[0]
    newest = as_of if isinstance(as_of, Column) else F.lit(as_of)
    day = F.make_dt_interval(F.lit(1))
    oldest = newest - F.make_dt_interval(F.lit(days + 1))
    is_current = F.col(time) > newest - day
    return df.filter(F.col(time) >= oldest).withColumn("side", F.when(is_current, "current").otherwise("reference"))


def tag_sides(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Stack two windows; features that only one of them has are left out."""
    shared = [c for c in reference.columns if c in current.columns]
    return reference.select(*shared, F.lit("reference").alias("side")).unionByName(
        current.select(*shared, F.lit("current").alias("side"))
    )


def _pairs(df: DataFrame, features: Sequence[str], kind: str) -> DataFrame:
    """(side, feature, value) with NULL values left out."""
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f).cast(kind).alias("value")) for f in features if f in df.columns]
    return df.select("side", F.inline(F.array(*cells))).filter(F.col("value").isNotNull())


def _on(side: str) -> Column:
    return F.col("side") == side


def psi(
    sides: DataFrame, features: Sequence[str], bins: int = PSI_BINS, direct_limit: int = DIRECT_LIMIT
) -> DataFrame:
    """Population stability index per numeric feature; features with an empty side are absent.

    Bins are the distinct quantiles of the reference side, closed below and, for the last one, above.
    Counts get +1; denominators are all values of the side plus the number of edges. Values outside
    the edges count only towards the denominator, and a constant feature has no bins and PSI 0.
    """
    pairs = _pairs(sides, features, "double")
    edges = exact_percentiles(
        pairs.filter(_on("reference")), ["feature"], "value", [i / bins for i in range(bins + 1)], direct_limit
    ).select("feature", F.array_distinct("percentiles").alias("edges"))
    edges = cut_lineage(edges)  # one row per feature

    placed = with_upper_bound(
        pairs.join(F.broadcast(edges), "feature"), "_found", "edges", F.col("value"), bins + 1
    )
    counts = placed.groupBy("feature", bin_of("_found", "value").alias("bin")).agg(
        F.count_if(_on("reference")).alias("r"), F.count_if(_on("current")).alias("c")
    )
    return psi_of_counts(edges, cut_lineage(counts))  # features * (bins + 1) rows


def bin_of(found: str, value: str) -> Column:
    """Bin of a value from the number of ``edges`` up to it; -1 outside. The last bin is closed above."""
    size, number = F.size("edges"), F.col(found)
    is_top = F.col(value) == F.element_at("edges", -1)
    return F.when(is_top, size - 2).when((number == 0) | (number == size), F.lit(-1)).otherwise(number - 1)


def psi_of_counts(edges: DataFrame, counts: DataFrame) -> DataFrame:
    """PSI of ``feature, bin, r, c`` (rows of the reference and the current side) with ``feature, edges``."""
    size = F.size("edges")
    totals = counts.groupBy("feature").agg(F.sum("r").alias("n_r"), F.sum("c").alias("n_c"))
    spine = edges.select(
        "feature", size.alias("n_edges"), F.explode_outer(F.when(size > 1, F.sequence(F.lit(0), size - 2))).alias("bin")
    )

    def share(count: str, total: str) -> Column:
        return (F.coalesce(F.col(count), F.lit(0)) + 1) / (F.col(total) + F.col("n_edges"))

    r, c = share("r", "n_r"), share("c", "n_c")
    term = F.when(F.col("bin").isNotNull(), (c - r) * F.ln(c / r)).otherwise(0.0)
    return (
        spine.join(counts, ["feature", "bin"], "left")
        .join(totals, "feature")
        .filter((F.col("n_r") > 0) & (F.col("n_c") > 0))
        .groupBy("feature")
        .agg(F.sum(term).alias("value"))
    )


def js_divergence(sides: DataFrame, features: Sequence[str]) -> DataFrame:
    """Jensen-Shannon divergence (nats) per categorical feature over the union of categories."""
    counts = _pairs(sides, features, "string").groupBy("feature", "value")
    return js_of_counts(cut_lineage(counts.agg(F.count_if(_on("reference")).alias("r"), F.count_if(_on("current")).alias("c"))))


def js_of_counts(counts: DataFrame) -> DataFrame:
    """Jensen-Shannon divergence of stored ``feature, value, r, c``."""
    totals = counts.groupBy("feature").agg(
        F.sum("r").alias("n_r"), F.sum("c").alias("n_c"), F.count(F.lit(1)).alias("k")
    )

    def share(count: str, total: str) -> Column:
        return (F.col(count) / F.col(total) + JS_SMOOTHING) / (1 + F.col("k") * JS_SMOOTHING)

    p, q = share("r", "n_r"), share("c", "n_c")
    middle = (p + q) / 2
    term = (p * F.ln(p / middle) + q * F.ln(q / middle)) / 2
    return (
        counts.join(F.broadcast(totals), "feature")  # one row per feature
        .filter((F.col("n_r") > 0) & (F.col("n_c") > 0))
        .groupBy("feature")
        .agg(F.sum(term).alias("value"))
    )


def rated(values: DataFrame, metric: str, threshold: float) -> DataFrame:
    """Report rows of ``feature, value``."""
    return values.select(
        "feature",
        F.lit(metric).alias("metric"),
        "value",
        F.lit(float(threshold)).alias("threshold"),
        (F.col("value") > threshold).alias("drifted"),
    )


def drift_report(
    sides: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    psi_threshold: float = PSI_THRESHOLD,
    js_threshold: float = JS_THRESHOLD,
    direct_limit: int = DIRECT_LIMIT,
) -> DataFrame:
    """One row per feature: measure, unrounded value, threshold, and whether it is exceeded."""
    parts = []
    if any(f in sides.columns for f in numeric):
        parts.append(rated(psi(sides, numeric, direct_limit=direct_limit), "psi", psi_threshold))
    if any(f in sides.columns for f in categorical):
        parts.append(rated(js_divergence(sides, categorical), "js_divergence", js_threshold))
    if not parts:
        raise ValueError("none of the features exists in both windows")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def drift_summary(sides: DataFrame, report: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The audit row: sizes, overall flag, drifted features and details as JSON text."""
    sizes = sides.agg(
        F.count_if(_on("reference")).alias("reference_size"), F.count_if(_on("current")).alias("current_size")
    )
    detail = F.struct(
        "metric", report_round(F.col("value")).alias("value"), "threshold", "drifted"
    )
    flags = report.agg(
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("overall_drift"),
        F.to_json(F.sort_array(F.collect_list(F.when(F.col("drifted"), F.col("feature"))))).alias("drifted_features"),
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature", detail))))).alias(
            "feature_drift_details"
        ),
    )
    both = sizes.unionByName(flags, allowMissingColumns=True)  # two one-row tables folded into one row
    merged = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return merged.select((as_of if as_of is not None else F.current_timestamp()).alias("timestamp"), "*")


def prediction_drift(sides: DataFrame, score: str, threshold: float = PSI_THRESHOLD) -> DataFrame:
    """PSI of the model scores."""
    return psi(sides, [score]).select(
        F.col("value").alias("prediction_psi"),
        F.lit(float(threshold)).alias("threshold"),
        (F.col("value") > threshold).alias("drifted"),
    )
