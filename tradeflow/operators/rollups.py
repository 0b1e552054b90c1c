"""Mergeable rollups of the inference log and of micro-batches: totals, quantile sketches and distinct counts.

A rollup is made once for each window, micro-batch or day and added to a table; metrics of any range and any coarser grouping
come from its rows, never from the log. Totals add up. A quantile sketch is a histogram whose cells grow by a constant factor,
so a value taken from its cell is off by at most ``ERROR`` of itself, however many sketches are merged (their cells add up
exactly). A distinct count is a HyperLogLog sketch of ``2 ** LOG_K`` registers (standard error ``1.04 / sqrt(2 ** LOG_K)``,
1.6 %); sketches of overlapping batches merge into the sketch of their union, and a batch that is rolled up twice
counts its keys once.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest relative error of a quantile, and the base-2 logarithm of a distinct sketch's registers.
ERROR, LOG_K = 0.005, 12
GROWTH = (1 + ERROR) / (1 - ERROR)


def cell_of(value: Column) -> Column:
    """Cell of a value: 0 for 0, else its magnitude's cell with the value's sign, kept off 0."""
    level = F.ceil(F.ln(F.abs(value)) / log(GROWTH)) + 200_000
    return F.when(value > 0, level).when(value < 0, -level).otherwise(0).cast("long")


def value_of(cell: Column) -> Column:
    """The value that stands for a cell: at most ``ERROR`` of itself away from any value in it."""
    size = F.exp((F.abs(cell) - 200_000) * log(GROWTH)) * (2 / (GROWTH + 1))
    return F.when(cell > 0, size).when(cell < 0, -size).otherwise(0.0)


def _sketch(key: str) -> Column:
    """Distinct values of a column; the sketch itself would pass over the empty text."""
    return F.hll_sketch_agg(F.concat(F.lit("="), F.col(key).cast("string")), LOG_K)


def rollup(
    log_rows: DataFrame, by: Sequence[str], value: str, key: str, granularity: str = "30 minutes", time: str = "timestamp"
) -> DataFrame:
    """One row for each window and group: ``rows``, ``total`` and ``cells`` of the values (NULL and NaN left out), ``keys`` sketch of the distinct keys.

    ``cells`` is an array of ``cell, n``; its length follows the spread of the values (a factor of ten takes 231
    cells), not their number. Two partial aggregations, no sort of the log.
    """
    window = F.window(time, granularity).alias("w")
    number = F.nullif(F.col(value).cast("double"), F.lit(float("nan")))
    counts = log_rows.groupBy(window, *by, F.when(number.isNotNull(), cell_of(number)).alias("cell")).agg(
        F.count("*").alias("n"), F.sum(number).alias("total"), _sketch(key).alias("keys")
    )
    some = F.filter(F.collect_list(F.struct("cell", "n")), lambda c: c["cell"].isNotNull())
    return (
        counts.groupBy("w", *by)
        .agg(F.sum("n").alias("rows"), F.sum("total").alias("total"), some.alias("cells"), F.hll_union_agg("keys").alias("keys"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "rows", "total", "cells", "keys")
    )


def merged(rollups: DataFrame, by: Sequence[str], quantiles: Sequence[float] = (0.5, 0.99)) -> DataFrame:
    """Metrics of the groups over all given rollup rows: ``rows, average, distinct_keys`` and ``q50``, ``q99`` and so on.

    A quantile is that of the value at rank ``floor(q * (n - 1))``, without interpolation. ``by`` may be coarser than that of the rollups.
    """
    by = list(by)
    totals = rollups.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("distinct_keys")
    )
    cells = rollups.select(*by, F.inline("cells")).groupBy(*by, "cell").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    ranked = cells.withColumns({"end": F.sum("n").over(upto), "all": F.sum("n").over(whole)})  # cells, not rows

    def at(q: float) -> Column:
        rank = F.floor(F.lit(q) * (F.col("all") - 1))
        return F.max(F.when((rank < F.col("end")) & (rank >= F.col("end") - F.col("n")), value_of(F.col("cell")))).alias(f"q{round(100 * q)}")

    found = ranked.groupBy(*by).agg(F.max("all").alias("_values"), *[at(q) for q in quantiles])
    same = [totals[c].eqNullSafe(found[c]) for c in by]
    joined = totals.join(found, same, "left") if by else totals.join(found, F.lit(True), "left")  # one row each without groups
    return joined.select(
        *[totals[c] for c in by], "rows", (F.col("total") / F.col("_values")).alias("average"), "distinct_keys", *[f"q{round(100 * q)}" for q in quantiles]
    )


def batch_rollup(batch: DataFrame, batch_id: int | Column = 0) -> DataFrame:
    """One mergeable row of a micro-batch: what ``batch_quality`` reports, with the symbols as a sketch and the prices' moments."""
    number = batch_id if isinstance(batch_id, Column) else F.lit(batch_id).cast("bigint")
    price = F.col("price").cast("double")
    return batch.agg(
        F.count("*").alias("count"),
        _sketch("symbol").alias("symbols"),
        F.count("price").alias("prices"),
        F.avg(price).alias("mean"),
        (F.var_pop(price) * F.count("price")).alias("spread"),
        F.coalesce(F.sum("volume"), F.lit(0.0)).alias("total_volume"),
        F.min("timestamp").alias("min_timestamp"),
        F.max("timestamp").alias("max_timestamp"),
    ).select(number.alias("batch_id"), "*")


def merged_quality(batches: DataFrame) -> DataFrame:
    """``batch_quality`` of all given batches together; the number of symbols is an estimate."""
    n = F.sum("prices")
    mean = F.sum(F.col("mean") * F.col("prices")) / n
    # Spread around the common mean: the batches' own, and that of their means.
    totals = batches.agg(
        F.sum("count").alias("count"), F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("symbols")), F.lit(0)).alias("distinct_symbols"),
        n.alias("n"), mean.alias("mean"), F.sum("spread").alias("within"), F.sum("total_volume").alias("total_volume"),
        F.min("min_timestamp").alias("min_timestamp"), F.max("max_timestamp").alias("max_timestamp"),
        F.collect_list(F.struct("prices", "mean")).alias("means"),  # one entry a batch
    )
    between = F.aggregate("means", F.lit(0.0), lambda a, m: a + F.coalesce(m["prices"] * (m["mean"] - F.col("mean")) * (m["mean"] - F.col("mean")), F.lit(0.0)))
    deviation = F.when(F.col("n") > 1, F.sqrt((F.col("within") + between) / (F.col("n") - 1))).otherwise(0.0)
    return totals.select(
        "count", "distinct_symbols", F.coalesce("mean", F.lit(0.0)).alias("avg_price"), F.coalesce(deviation, F.lit(0.0)).alias("stddev_price"),
        "total_volume", "min_timestamp", "max_timestamp",
    )
