"""The drift report from stored daily counts: a run reads the rows of new days only.

A day's rows leave two stored tables, partitioned by day: ``counts`` (feature, cell, value, rows) and, much smaller,
``cells`` (feature, cell, rows, least and greatest value). A cell is a narrow range of numbers on a scale of about half a
percent, the same for all days, so the cells of any days add up. Categories are counts without cells.

The report is exact. The reference window's summed cells tell in which cells the wanted percentiles lie, and the values of
those few cells are read from ``counts``. With the bin edges known, a cell whose least and greatest values fall into the same
bin is counted as a whole; only the values of cells that an edge divides are read. ``counts`` is written in ranges of feature
and cell, so files and row groups without wanted cells are skipped.

Days end at midnight UTC, the instant itself included; a repeated recording of a day replaces it.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.functions.search import with_upper_bound
from tradeflow.operators.drift import (
    JS_THRESHOLD,
    PSI_BINS,
    PSI_THRESHOLD,
    REFERENCE_DAYS,
    bin_of,
    js_of_counts,
    psi_of_counts,
    rated,
)
from tradeflow.operators.quantiles import interpolate, wanted_ranks
from tradeflow.session import cut_lineage

DAY = 86_400_000_000  # microseconds
#: Cells for each factor of e.
FINENESS = 200
#: Above the number of cells between 1 and the smallest double.
_OFFSET = 160_000
_LARGEST = sys.float_info.max  # infinities share its cell

_COUNTS = "feature string, cell long, value double, category string, n long, day long"
_CELLS = "feature string, cell long, n long, low double, high double, day long"
_DAYS = "rows long, day long"


def day_of(time: Column) -> Column:
    """Number of the day that a time belongs to; midnight belongs to the day that ends."""
    at = F.unix_micros(time)
    return ((at + F.pmod(-at, F.lit(DAY))) / DAY).cast("long")


def day_sides(df: DataFrame, last_day: int, days: int = REFERENCE_DAYS, time: str = "timestamp") -> DataFrame:
    """Rows of ``last_day`` (``current``) and of the ``days`` before it (``reference``), by whole days."""
    number = day_of(F.col(time))
    side = F.when(number == last_day, "current").otherwise("reference")
    return _within(df, time, last_day - days - 1, last_day).withColumn("side", side)


def _within(df: DataFrame, time: str, after: int | None, until: int) -> DataFrame:
    """Rows after the end of one day and up to the end of another, as a filter on the time itself."""
    found = df.filter(F.col(time) <= F.timestamp_micros(F.lit(until * DAY)))
    return found if after is None else found.filter(F.col(time) > F.timestamp_micros(F.lit(after * DAY)))


def cell_of(value: Column) -> Column:
    """Number of a value's cell; it never falls when the value grows."""
    level = F.floor(F.ln(F.least(F.abs(value), F.lit(_LARGEST))) * FINENESS) + _OFFSET
    return F.when(value > 0, level).when(value < 0, -level).otherwise(0).cast("long")


def recorded_days(spark: SparkSession, folder: str) -> DataFrame:
    """``day, rows`` of every recorded day."""
    return _stored(spark, folder, "days", _DAYS).select("day", "rows")


def _stored(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/{name}")


def record(df: DataFrame, folder: str, numeric: Sequence[str], categorical: Sequence[str], time: str = "timestamp") -> None:
    """Store the counts of all days in ``df``, whole days each; recorded ones are replaced."""
    spark = df.sparkSession
    day = day_of(F.col(time)).alias("day")
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"), F.lit(None).cast("string").alias("category")) for f in numeric if f in df.columns]
    cells += [F.struct(F.lit(f).alias("feature"), F.lit(None).cast("double").alias("value"), F.col(f).cast("string").alias("category")) for f in categorical if f in df.columns]
    known = df.filter(F.col(time).isNotNull())
    pairs = known.select(day, F.inline(F.array(*cells))).filter("(value IS NOT NULL AND NOT isnan(value)) OR category IS NOT NULL")
    plain = F.col("value") + F.lit(0.0)  # no negative zeros
    cell = F.when(F.col("value").isNotNull(), cell_of(F.col("value")))
    counts = pairs.groupBy("day", "feature", cell.alias("cell"), plain.alias("value"), "category").agg(F.count("*").alias("n"))
    _write(counts.repartitionByRange("day", "feature", "cell", "value", "category").sortWithinPartitions("day", "feature", "cell", "value"), f"{folder}/counts")
    days = [r["day"] for r in known.select(day).distinct().collect()]  # one number a day
    fresh = _stored(spark, folder, "counts", _COUNTS).filter(F.col("day").isin(days) & F.col("cell").isNotNull())
    sums = fresh.groupBy("day", "feature", "cell").agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    _write(sums.repartition("day"), f"{folder}/cells")
    _write(known.groupBy(day).agg(F.count("*").alias("rows")).coalesce(1), f"{folder}/days")


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def record_new(df: DataFrame, folder: str, numeric: Sequence[str], categorical: Sequence[str], last_day: int, time: str = "timestamp") -> None:
    """Store the days after the last recorded one, up to ``last_day``; the filter on ``time`` reaches the scan."""
    newest = recorded_days(df.sparkSession, folder).agg(F.max("day")).first()[0]
    if newest is None or newest < last_day:
        record(_within(df, time, newest, last_day), folder, numeric, categorical, time)


def _on_sides(rows: DataFrame, last_day: int, days: int) -> DataFrame:
    """Stored rows of the two windows with ``r`` and ``c``: their rows on the reference and on the current side."""
    inside = rows.filter(F.col("day").between(last_day - days, last_day))
    is_current = F.col("day") == last_day
    return inside.withColumn("r", F.when(is_current, 0).otherwise(F.col("n"))).withColumn("c", F.when(is_current, F.col("n")).otherwise(0))


def _sums() -> list[Column]:
    return [F.sum("r").alias("r"), F.sum("c").alias("c")]


def report(
    spark: SparkSession,
    folder: str,
    last_day: int,
    days: int = REFERENCE_DAYS,
    psi_threshold: float = PSI_THRESHOLD,
    js_threshold: float = JS_THRESHOLD,
) -> DataFrame:
    """The rows of ``drift_report`` over ``day_sides``, from stored counts."""
    counts = _on_sides(_stored(spark, folder, "counts", _COUNTS), last_day, days)
    categories = counts.filter(F.col("category").isNotNull()).groupBy("feature", F.col("category").alias("value")).agg(*_sums())
    numbers = counts.filter(F.col("cell").isNotNull())
    psi = _psi(numbers, _on_sides(_stored(spark, folder, "cells", _CELLS), last_day, days))
    return rated(psi, "psi", psi_threshold).unionByName(rated(js_of_counts(cut_lineage(categories)), "js_divergence", js_threshold))


def sizes(spark: SparkSession, folder: str, last_day: int, days: int = REFERENCE_DAYS) -> DataFrame:
    """One row: ``reference_size, current_size``."""
    found = _on_sides(recorded_days(spark, folder).withColumnRenamed("rows", "n"), last_day, days)
    return found.agg(F.coalesce(F.sum("r"), F.lit(0)).alias("reference_size"), F.coalesce(F.sum("c"), F.lit(0)).alias("current_size"))


def _psi(numbers: DataFrame, daily_cells: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    # At most a few thousand cells a feature, whatever the number of rows.
    cells = cut_lineage(daily_cells.groupBy("feature", "cell").agg(*_sums(), F.min("low").alias("low"), F.max("high").alias("high")))
    edges = cut_lineage(_edges(numbers, cells, [i / bins for i in range(bins + 1)]))  # one row per feature
    bounds = cells.join(F.broadcast(edges), "feature")
    for side in ("low", "high"):
        bounds = with_upper_bound(bounds, f"_{side}", "edges", F.col(side), bins + 1)
    top = F.element_at("edges", -1)
    alike = (F.col("_low") == F.col("_high")) & ((F.col("low") == top) == (F.col("high") == top))
    placed = cut_lineage(bounds.select("feature", "cell", "r", "c", bin_of("_low", "low").alias("bin"), alike.alias("alike")))
    divided = placed.filter("NOT alike").select("feature", "cell")  # at most one for each edge and feature
    values = numbers.join(F.broadcast(divided), ["feature", "cell"], "left_semi").groupBy("feature", "value").agg(*_sums())
    values = with_upper_bound(values.join(F.broadcast(edges), "feature"), "_found", "edges", F.col("value"), bins + 1)
    both = placed.filter("alike").select("feature", "bin", "r", "c").unionByName(values.select("feature", bin_of("_found", "value").alias("bin"), "r", "c"))
    return psi_of_counts(edges, cut_lineage(both.groupBy("feature", "bin").agg(*_sums())))


def _edges(numbers: DataFrame, cells: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Distinct exact percentiles of the reference side, from the cells and the values of those that hold wanted ranks."""
    through = Window.partitionBy("feature").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    summed = cells.filter("r > 0").withColumn("end", F.sum("r").over(through))
    totals = cells.groupBy("feature").agg(F.sum("r").alias("n")).filter("n > 0")
    ranks = wanted_ranks(totals, ["feature"], probs)  # 1-based
    inside = F.col("rank").between(F.col("end") - F.col("r") + 1, F.col("end"))
    hits = cut_lineage(ranks.join(summed, "feature").filter(inside).select("feature", "n", "rank", "cell", (F.col("rank") - F.col("end") + F.col("r")).alias("place")))
    wanted = hits.select("feature", "cell").distinct()  # at most two for each percentile and feature
    values = numbers.filter("r > 0").join(F.broadcast(wanted), ["feature", "cell"], "left_semi")
    values = values.groupBy("feature", "cell", "value").agg(F.sum("r").alias("r"))
    upto = Window.partitionBy("feature", "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = values.withColumn("last", F.sum("r").over(upto))
    found = hits.join(placed, ["feature", "cell"]).filter(F.col("place").between(F.col("last") - F.col("r") + 1, F.col("last")))
    ranked = found.select("feature", "n", "rank", F.col("value").alias("x"))
    return interpolate(ranked, ["feature"], probs).select("feature", F.array_distinct("percentiles").alias("edges"))
