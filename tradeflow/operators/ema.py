"""Exponential moving averages without a row loop.

The recursion y[t] = a*x[t] + (1-a)*y[t-1] is a weighted sum of the past whose weights fall off
geometrically. Rows are numbered inside their window partition and cut into runs of ``RUN`` rows.
Inside a run, a running sum of x[i] / (1-a)^i gives the run's own share; the ends of earlier runs, decayed,
give the rest. As many runs count (``carry_for``) as leave out less than one rounding error.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.operators.blocks import Blocks

RUN = 256


def history_for(span: int) -> int:
    """Rows after which an older value weighs less than one unit in the last place (2^-53)."""
    return math.ceil(53 * math.log(2) / -math.log(1 - 2 / (span + 1))) if span > 1 else 1


EMA_HISTORY = history_for(26)


def carry_for(span: int) -> int:
    """Earlier runs whose ends still matter."""
    return -(-history_for(span) // RUN) + 1


def ema_columns(rows: DataFrame, value: str, spans: dict[str, int], blocks: Blocks) -> DataFrame:
    """Add one average per entry of ``spans`` (output name -> span), seeded with the first value.

    ``rows`` already carries the history copies for the longest span; the windows reuse the
    partitioning of ``blocks``, so no further shuffle happens.
    """
    if any(span < 1 for span in spans.values()):
        raise ValueError(f"spans start at 1: {sorted(spans.values())}")
    plain = {name: span for name, span in spans.items() if span == 1}  # the value itself
    rows_out = rows.columns
    rows = rows.select("*", *[F.col(value).cast("double").alias(name) for name in plain])
    spans = {name: span for name, span in spans.items() if span > 1}
    if not spans:
        return rows
    trail = blocks.window()
    numbered = rows.withColumn("_n", F.row_number().over(trail) - 1).select(
        "*",
        F.floor(F.col("_n") / RUN).cast("int").alias("_run"),
        (F.col("_n") % RUN).alias("_at"),
    )
    inside = Window.partitionBy(*blocks.partition, "_run").orderBy("_at")
    through = inside.rowsBetween(Window.unboundedPreceding, 0)

    def decay(span: int, power: Column) -> Column:
        return F.pow(F.lit(1 - 2 / (span + 1)), power)

    # The seed counts as if all of the infinite past had its value: weight 1 instead of a.
    own = {}
    for name, span in spans.items():
        a = 2 / (span + 1)
        weighted = F.when(F.col("_n") == 0, F.col(value)).otherwise(a * F.col(value)) / decay(span, F.col("_at"))
        own[f"_own_{name}"] = F.sum(weighted).over(through) * decay(span, F.col("_at"))
    local = numbered.select("*", *[expr.alias(n) for n, expr in own.items()])

    # End value of the run k back: the own share at its last row, taken RUN*k rows behind it.
    ordered = Window.partitionBy(*blocks.partition).orderBy("_run", "_at")

    def run_end(name: str, back: int) -> Column:
        at_end = F.when(F.col("_at") == RUN - 1, F.col(f"_own_{name}"))
        until = -1 if back == 1 else -1 - RUN * (back - 1)
        seen = F.last(at_end, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, until))
        return F.when(F.col("_run") >= back, seen)

    ends = local.select(
        "*",
        *[run_end(name, back).alias(f"_end{back}_{name}") for name, span in spans.items() for back in range(1, carry_for(span) + 1)],
    )
    averages = []
    for name, span in spans.items():
        total = F.col(f"_own_{name}")
        for back in range(1, carry_for(span) + 1):
            power = F.col("_at") + 1 + RUN * (back - 1)
            total = total + F.coalesce(F.col(f"_end{back}_{name}") * decay(span, power), F.lit(0.0))
        averages.append(total.alias(name))
    made = {name: column for name, column in zip(spans, averages, strict=True)}
    return ends.select(*rows_out, *[made.get(name, F.col(name)) for name in [*plain, *spans]])
