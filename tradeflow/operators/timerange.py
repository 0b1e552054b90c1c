"""Clock-based features: price deviation over the last hour, trades over the last minute.

A clock frame holds any number of rows, and a sliding range frame would be summed anew for every row. Frames
are therefore differences of running sums: each trade asks for the sums at its own time and at the start of
each frame, and those questions are sorted in among the trades. Time is cut into buckets as long as the longest
frame, so a frame touches two buckets at most, and large buckets are cut into blocks: even one busy second
spreads over several tasks. The work grows with the number of trades for every size and skew; the number of tasks
grows with it, so a task sorts about ``LINES`` lines of the tape however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.operators.blocks import BLOCK, Blocks, assign_blocks, fit_blocks, match_keys, preceding_totals

#: Lines of the sorted tape in a task (a trade has four), and the most in a block.
LINES = 500_000
_KEYS = ["symbol", "_bucket"]
# Trades, trades with a price, and the sums of their prices and squares.
_SUMS = ["n", "m", "x", "xx"]


def time_range_features(
    trades: DataFrame,
    volatility_seconds: int = 3600,
    intensity_seconds: int = 60,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Input columns plus ``volatility_1h`` and ``intensity_1m``; equal times see each other.

    ``trade_id`` must be unique within a symbol. A NULL symbol is a symbol of its own, trades without a time see
    each other, and a NULL price counts as a trade but not in the deviation.
    """
    spans = {"volatility": volatility_seconds * 1_000_000, "intensity": intensity_seconds * 1_000_000}
    return _by_running_sums(trades, spans, max(spans.values()), rows_per_block)


def _bucket(at: Column, length: int) -> Column:
    return F.floor(at / F.lit(length)).cast("bigint")


def _by_running_sums(trades: DataFrame, spans: dict[str, int], length: int, rows_per_block: int | None) -> DataFrame:
    # Prices are taken relative to the symbol's mean, which keeps the squared sums small.
    centre = trades.groupBy(F.col("symbol").alias("_of")).agg(F.avg("price").alias("_centre"))
    rows = trades.join(centre, F.col("symbol").eqNullSafe(F.col("_of"))).withColumn("_at", F.unix_micros("timestamp"))
    x = F.coalesce(F.col("price") - F.col("_centre"), F.lit(0.0))
    row = F.struct(*[F.col(c) for c in trades.columns])
    row_type = trades.select(row.alias("r")).schema["r"].dataType

    def entry(side: int, role: str, at: Column, measured: bool) -> Column:
        """One line of the sorted tape. Sides order equal times: frame starts, trades, frame ends."""
        zero = F.lit(0.0)
        return F.struct(
            _bucket(at, length).alias("_bucket"),
            at.alias("_at"),
            F.lit(side).alias("_side"),
            F.lit(role).alias("_role"),
            F.lit(1 if measured else 0).cast("bigint").alias("n"),
            (F.col("price").isNotNull().cast("bigint") if measured else F.lit(0).cast("bigint")).alias("m"),
            (x if measured else zero).alias("x"),
            (x * x if measured else zero).alias("xx"),
            (row if role == "end" else F.lit(None).cast(row_type)).alias("_row"),  # the trade travels with one line
        )

    at = F.col("_at")
    entries = [entry(1, "trade", at, True), entry(2, "end", at, False)]
    entries += [entry(0, name, at - span, False) for name, span in spans.items()]
    tape = rows.select("symbol", "trade_id", F.inline(F.array(*entries)))

    blocks = fit_blocks(tape, _KEYS, ["_at", "_side", "trade_id"], rows_per_block, most=LINES)
    parts = -(-blocks.rows // LINES)
    placed = assign_blocks(tape, blocks)
    answers = _spread(_running(placed, blocks, parts).filter(F.col("_role") != "trade"), parts, ["symbol", "trade_id"])

    # Back to one row per trade. A frame start in the bucket before counts what follows it there.
    def of(role: str, name: str) -> Column:
        return F.max(F.when(F.col("_role") == role, F.col(name)))

    roles = ["end", *spans]
    per_trade = answers.groupBy("symbol", "trade_id").agg(
        *[of(role, s).alias(f"{role}_{s}") for role in roles for s in _SUMS],
        *[of(role, f"all_{s}").alias(f"{role}_all_{s}") for role in spans for s in _SUMS],
        *[of(role, "_bucket").alias(f"{role}_bucket") for role in roles],
        F.first("_row", ignorenulls=True).alias("_row"),
    )

    def in_frame(span: str, s: str) -> Column:
        same = F.col(f"{span}_bucket").eqNullSafe(F.col("end_bucket"))
        before = F.col(f"{span}_{s}")
        return F.col(f"end_{s}") - before + F.when(same, F.lit(0)).otherwise(F.col(f"{span}_all_{s}"))

    n, sx, sxx = (in_frame("volatility", s) for s in _SUMS[1:])
    variance = F.greatest(sxx - sx * sx / n, F.lit(0.0)) / (n - 1)
    return per_trade.select(
        "_row.*",
        F.when(n > 1, F.sqrt(variance)).otherwise(0.0).alias("volatility_1h"),
        in_frame("intensity", "n").alias("intensity_1m"),
    )


def _spread(df: DataFrame, parts: int, keys: list[str]) -> DataFrame:
    """Rows dealt by ``keys`` over as many tasks as their number asks for; few rows go as the session has it."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys) if parts > usual else df


def _running(placed: DataFrame, blocks: Blocks, parts: int) -> DataFrame:
    """Sums up to each line of its group (``n, x, xx``) and of the whole group (``all_*``)."""
    upto = blocks.window().rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*blocks.partition)
    summed = _spread(placed, parts, blocks.partition).select(
        *[c for c in placed.columns if c not in _SUMS],
        *[F.sum(s).over(upto).alias(s) for s in _SUMS],
        *[F.sum(s).over(whole).alias(f"all_{s}") for s in _SUMS],
    )
    above = preceding_totals(placed, blocks, {f"_above_{s}": F.sum(s) for s in _SUMS}, {f"_group_{s}": F.sum(s) for s in _SUMS})
    if above is None:
        return summed
    joined = match_keys(summed, above, [*_KEYS, BLOCK], "left")  # one row per block of a large group
    kept = [c for c in summed.columns if c not in _SUMS and not c.startswith("all_")]
    return joined.select(
        *kept,
        *[(F.col(s) + F.coalesce(f"_above_{s}", F.lit(0))).alias(s) for s in _SUMS],
        *[F.coalesce(f"_group_{s}", f"all_{s}").alias(f"all_{s}") for s in _SUMS],
    )
