"""Point-in-time lookup: for each left row the latest right row of the same key at or before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.operators.blocks import BLOCK, assign_blocks, fit_blocks, match_keys

_SIDE = "_side"
_MATCH = "_match"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str = "symbol",
    time: str = "timestamp",
    right_columns: Sequence[str] | None = None,
    suffix: str = "_asof",
    tie_break: Sequence[str] = (),
    rows_per_block: int | None = None,
) -> DataFrame:
    """Left rows with the matching right columns (``<name><suffix>``), NULL where none is early enough.

    Both sides are stacked and read once in time order, so there is one shuffle and no range join.
    The right row travels as one struct: a NULL inside it stays NULL instead of falling back to an
    older value. Among right rows of equal time the one last in ``tie_break`` wins. For a key with
    very many rows, each block starts from the last right row of the blocks before it.

    A NULL key or time matches nothing: such right rows are left out, such left rows get NULLs.
    """
    payload = list(right_columns or [c for c in right.columns if c != key])
    match = F.struct(*[F.col(c) for c in payload])
    extra = [c for c in tie_break if c in right.columns]
    match_type = right.select(match.alias(_MATCH)).schema[_MATCH].dataType

    tie = F.struct(F.lit(0).alias("z"), *[F.col(c) for c in extra])
    tie_type = right.select(tie.alias("t")).schema["t"].dataType
    matchable = F.col(key).isNotNull() & F.col(time).isNotNull()
    right_rows = right.filter(matchable).select(
        key,
        F.col(time).alias("_t"),
        F.lit(0).alias(_SIDE),
        F.xxhash64(*right.columns).alias("_spread"),  # lets rows of one instant spread over blocks
        tie.alias("_tie"),
        match.alias(_MATCH),
    )
    left_rows = left.filter(matchable).select(
        key,
        F.col(time).alias("_t"),
        F.lit(1).alias(_SIDE),
        F.xxhash64(*left.columns).alias("_spread"),  # lets left rows of one instant spread over blocks
        F.lit(None).cast(tie_type).alias("_tie"),
        F.lit(None).cast(match_type).alias(_MATCH),
        F.struct(*[F.col(c) for c in left.columns]).alias("_left"),
    )
    stacked = left_rows.unionByName(right_rows, allowMissingColumns=True)
    blocks = fit_blocks(stacked, [key], ["_t", _SIDE, "_spread"], rows_per_block)
    rows = assign_blocks(stacked, blocks) if blocks.cuts is not None else stacked

    if blocks.cuts is not None:
        rows = rows.unionByName(_carried(rows, blocks, key), allowMissingColumns=True)
    trail = Window.partitionBy(*blocks.partition).orderBy("_t", _SIDE, "_tie")
    latest = F.last(F.when(F.col(_SIDE) == 0, F.col(_MATCH)), ignorenulls=True)
    nothing = left.filter(~matchable).select(
        *left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(f"{c}{suffix}") for c in payload]
    )
    found = (
        rows.withColumn(_MATCH, latest.over(trail.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col(_SIDE) == 1)
        .select("_left.*", *[F.col(f"{_MATCH}.{c}").alias(f"{c}{suffix}") for c in payload])
    )
    return found.unionByName(nothing)


def _carried(rows: DataFrame, blocks, key: str) -> DataFrame:
    """For each later block of a large key, the newest right row of all earlier blocks (one row each)."""
    newest = F.max_by(F.struct("_t", "_tie", _MATCH), F.struct("_t", "_tie"))
    per_block = (
        match_keys(rows, blocks.cuts.select(key), [key], "left_semi")
        .withColumn("_t", F.when(F.col(_SIDE) == 0, F.col("_t")))
        .groupBy(key, BLOCK)
        .agg(F.count_if(F.col(_SIDE) == 0).alias("_rights"), newest.alias("_new"))
        .withColumn("_new", F.when(F.col("_rights") > 0, F.col("_new")))
    )
    before = Window.partitionBy(key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_block.withColumn("_old", F.last("_new", ignorenulls=True).over(before))
        .filter(F.col("_old").isNotNull())
        .select(
            key,
            BLOCK,
            F.col("_old._t").alias("_t"),
            F.lit(0).alias(_SIDE),
            F.lit(0).cast("bigint").alias("_spread"),
            F.col("_old._tie").alias("_tie"),
            F.col(f"_old.{_MATCH}").alias(_MATCH),
        )
    )
