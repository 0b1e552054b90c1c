"""Ordered blocks: how per-key window work stays parallel when one key is huge.

A window partitioned by ``symbol`` runs each symbol in one task. Here a key with more rows than
``rows_per_block`` is cut into consecutive ranges of the window order ("blocks"), so windows can
partition by ``(key, block)``. What a block needs from before its start travels in one of two ways:

* frames that look back a fixed number of rows get those rows copied in (``with_history``);
* running totals get the sum of all earlier blocks (done by the caller on the tiny block table).

The cut points come from a row sample whose size depends on the number of blocks and never on the
number of rows, so every side table here is bounded by ``max_blocks``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions.search import with_upper_bound
from tradeflow.session import cut_lineage

BLOCK = "_block"
HALO = "_halo"

# Most rows of a block, and the fewest worth a block of their own.
ROWS_PER_BLOCK = 4_000_000
LEAST_ROWS = 100_000
MAX_BLOCKS = 20_000
SAMPLES_PER_BLOCK = 64
SAMPLE_SEED = 7


@dataclass(frozen=True)
class Blocks:
    """Cut points per large key; ``cuts`` is None when every key fits in one block."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: DataFrame | None
    most_cuts: int = 0
    rows: int = 0  # of all keys

    @property
    def partition(self) -> list[str]:
        """Columns a window over the blocks partitions by."""
        return [*self.keys, BLOCK] if self.cuts is not None else list(self.keys)

    def window(self):
        return Window.partitionBy(*self.partition).orderBy(*self.order)


def _struct(names: Sequence[str]) -> Column:
    return F.struct(*[F.col(n) for n in names])


def match_keys(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = True) -> DataFrame:
    """Join on ``keys``, where NULL equals NULL, with a side table that is broadcast if ``small`` (a proven bound)."""
    theirs = side.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in side.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return df.join(F.broadcast(theirs) if small else theirs, same, how).drop(*[f"_of_{k}" for k in keys])


def block_rows(total: int, parallelism: int) -> int:
    """Rows of a block so that all tasks get about two, between ``LEAST_ROWS`` and ``ROWS_PER_BLOCK``."""
    return min(ROWS_PER_BLOCK, max(LEAST_ROWS, -(-total // (2 * max(1, parallelism)))))


def fit_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_block: int | None = None,
    max_blocks: int = MAX_BLOCKS,
    most: int = ROWS_PER_BLOCK,
) -> Blocks:
    """Choose cut points from two narrow scans of ``df``: a count per key, then a bounded sample.

    ``order`` should identify a row within its key: rows equal in every order column stay together.
    Without ``rows_per_block``, blocks follow the row count and the session's parallelism, up to ``most``
    rows. A NULL key is a key like any other.
    """
    keys, order = tuple(keys), tuple(order)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = per_key.agg(F.sum("_rows").alias("total"), F.max("_rows").alias("largest")).first()
    total = sizes["total"] or 0
    wanted = rows_per_block or min(most, block_rows(total, df.sparkSession.sparkContext.defaultParallelism))
    target = max(wanted, -(-total // max_blocks))
    if (sizes["largest"] or 0) <= target:
        return Blocks(keys, order, None, rows=total)

    per_block = min(SAMPLES_PER_BLOCK, target)
    # At most total/target <= max_blocks keys are larger than the target, hence the broadcast.
    large = per_key.filter(F.col("_rows") > target).select(*keys)
    # Sampling rows (not key values) keeps the sample bounded even when one value repeats endlessly.
    # The cut points are materialised below, so any sample gives a valid, stable split.
    drawn = df.select(*keys, *order).sample(fraction=min(1.0, per_block / target), seed=SAMPLE_SEED)
    sample = match_keys(drawn, large, keys, "left_semi")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    cuts = (
        sample.select(*keys, _struct(order).alias("_cut"), nth.alias("_nth"))
        .filter(F.col("_nth") % per_block == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set("_cut")).alias("_cuts"))
    )
    cuts = cut_lineage(cuts)
    most_cuts = cuts.agg(F.max(F.size("_cuts"))).first()[0]
    return Blocks(keys, order, cuts, most_cuts, total) if most_cuts else Blocks(keys, order, None, rows=total)


def assign_blocks(df: DataFrame, blocks: Blocks) -> DataFrame:
    """Add the block number: how many cut points of the key are <= the row."""
    if blocks.cuts is None:
        return df.withColumn(BLOCK, F.lit(0))
    # The sample holds about SAMPLES_PER_BLOCK rows per block, so all cut arrays total ~max_blocks entries.
    joined = match_keys(df, blocks.cuts, blocks.keys, "left")
    return with_upper_bound(joined, BLOCK, "_cuts", _struct(blocks.order), blocks.most_cuts).drop("_cuts")


def with_history(df: DataFrame, blocks: Blocks, rows: int) -> DataFrame:
    """Rows with block numbers, plus copies of each block's ``rows`` predecessors (flagged ``_halo``).

    Exact for any block sizes: if a block is shorter than ``rows``, the copies also reach the
    blocks after it. Callers drop the copies once their windows are computed.
    """
    if blocks.cuts is None:
        return df
    keys = list(blocks.keys)
    placed = assign_blocks(df, blocks)

    # Last rows of every block of a large key. The rank filter is applied before the shuffle as
    # well (group limit), so only rows * blocks rows move.
    back = F.row_number().over(
        Window.partitionBy(*keys, BLOCK).orderBy(*[F.col(c).desc() for c in blocks.order])
    )
    tails = cut_lineage(
        match_keys(placed, blocks.cuts.select(*keys), keys, "left_semi")
        .withColumn("_back", back)
        .filter(F.col("_back") <= rows)
    )

    # One row per block: which later blocks its tail can reach, and how many rows lie between.
    along = Window.partitionBy(*keys).orderBy(BLOCK)
    reach = (
        tails.groupBy(*keys, BLOCK)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_end", F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(
            "_later",
            F.collect_list(F.struct(F.col(BLOCK).alias("block"), (F.col("_end") - F.col("_size")).alias("start"))).over(
                along.rowsBetween(1, rows)
            ),
        )
        .select(*keys, BLOCK, "_end", F.filter("_later", lambda b: b["start"] - F.col("_end") < rows).alias("_later"))
    )
    copies = (
        match_keys(tails, reach, [*keys, BLOCK])
        .withColumn(
            "_to",
            F.explode(F.filter("_later", lambda b: b["start"] - F.col("_end") + F.col("_back") <= rows)),
        )
        .withColumn(BLOCK, F.col("_to.block"))
        .select(*placed.columns, F.lit(True).alias(HALO))
    )
    return placed.withColumn(HALO, F.lit(False)).unionByName(copies)


def preceding_totals(
    df: DataFrame, blocks: Blocks, sums: dict[str, Column], group_sums: dict[str, Column] | None = None
) -> DataFrame | None:
    """Per block of a large key, each sum over all earlier blocks (None without large keys).

    ``group_sums`` are taken over all blocks of the key. ``df`` must carry block numbers. Partial
    aggregation leaves one row per block to shuffle.
    """
    if blocks.cuts is None:
        return None
    keys, group_sums = list(blocks.keys), group_sums or {}
    whole = Window.partitionBy(*keys)
    before = whole.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    per_block = (
        match_keys(df, blocks.cuts.select(*keys), keys, "left_semi")
        .groupBy(*keys, BLOCK)
        .agg(*[total.alias(name) for name, total in {**sums, **group_sums}.items()])
    )
    return per_block.select(
        *keys,
        BLOCK,
        *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in sums],
        *[F.sum(name).over(whole).alias(name) for name in group_sums],
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, rows_per_block: int | None = None
) -> DataFrame:
    """Add ``name``: the 1-based position within the key (or within all rows, without keys).

    Large keys are numbered block by block. ``df`` is read several times, so pass a stored table or
    an aggregate that is cheap to compute again.
    """
    keys = list(keys)
    if not keys:
        numbered = row_numbers(df.withColumn("_all", F.lit(0)), ["_all"], order, name, rows_per_block)
        return numbered.drop("_all")
    blocks = fit_blocks(df, keys, order, rows_per_block)
    placed = assign_blocks(df, blocks)
    numbered = placed.withColumn(name, F.row_number().over(blocks.window()).cast("bigint"))
    above = preceding_totals(placed, blocks, {"_above": F.count(F.lit(1))})
    if above is not None:
        numbered = match_keys(numbered, above, [*keys, BLOCK], "left")  # one row per block of a large key
        numbered = numbered.withColumn(name, F.col(name) + F.coalesce("_above", F.lit(0)))
    return numbered.select(*df.columns, name)
