"""Where two tables differ: a tree of bucket digests over their keys, descended into unequal buckets only.

Every key has a place in a tree of ``LEVELS`` levels with ``FAN`` children a node, by its hash. A leaf's digest is the sum of
its rows' digests, an inner node's the sum of its children's, so one partial aggregation makes the whole tree and row order
and partitioning don't matter. Trees are small and can be stored with the tables. Equal roots end the comparison; else only
children of unequal nodes are looked at, and in the end only rows of unequal leaves are read and compared key by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.session import cut_lineage

LEVELS, FAN = 2, 256
#: Digests are summed in decimals, which don't overflow below 10 ** 18 rows.
_DIGEST = "decimal(38,0)"


def _leaf(keys: Sequence[str], levels: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(FAN**levels))


def _row_digests(columns: Sequence[str]) -> list[Column]:
    """Two independent 64-bit digests of a row; NULLs count, and column order doesn't."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in sorted(columns)]
    return [F.xxhash64(F.lit(seed), *cells).cast(_DIGEST) for seed in (1, 2)]


def digest_tree(df: DataFrame, keys: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """``level, node, rows, a, b`` of all nodes that hold rows; level 0 is the root, a node's parent is ``node div FAN``."""
    a, b = _row_digests(df.columns)
    leaves = df.select(_leaf(keys, levels).alias("node"), a.alias("a"), b.alias("b")).groupBy("node").agg(F.count("*").alias("rows"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    above = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.floor(F.col("node") / FAN ** (levels - k)).alias("node")) for k in range(levels + 1)]))
    placed = leaves.select("rows", "a", "b", above.alias("at"))
    return placed.groupBy(F.col("at.level").alias("level"), F.col("at.node").alias("node")).agg(F.sum("rows").alias("rows"), F.sum("a").alias("a"), F.sum("b").alias("b"))


def unequal_leaves(one: DataFrame, other: DataFrame, levels: int = LEVELS) -> list[int]:
    """Leaves in which two (stored) trees differ, found from the root down."""
    unequal: list[int] = []
    for level in range(levels + 1):
        # At the root all, below it children of unequal nodes: at most FAN ** (level - 1) numbers.
        here = (F.col("level") == level) & (F.lit(True) if level == 0 else F.floor(F.col("node") / FAN).isin(unequal))
        sides = [t.filter(here).select("node", F.struct("rows", "a", "b").alias(name)) for t, name in ((one, "one"), (other, "other"))]
        both = sides[0].join(sides[1], "node", "full").filter(~F.col("one").eqNullSafe(F.col("other")))
        unequal = sorted(r["node"] for r in both.select("node").collect())
        if not unequal:
            break
    return unequal


def locate(one: DataFrame, other: DataFrame, keys: Sequence[str], trees: tuple[DataFrame, DataFrame] | None = None, levels: int = LEVELS) -> DataFrame:
    """``keys, difference`` of every key whose rows differ: ``removed``, ``added`` or ``changed``.

    Rows that share a key are compared as a multiset. ``trees`` may hold the stored trees of both tables.
    """
    if sorted(one.columns) != sorted(other.columns):
        raise ValueError("the tables have different columns")
    keys = list(keys)
    trees = trees or (cut_lineage(digest_tree(one, keys, levels)), cut_lineage(digest_tree(other, keys, levels)))
    leaves = unequal_leaves(*trees, levels)
    numbers = one.sparkSession.createDataFrame([(n,) for n in leaves], "leaf long")  # at most FAN ** LEVELS rows

    def by_key(df: DataFrame, name: str) -> DataFrame:
        a, b = _row_digests(df.columns)
        there = df.withColumn("leaf", _leaf(keys, levels)).join(F.broadcast(numbers), "leaf", "left_semi")
        own = there.groupBy(*keys).agg(F.struct(F.count("*").alias("rows"), F.sum(a).alias("a"), F.sum(b).alias("b")).alias(name))
        return own.select(*[F.col(k).alias(f"{name}_{n}") for n, k in enumerate(keys)], name)

    was, now = by_key(one, "was"), by_key(other, "now")
    same = reduce(lambda x, y: x & y, [F.col(f"was_{n}").eqNullSafe(F.col(f"now_{n}")) for n in range(len(keys))])
    both = was.join(now, same, "full").filter(~F.col("was").eqNullSafe(F.col("now")))
    kind = F.when(F.col("now").isNull(), "removed").when(F.col("was").isNull(), "added").otherwise("changed")
    return both.select(*[F.when(F.col("was").isNull(), F.col(f"now_{n}")).otherwise(F.col(f"was_{n}")).alias(k) for n, k in enumerate(keys)], kind.alias("difference"))
