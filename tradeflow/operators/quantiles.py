"""Exact percentiles (linear interpolation) that stay exact when groups are very large.

Small groups use Spark's ``percentile``, whose buffer holds every distinct value of a group. Larger
groups are narrowed first: approximate quantiles split the value range, exact counts per cell show
which cells hold the wanted ranks, and only those cells are looked at again. Each round shrinks the
candidates about ``CELLS``-fold; every round is two map-side aggregations and no sort of the data.

``column_percentiles`` takes many percentiles of many columns at once. Values of a row sample part each column into cells;
all rows are counted per cell, and only the values of cells that hold a wanted rank meet. The sample decides how
many those are, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions.search import with_upper_bound
from tradeflow.session import cut_lineage

DIRECT_LIMIT = 1_000_000
CELLS = 512
#: Edges of a column's cells, sampled rows that place them, groups in which a column's wanted values meet, values a task holds.
EDGES, GUIDES, GROUPS, HELD = 8_192, 65_536, 16, 4_000_000


def exact_percentiles(
    rows: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], direct_limit: int = DIRECT_LIMIT
) -> DataFrame:
    """One row per group: ``n`` non-NULL values and ``percentiles`` in the order of ``probs``.

    A NULL in a group column is a group of its own. Only groups above ``direct_limit`` are narrowed.
    """
    by = list(by)
    # One struct holds the group columns: it is never NULL itself, so joins keep groups with NULLs.
    group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    data = rows.select(group.alias("_g"), F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    sizes = data.groupBy("_g").agg(F.count(F.lit(1)).alias("n"))
    some_large = (sizes.agg(F.max("n")).first()[0] or 0) > direct_limit
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    counted = [F.count(F.lit(1)).alias("n"), F.percentile("_v", wanted).alias("percentiles")]
    if not some_large:
        found = data.groupBy("_g").agg(*counted)
    else:
        large = cut_lineage(sizes.filter(F.col("n") > direct_limit))
        names = F.broadcast(large.select("_g"))  # at most total / direct_limit rows
        ranked = _values_at_ranks(data.join(names, "_g", "left_semi"), ["_g"], large, probs, direct_limit)
        direct = data.join(names, "_g", "left_anti").groupBy("_g").agg(*counted)
        found = direct.unionByName(interpolate(ranked, ["_g"], probs))
    return found.select(*[F.col(f"_g.{c}").alias(c) for c in by], "n", "percentiles")


def position_of(prob: float) -> Column:
    return F.lit(float(prob)) * (F.col("n") - 1)


def wanted_ranks(sizes: DataFrame, by: list[str], probs: Sequence[float]) -> DataFrame:
    """The 1-based ranks below and above each percentile's position."""
    ends = [F.struct((f(position_of(p)) + 1).cast("bigint").alias("rank")) for p in probs for f in (F.floor, F.ceil)]
    return sizes.select(*by, "n", F.inline(F.array(*ends))).distinct()


def _values_at_ranks(
    data: DataFrame, by: list[str], sizes: DataFrame, probs: Sequence[float], direct_limit: int
) -> DataFrame:
    """Value of every wanted rank. ``slot`` names the narrowed range a row lies in."""
    group = [*by, "slot"]
    active = data.withColumn("slot", F.lit(""))
    open_ranks = wanted_ranks(sizes, by, probs).withColumn("slot", F.lit("")).withColumn("before", F.lit(0).cast("bigint"))
    found: list[DataFrame] = []
    while True:
        # Side tables below hold at most groups * ranks slots of CELLS cells: bounded, hence broadcast.
        steps = F.array(*[F.lit(i / CELLS) for i in range(CELLS + 1)])
        edges = cut_lineage(
            active.groupBy(*group).agg(
                F.array_sort(F.array_distinct(F.percentile_approx("_v", steps, 10 * CELLS))).alias("_edges")
            )
        )
        # Odd cells hold exactly one value (an edge); even cells lie strictly between edges.
        found_in = active.join(F.broadcast(edges), group)
        found_in = with_upper_bound(found_in, "_number", "_edges", F.col("_v"), CELLS + 1)
        at_edge = F.get("_edges", F.col("_number") - 1) == F.col("_v")
        cell = 2 * F.col("_number") - F.coalesce(at_edge.cast("int"), F.lit(0))
        celled = found_in.withColumn("cell", cell)
        counts = celled.groupBy(*group, "cell").agg(
            F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
        )
        through = Window.partitionBy(*group).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        hits = cut_lineage(
            open_ranks.join(counts.withColumn("_through", F.sum("_rows").over(through)), group)
            .withColumn("_start", F.col("_through") - F.col("_rows"))
            .filter((F.col("rank") - F.col("before")).between(F.col("_start") + 1, F.col("_through")))
        )
        settled = F.col("_low") == F.col("_high")
        found.append(hits.filter(settled).select(*by, "n", "rank", F.col("_low").alias("x")))
        pending = hits.filter(~settled).select(
            *by,
            "n",
            "rank",
            "slot",
            "cell",
            (F.col("before") + F.col("_start")).alias("before"),
            "_rows",
        )
        left = pending.agg(F.max("_rows").alias("rows")).first()["rows"]
        if left is None:
            break
        deeper = F.concat_ws(".", "slot", "cell")
        wanted = pending.select(*group, "cell").distinct()
        active = (
            celled.join(F.broadcast(wanted), [*group, "cell"], "left_semi").select(*by, deeper.alias("slot"), "_v")
        )
        open_ranks = pending.select(*by, "n", "rank", deeper.alias("slot"), "before")
        if left <= direct_limit:
            inside = Window.partitionBy(*group).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
            values = active.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_rows"))
            values = values.withColumn("_through", F.sum("_rows").over(inside))
            place = F.col("rank") - F.col("before")
            found.append(
                open_ranks.join(values, group)
                .filter(place.between(F.col("_through") - F.col("_rows") + 1, F.col("_through")))
                .select(*by, "n", "rank", F.col("_v").alias("x"))
            )
            break
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def interpolate(ranked: DataFrame, by: list[str], probs: Sequence[float]) -> DataFrame:
    values = ranked.groupBy(*by).agg(
        F.first("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("_at")
    )
    points = []
    for prob in probs:
        position = position_of(prob)
        low = F.col("_at")[(F.floor(position) + 1).cast("bigint")]
        high = F.col("_at")[(F.ceil(position) + 1).cast("bigint")]
        points.append(low + (high - low) * (position - F.floor(position)))
    return values.select(*by, "n", F.array(*points).alias("percentiles"))


def column_percentiles(rows: DataFrame, columns: Sequence[str], probs: Sequence[float], cell_limit: int = DIRECT_LIMIT, edges: int = EDGES) -> list[np.ndarray]:
    """Exact percentiles of each column in the order of ``probs``, without NULL and NaN; an empty array where nothing is left.

    A column with a cell of more than ``cell_limit`` rows is left to ``exact_percentiles``.
    """
    if not columns or not probs:
        return [np.empty(0) for _ in columns]
    names = [f"c{k}" for k in range(len(columns))]
    cast = [F.col(c).cast("double") for c in columns]
    data = rows.select(*[F.when(~F.isnan(c), c).alias(n) for c, n in zip(cast, names, strict=True)])
    guides = data.sample(min(1.0, GUIDES / max(rows.count(), 1)), seed=7)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"k": np.arange(len(names), dtype=np.int32), "xs": [_known(batch[n]).tobytes() for n in names]})

    def placed(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        x = np.sort(np.concatenate([np.frombuffer(b, float) for b in parts["xs"]]))
        own = np.unique(x[np.linspace(0, len(x) - 1, min(edges, len(x))).astype(np.int64)])
        return pd.DataFrame({"k": [int(key[0])], "xs": [own.tobytes()]})

    found = guides.mapInPandas(packed, "k int, xs binary").groupBy("k").applyInPandas(placed, "k int, xs binary").collect()  # one row a column
    cuts = [np.empty(0) for _ in names]
    for r in found:
        cuts[r["k"]] = np.frombuffer(bytes(r["xs"]), float)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [np.zeros(2 * len(own) + 1, np.int64) for own in cuts]
        for batch in batches:
            for k, own in enumerate(cuts):
                x = _known(batch[names[k]])
                total[k] += np.bincount(_cells(own, x), minlength=len(total[k]))
        for k, own in enumerate(total):
            at = np.flatnonzero(own)
            yield pd.DataFrame({"k": np.full(len(at), k, np.int32), "cell": at.astype(np.int32), "n": own[at]})

    cells = data.mapInPandas(counted, "k int, cell int, n long").groupBy("k", "cell").agg(F.sum("n").alias("n")).toPandas()
    low, high, shares, wanted, left = {}, {}, {}, {}, []
    for k, own in cells.sort_values("cell").groupby("k"):
        cell, n = own["cell"].to_numpy(), own["n"].to_numpy()
        through = np.cumsum(n)
        position = np.array(probs, float) * (through[-1] - 1)
        shares[k] = position - np.floor(position)
        for side, ranks in ((low, np.floor(position).astype(np.int64)), (high, np.ceil(position).astype(np.int64))):
            at = np.searchsorted(through, ranks, side="right")
            side[k] = np.stack([cell[at], ranks - (through - n)[at]], 1)
        both = np.concatenate([low[k], high[k]])
        if n[np.isin(cell, both[both[:, 0] % 2 == 0, 0])].max(initial=0) > cell_limit:
            left.append(k)
        else:
            wanted[k] = np.unique(both[both[:, 0] % 2 == 0], axis=0)
    found = _gathered(data, names, cuts, {k: w for k, w in wanted.items() if len(w)})
    out = [np.empty(0) for _ in columns]
    for k in wanted:
        a, b = (np.array([cuts[k][c // 2] if c % 2 else found[k, c, r] for c, r in side[k].tolist()]) for side in (low, high))
        with np.errstate(invalid="ignore"):  # infinite neighbours
            out[k] = np.where(a == b, a, a + (b - a) * shares[k])
    for k in left:
        out[k] = np.array(exact_percentiles(data, [], names[k], probs).first()["percentiles"], float)
    return out


def _known(column: pd.Series) -> np.ndarray:
    x = column.to_numpy(float, na_value=np.nan)
    return x[~np.isnan(x)]


def _cells(edges: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Odd cells hold one value, an edge; even cells lie strictly between edges."""
    at = np.searchsorted(edges, x, side="left")
    return 2 * at + (edges[np.minimum(at, len(edges) - 1)] == x) if len(edges) else np.zeros(len(x), np.int64)


def _gathered(data: DataFrame, names: list[str], cuts: list[np.ndarray], wanted: dict[int, np.ndarray]) -> dict[tuple[int, int, int], float]:
    """Values at the wanted (cell, rank within the cell) of each column, from these cells' values alone."""
    if not wanted:
        return {}
    flags = {k: np.isin(np.arange(2 * len(cuts[k]) + 1), w[:, 0]) for k, w in wanted.items()}

    def picked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = {k: [] for k in flags}, 0

        def packed():
            for k, parts in held.items():
                cell, x = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0))
                group = cell // 2 % GROUPS
                for g in np.unique(group):
                    own = group == g
                    yield pd.DataFrame({"k": [k], "g": [int(g)], "cells": [cell[own].astype(np.int32).tobytes()], "xs": [x[own].tobytes()]})

        for batch in batches:
            for k, flag in flags.items():
                x = _known(batch[names[k]])
                cell = _cells(cuts[k], x)
                own = flag[cell]
                held[k].append((cell[own], x[own]))
                size += int(own.sum())
            if size > HELD:
                yield from packed()
                held, size = {k: [] for k in flags}, 0
        yield from packed()

    def ranked(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        k = int(key[0])
        cell = np.concatenate([np.frombuffer(b, np.int32) for b in rows["cells"]])
        x = np.concatenate([np.frombuffer(b, float) for b in rows["xs"]])
        order = np.lexsort((x, cell))
        cell, x = cell[order], x[order]
        own = wanted[k][np.isin(wanted[k][:, 0], cell)]
        return pd.DataFrame({"k": np.full(len(own), k, np.int32), "cell": own[:, 0].astype(np.int32), "rank": own[:, 1], "x": x[np.searchsorted(cell, own[:, 0]) + own[:, 1]]})

    values = data.select(*[names[k] for k in wanted]).mapInPandas(picked, "k int, g int, cells binary, xs binary")
    at = values.groupBy("k", "g").applyInPandas(ranked, "k int, cell int, rank long, x double").collect()  # at most two a column and percentile
    return {(r["k"], r["cell"], r["rank"]): r["x"] for r in at}
