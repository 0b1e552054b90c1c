"""Hard negatives by exact integer scores: Strassen products of tiles and mergeable heaps.

Anchors and candidates are dealt into blocks by a hash of their ids, so that blocks are even whatever the labels are.
A tile is a block of anchors against a block of candidates: its anchors come first, its candidates follow as a
stream in chunks of growing size, and each chunk is multiplied with the anchors in 64-bit integers by Strassen's
recursion, odd sizes padded with zeros. Two passes make the result:

1. Each anchor's heap of the best rows of its own label (its positives);
2. for each anchor and positive, the heap of the best rows of other labels whose score lies in the positive's window.

Heaps hold a few rows each, a task merges them chunk by chunk, and tiles' heaps are merged by a rank filter, which Spark
also applies before the shuffle. Nothing is sampled or capped: every anchor meets every row once in a pass. A
task holds one block of anchors and one chunk of candidates.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component take no part; vectors of
other lengths count as padded with zeros; an id names one row (``vectors.one_per_id``), and no row is its own positive;
an anchor without positives, or a positive with an empty window (as of a negative score), has no rows; ties go to
the smaller id; extra columns are left out; empty tables give empty tables. Components so large that a score could
leave 64 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.chosen_path import stored
from tradeflow.llm.vectors import finite, one_per_id

#: Anchors and candidates of a tile, about.
ANCHORS, CANDIDATES = 2_048, 8_192
#: Candidates of a tile's first chunk and of its largest ones.
FIRST_CHUNK, CHUNK = 64, 1_024
#: Side up to which a product is made without recursion.
LEAF = 32
_LOWEST = np.iinfo(np.int64).min


def _padded(x: np.ndarray) -> np.ndarray:
    rows, cols = x.shape
    return np.pad(x, ((0, rows % 2), (0, cols % 2))) if rows % 2 or cols % 2 else x


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` of int64 matrices (rows of both are vectors), exact as long as the result fits."""
    rows, cols = len(a), len(b)
    if min(rows, cols, a.shape[1]) <= leaf:
        return a @ b.T
    a, b = _padded(a), _padded(b)
    m, n, k = len(a) // 2, len(b) // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b21, b12, b22 = b[:n, :k], b[:n, k:], b[n:, :k], b[n:, k:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out[:rows, :cols]


class Heaps:
    """The best ``size`` entries of each slot: higher scores first, then smaller ids.

    Entries must be offered by ascending id; ``bar`` is the score that a later entry of a slot has to exceed.
    """

    def __init__(self, slots: int, size: int):
        self.size = size
        self.bar = np.full(slots, _LOWEST)
        self.slot, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = np.concatenate([self.slot, slot]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, ~score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        rank = np.arange(len(slot)) - np.repeat(starts, np.diff(np.append(starts, len(slot))))
        kept = rank < self.size
        last = rank == self.size - 1
        self.bar[slot[last]] = score[last]
        self.slot, self.score, self.id = slot[kept], score[kept], ids[kept]


def _rows_of(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<i8").reshape(len(column), width).astype(np.int64)


def _tiles(batches: Iterator[pd.DataFrame], key: str = "tile") -> Iterator[tuple[pd.DataFrame, Iterator[pd.DataFrame]]]:
    """Each tile's anchors and a stream of its candidates, of rows sorted by tile and side."""

    def pieces() -> Iterator[pd.DataFrame]:
        for batch in batches:
            edges = np.flatnonzero((batch[key].to_numpy()[1:] != batch[key].to_numpy()[:-1]) | (batch["side"].to_numpy()[1:] != batch["side"].to_numpy()[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(batch)], strict=True):
                if b > a:
                    yield batch.iloc[a:b]

    rest = pieces()
    piece = next(rest, None)

    def candidates(tile: int) -> Iterator[pd.DataFrame]:
        nonlocal piece
        while piece is not None and piece[key].iat[0] == tile and piece["side"].iat[0] == 1:
            yield piece
            piece = next(rest, None)

    while piece is not None:
        tile, parts = piece[key].iat[0], []
        while piece is not None and piece[key].iat[0] == tile and piece["side"].iat[0] == 0:
            parts.append(piece)
            piece = next(rest, None)
        stream = candidates(tile)
        if parts:
            yield pd.concat(parts), stream
        for _ in stream:  # what was not asked for
            pass


def _chunks(stream: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The stream's rows in chunks that double up to ``CHUNK``: early bars keep later chunks' entries few."""
    size, held = FIRST_CHUNK, None
    for part in stream:
        held = part if held is None else pd.concat([held, part])
        while len(held) >= size:
            yield held.iloc[:size]
            held, size = held.iloc[size:], min(CHUNK, 2 * size)
    if held is not None and len(held):
        yield held


def _best_of_label(batches: Iterator[pd.DataFrame], width: int, positives: int) -> Iterator[pd.DataFrame]:
    for anchors, stream in _tiles(batches):
        ids, labels, left = anchors["vec_id"].to_numpy(np.int64), anchors["place"].to_numpy(np.int64), _rows_of(anchors["vec"], width)
        heaps = Heaps(len(ids), positives)
        for part in _chunks(stream):
            others = part["vec_id"].to_numpy(np.int64)
            score = strassen(left, _rows_of(part["vec"], width))
            fits = (score > heaps.bar[:, None]) & (labels[:, None] == part["place"].to_numpy(np.int64)) & (ids[:, None] != others)
            row, col = np.nonzero(fits)
            heaps.offer(row, score[row, col], others[col])
        yield pd.DataFrame({"anchor_id": ids[heaps.slot], "positive_id": heaps.id, "positive_score": heaps.score})


def _best_in_windows(batches: Iterator[pd.DataFrame], width: int, low: int, high: int, negatives: int) -> Iterator[pd.DataFrame]:
    for anchors, stream in _tiles(batches):
        labels, left = anchors["place"].to_numpy(np.int64), _rows_of(anchors["vec"], width)
        count = anchors["positives"].map(len).to_numpy()
        start = np.cumsum(count) - count
        flat = [p for own in anchors["positives"] for p in own]
        positive, reached = (np.array([p[name] for p in flat], np.int64) for name in ("positive_id", "positive_score"))
        least, most = -((-low * reached) // 100), (high * reached) // 100
        heaps = Heaps(len(flat), negatives)
        for part in _chunks(stream):
            others = part["vec_id"].to_numpy(np.int64)
            score = strassen(left, _rows_of(part["vec"], width))
            other = labels[:, None] != part["place"].to_numpy(np.int64)
            for k in range(int(count.max(initial=0))):
                own = np.flatnonzero(count > k)
                slot = start[own] + k
                least_now = np.maximum(least[slot], heaps.bar[slot] + 1)
                part_score = score if len(own) == len(score) else score[own]
                fits = (part_score >= least_now[:, None]) & (part_score <= most[slot][:, None]) & (other if len(own) == len(score) else other[own])
                row, col = np.nonzero(fits)
                heaps.offer(slot[row], part_score[row, col], others[col])
        anchor = np.repeat(anchors["vec_id"].to_numpy(np.int64), count)
        yield pd.DataFrame({"anchor_id": anchor[heaps.slot], "positive_id": positive[heaps.slot], "positive_score": reached[heaps.slot], "negative_id": heaps.id, "negative_score": heaps.score})


def _first(rows: DataFrame, keys: list[str], score: str, ids: str, size: int, rank: str) -> DataFrame:
    """Heaps of several tiles merged: the best ``size`` rows of each key."""
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), ids)
    return rows.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= size)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    anchor_rows: int = ANCHORS, candidate_rows: int = CANDIDATES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` is ``vec_id, label, vec`` with integer components. A negative's score is ``low`` to ``high`` percent of
    the positive's.
    """
    slim = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("vec").cast("array<long>").alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    valid = one_per_id(slim.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("vec").cast("array<double>"))))
    width, top = valid.agg(F.max(F.size("vec")), F.max(F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double")))))).first()
    width, top = max(1, width or 0), top or 0.0
    if 100.0 * width * top * top >= 2.0**63:
        raise ArithmeticError(f"scores of {width} components up to {top:g} could leave 64 bits")

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            vec = [np.pad(np.asarray(v, "<i8"), (0, width - len(v))).tobytes() for v in part["vec"]]
            yield part.drop(columns="vec").assign(vec=vec)

    placed = valid.select("vec_id", F.xxhash64(F.col("label").cast("string")).alias("place"), "is_anchor", "vec")
    own = stored(placed.mapInPandas(packed, "vec_id long, place long, is_anchor boolean, vec binary"), "hn-rows")
    total, anchors = own.agg(F.count("*"), F.count_if("is_anchor")).first()
    a_blocks, c_blocks = max(1, -(-anchors // anchor_rows)), max(1, -(-total // candidate_rows))
    block = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n))

    def dealt(left: DataFrame) -> DataFrame:
        """Tiles: every block of anchors with every block of candidates."""
        one = left.withColumn("side", F.lit(0)).withColumn("a", block(a_blocks, 1)).withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long"))))
        other = own.select("vec_id", "place", "vec").withColumn("side", F.lit(1)).withColumn("c", block(c_blocks, 2)).withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(a_blocks - 1).cast("long"))))
        both = one.unionByName(other, allowMissingColumns=True).withColumn("tile", F.col("a") * c_blocks + F.col("c")).drop("a", "c")
        return both.repartition("tile").sortWithinPartitions("tile", "side", "vec_id")

    asked = own.filter("is_anchor").select("vec_id", "place", "vec")
    near = dealt(asked).mapInPandas(lambda b: _best_of_label(b, width, positives), "anchor_id long, positive_id long, positive_score long")
    best = _first(near, ["anchor_id"], "positive_score", "positive_id", positives, "nth")
    windows = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    left = stored(asked.join(windows, "vec_id"), "hn-windows")
    hard = dealt(left).mapInPandas(
        lambda b: _best_in_windows(b, width, low, high, negatives), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    )
    found = _first(hard, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives, "rank")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
