"""Near-duplicate vectors of one label by product quantisation, without losing a link.

1. Equal vectors of a label become one class with a weight.
2. A coarse quantiser (k-means centroids) and residual codebooks are fitted on a bounded sample of the classes. A label
   has as many lists as its class count asks for (``SIZES``); a class stands in the list of its nearest
   centroid as ``SUBSPACES`` one-byte codes of its residual, with the exact length of what the codes leave out.
3. Every class is a query too. It probes sufficiently many lists: all whose cell can hold a vector within the distance r
   that the threshold allows, that is, those where half the difference of the squared distances to the list's
   centroid and to the nearest one, divided by the distance of the two centroids, is at most r.
4. Asymmetric distances come from one lookup table for each query and list. By the triangle inequality a class can only
   be within r if its looked-up distance is at most r plus its own coding error; these are reranked by exact cosine.
   Both rules are bounds, not estimates, so recall is 1 for any data (tested against brute force).

Queries and lists meet in tiles of at most about ``TILE`` rows a side, so a list of any size spreads over tasks. A tile
emits each query's weighted count of links and a spanning forest of its links, never all pairs; components come
from the forests. A pair is seen once from each side, as a vector stands in one list only.

Defined cases: a null label or id and vectors that are null, zero or hold null or non-finite components link with nothing
(``n_links`` 0, a component of their own, null with a null id); vectors of other lengths count as padded with
zeros; an id names one vector (``vectors.one_per_id``); extra columns are left out; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeflow.llm.chosen_path import components, stored
from tradeflow.llm.vectors import finite, one_per_id

#: Numbers of lists that a label may have, and classes of a list it aims at.
SIZES, LIST_ROWS = (1, 4, 16, 64, 256, 1_024), 4_096
SUBSPACES, CODES, ROUNDS = 8, 256, 8
#: Components of all vectors of the fitting sample together (and so its rows: 16,384 of 256 components).
SAMPLE_VALUES = 4_194_304
MAX_SAMPLE = 16_384
#: Rows of a tile's side, and of a step of queries inside a tile.
TILE, STEP = 4_096, 256
#: Large labels up to which their table is broadcast.
MAX_BROADCAST = 500_000
#: Slack for the rounding of table lookups in single precision, and of coordinates in double precision.
SLACK, TINY = 1e-3, 1e-9


@dataclass
class Quantiser:
    """Centroids (list, component) and codebooks (subspace, code, component) for one number of lists."""

    centroids: np.ndarray
    books: np.ndarray

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List of each row and squared distances to all centroids."""
        distance = squared(x, self.centroids)
        return distance.argmin(1), distance

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals and the lengths of what they leave out."""
        parts = residual.reshape(len(residual), SUBSPACES, -1)
        codes = np.stack([squared(parts[:, m], self.books[m]).argmin(1) for m in range(SUBSPACES)], 1).astype(np.uint8)
        rest = parts - self.books[np.arange(SUBSPACES), codes]
        return codes, np.sqrt((rest * rest).sum((1, 2)))

    def tables(self, residual: np.ndarray) -> np.ndarray:
        """Squared distances of each row's parts to all codes: (row, subspace, code)."""
        parts = residual.reshape(len(residual), SUBSPACES, -1)
        return np.stack([squared(parts[:, m], self.books[m]) for m in range(SUBSPACES)], 1).astype(np.float32)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of ``x`` and ``y``."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T), 0)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Up to ``k`` distinct centroids; a centroid that loses all rows stays where it is."""
    at = np.unique(x, axis=0)
    at = at[rng.permutation(len(at))[:k]].copy()
    for _ in range(ROUNDS if len(at) > 1 else 1):
        own = squared(x, at).argmin(1)
        sums, held = np.zeros_like(at), np.bincount(own, minlength=len(at))
        np.add.at(sums, own, x)
        at[held > 0] = sums[held > 0] / held[held > 0, None]
    return np.unique(at, axis=0)


def fit(x: np.ndarray, sizes: list[int], seed: int = 7) -> dict[int, Quantiser]:
    """A quantiser for each number of lists, from unit rows whose width is a multiple of ``SUBSPACES``."""
    rng, out = np.random.default_rng(seed), {}
    for k in sizes:
        centroids = k_means(x, k, rng)
        parts = (x - centroids[squared(x, centroids).argmin(1)]).reshape(len(x), SUBSPACES, -1)
        books = np.zeros((SUBSPACES, CODES, parts.shape[2]))
        for m in range(SUBSPACES):
            found = k_means(parts[:, m], CODES, rng)
            books[m] = found[np.minimum(np.arange(CODES), len(found) - 1)]
        out[k] = Quantiser(centroids, books)
    return out


def units(column: pd.Series, width: int) -> np.ndarray:
    """Rows of length 1 from arrays of numbers (none zero), padded with zeros to ``width``."""
    x = np.zeros((len(column), width))
    size = column.map(len).to_numpy()
    for n in np.unique(size):
        x[size == n, :n] = np.stack(column[size == n].to_numpy())
    x /= np.abs(x).max(1, keepdims=True, initial=1e-300)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def radius(least: float) -> float:
    """Distance of unit vectors whose cosine is ``least``."""
    return sqrt(max(0.0, 2 - 2 * least))


def probes(quantiser: Quantiser, distance: np.ndarray, own: np.ndarray, least: float) -> np.ndarray:
    """Which lists each row must probe so that no vector within the radius is missed."""
    between = np.sqrt(squared(quantiser.centroids, quantiser.centroids))[own]
    return distance - distance[np.arange(len(own)), own][:, None] <= 2 * radius(least) * between + TINY


def _spanning(links: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Connected components of a bipartite link matrix, as rows and columns; those of single members left out."""
    out, left = [], links.any(1)
    while left.any():
        rows = np.zeros(len(links), bool)
        rows[left.argmax()] = True
        fresh, cols = rows.copy(), np.zeros(links.shape[1], bool)
        while fresh.any():
            cols |= links[fresh].any(0)
            fresh = links[:, cols].any(1) & ~rows
            rows |= fresh
        out.append((np.flatnonzero(rows), np.flatnonzero(cols)))
        left &= ~rows
    return out


class _Tile:
    """The stored side of a tile, against which its queries come in steps."""

    def __init__(self, rows: pd.DataFrame, quantiser: Quantiser, width: int, least: float):
        self.quantiser, self.width, self.least = quantiser, width, least
        self.rep, self.weight = rows["rep"].to_numpy(np.int64), rows["weight"].to_numpy(np.int64)
        self.codes = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), SUBSPACES)
        self.error = rows["error"].to_numpy(float)
        self.unit = units(rows["embedding"], width)
        self.centroid = quantiser.centroids[int(rows["list"].iat[0])]

    def links(self, rep: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Exact links of queries to the stored rows."""
        tables = self.quantiser.tables(unit - self.centroid)
        looked_up = np.zeros((len(unit), len(self.rep)), np.float32)
        for m in range(SUBSPACES):
            looked_up += tables[:, m][:, self.codes[:, m]]
        near = np.sqrt(looked_up) <= (radius(self.least) + self.error + SLACK).astype(np.float32)
        near &= rep[:, None] != self.rep
        rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        near[np.ix_(rows, cols)] &= unit[rows] @ self.unit[cols].T >= self.least
        return near

    def judge(self, queries: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """``rep, n`` of the queries with links and ``a, b`` of a spanning forest."""
        for at in range(0, len(queries), STEP):
            part = queries.iloc[at : at + STEP]
            rep = part["rep"].to_numpy(np.int64)
            found = self.links(rep, units(part["embedding"], self.width))
            n = found @ self.weight
            some = np.flatnonzero(n)
            if not len(some):
                continue
            a, b = [], []
            for rows, cols in _spanning(found):
                members = np.unique(np.concatenate([rep[rows], self.rep[cols]]))
                a.append(members[1:])
                b.append(np.full(len(members) - 1, members[0]))
            a, b = np.concatenate(a), np.concatenate(b)
            empty = [None] * max(len(some), len(a))
            yield pd.DataFrame(
                {
                    "rep": pd.array([*rep[some], *empty[len(some) :]], "Int64"),
                    "n": pd.array([*n[some], *empty[len(some) :]], "Int64"),
                    "a": pd.array([*a, *empty[len(a) :]], "Int64"),
                    "b": pd.array([*b, *empty[len(b) :]], "Int64"),
                }
            )


_TILE = ["label", "list", "s", "q"]


def _judged(batches: Iterator[pd.DataFrame], model: dict[int, Quantiser], width: int, least: float) -> Iterator[pd.DataFrame]:
    """Rows sorted by tile and side: the stored side is gathered, queries stream by."""
    now, parts, tile = None, [], None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch[c].to_numpy() for c in [*_TILE, "side"]]
        cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            piece = batch.iloc[a:b]
            key = tuple(piece[c].iat[0] for c in _TILE)
            if key != now:
                now, parts, tile = key, [], None
            if piece["side"].iat[0] == 0:
                parts.append(piece)
                continue
            if tile is None and parts:
                rows = pd.concat(parts)
                tile, parts = _Tile(rows, model[int(rows["lists"].iat[0])], width, least), []
            if tile is not None:
                yield from tile.judge(piece)


def _linked(classes: DataFrame, width: int, least: float, list_rows: int, tile: int) -> DataFrame:
    """``rep, n, a, b``: counts of links and forests of links of all tiles. ``classes`` is stored."""
    spark = classes.sparkSession
    lists = F.lit(SIZES[-1])
    for k in reversed(SIZES[:-1]):
        lists = F.when(F.col("n") <= k * list_rows, k).otherwise(lists)
    large = stored(classes.groupBy("label").agg(F.count("*").alias("n")).filter(F.col("n") > SIZES[0] * list_rows).select("label", lists.alias("lists")), "pq-labels")
    sizes = sorted({SIZES[0], *(r["lists"] for r in large.select("lists").distinct().collect())})  # values of SIZES
    rows = max(1, min(MAX_SAMPLE, SAMPLE_VALUES // width))
    sample = classes.select("rep", "embedding").orderBy(F.xxhash64("rep")).limit(rows).toPandas()
    model = fit(units(sample["embedding"], width), sizes)
    sent = spark.sparkContext.broadcast(model)  # at most 1,365 centroids and 6 x 256 codes of ``width`` components

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, part in batch.groupby("lists"):
                quantiser, x = sent.value[k], units(part["embedding"], width)
                own, distance = quantiser.nearest(x)
                codes, error = quantiser.encode(x - quantiser.centroids[own])
                needed = probes(quantiser, distance, own, least)
                yield part.assign(list=own, code=[c.tobytes() for c in codes], error=error, probed=[np.flatnonzero(p) for p in needed])

    few = large.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    sized = classes.join(F.broadcast(large) if few else large, "label", "left").withColumn("lists", F.coalesce("lists", F.lit(SIZES[0])))
    schema = StructType([*sized.schema, *StructType.fromDDL("list int, code binary, error double, probed array<int>")])
    placed = stored(sized.mapInPandas(assign, schema), "pq-lists")
    stored_n = placed.groupBy("label", "list").agg(F.count("*").alias("stored"))
    asked = placed.select("rep", "label", F.explode("probed").alias("list"))
    cells = stored(asked.groupBy("label", "list").agg(F.count("*").alias("asked")).join(stored_n, ["label", "list"]), "pq-cells")
    cells = cells.select("label", "list", F.ceil(F.col("stored") / tile).cast("int").alias("s_blocks"), F.ceil(F.col("asked") / tile).cast("int").alias("q_blocks"))
    cells = F.broadcast(cells) if cells.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST else cells

    def block(of: str, seed: int) -> Column:
        return F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(of)).cast("int")

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    ours = placed.join(cells, ["label", "list"]).withColumn("s", block("s_blocks", 1)).withColumn("q", every("q_blocks"))
    ours = ours.select(*_TILE, F.lit(0).alias("side"), "rep", "weight", "lists", "code", "error", "embedding")
    theirs = placed.select("rep", "label", "embedding", F.explode("probed").alias("list")).join(cells, ["label", "list"])
    theirs = theirs.withColumn("q", block("q_blocks", 2)).withColumn("s", every("s_blocks")).select(*_TILE, F.lit(1).alias("side"), "rep", "embedding")
    both = ours.unionByName(theirs, allowMissingColumns=True).repartition(*_TILE).sortWithinPartitions(*_TILE, "side")
    return both.mapInPandas(lambda b: _judged(b, sent.value, width, least), "rep long, n long, a long, b long")


def near_duplicates(vectors: DataFrame, least: float = 0.98, list_rows: int = LIST_ROWS, tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of ``vectors`` (``vec_id, label, embedding``)."""
    slim = one_per_id(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding"))
    usable = finite(F.col("embedding")) & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    plain = F.transform("embedding", lambda x: x + F.lit(0).cast("float"))  # no negative zeros
    rows = stored(slim.select("vec_id", "label", F.when(usable, plain).alias("embedding")), "pq-rows")
    # Equal vectors are told by two 64-bit digests; a class's vector is that of any member.
    same = [F.xxhash64(F.lit(seed), "embedding").alias(name) for seed, name in ((1, "digest_a"), (2, "digest_b"))]
    keys = ["label", "digest_a", "digest_b"]
    told = rows.filter(F.col("embedding").isNotNull()).select("vec_id", "label", *same, "embedding")
    classes = stored(told.groupBy(*keys).agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("embedding").alias("embedding")), "pq-classes")
    width = classes.agg(F.max(F.size("embedding"))).first()[0] or 0
    if width == 0:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    width = -(-width // SUBSPACES) * SUBSPACES
    found = stored(_linked(classes.select("label", "rep", "weight", "embedding"), width, least, list_rows, tile), "pq-links")
    counts = found.filter("rep IS NOT NULL").groupBy("rep").agg(F.sum("n").alias("n"))
    roots = components(found.filter("a IS NOT NULL").select("a", "b"))
    judged = classes.select(*keys, "rep", "weight").join(counts, "rep", "left").join(roots, "rep", "left")
    judged = judged.select(*keys, (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    linked = told.select("vec_id", *keys).join(judged, keys).select("vec_id", "n_links", "component_id")
    alone = rows.filter(F.col("embedding").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
