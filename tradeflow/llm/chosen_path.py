"""Near-duplicates by a chosen-path set similarity join over word shingles.

1. Every document becomes its set of shingle hashes, of which only the size, a digest and a minwise signature of
   ``LANES`` lanes leave the first pass. Documents with equal sets share one representative.
2. Each of ``TREES`` independent trees starts by branching all representatives on one lane: those with the same
   minwise token meet in a node. Nodes of one member end. Nodes that are too large to compare (``NODE_ROWS``
   members or ``NODE_SHINGLES`` shingles) branch again on lanes that the node's hash chooses, ``BRANCHES`` of them,
   until they are small. A pair of similarity s shares a root node with probability s, so a tree misses it with
   1 - s and all trees with (1 - s) ** TREES (6e-9 at 0.85).
3. Small nodes are compared exhaustively on signatures; pairs that can still reach the threshold (six standard
   deviations below it) make up candidate groups, which are the same in most trees and are kept once.
4. Full sets of the groups' members are compared exactly. A group is walked from member to member, and members
   already reached aren't compared again, so a dense group costs one comparison a member and yields one link a
   member, never all pairs. Connected components of the links are found by alternating star contraction.

Nodes that stay large after ``MAX_LEVEL`` levels (thousands of nearly equal sets) are cut into blocks and every two
blocks are compared, so nothing is capped or dropped.

Defined cases: null, empty and blank texts have an empty set and link with nothing; texts of fewer words than the
shingle's width are one shingle; rows with a null id are never linked (their component is null and they are
kept); rows that share an id count as one document; extra columns are left out; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.text import WordHashes, mixed, shingle_hashes, slices, words
from tradeflow.session import fresh_path

LANES, TREES, BRANCHES, MAX_LEVEL = 64, 10, 2, 12
#: Members and shingles of a node up to which one task compares it.
NODE_ROWS, NODE_SHINGLES = 4_000, 4_000_000
#: Members of a block of a node that does not get small.
BLOCK_ROWS = 1_500
#: Ids up to which a list of documents is broadcast (8 bytes each) instead of shuffled.
MAX_BROADCAST_IDS = 2_000_000

_HASHES = WordHashes()
_RNG = np.random.default_rng(20240501)
_MULTIPLY = (_RNG.integers(0, 2**32, LANES, dtype=np.uint64) | 1).astype(np.uint32)
_ADD = _RNG.integers(0, 2**32, LANES, dtype=np.uint64).astype(np.uint32)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of the whole text."""
    found = words(text or "")
    return np.unique(shingle_hashes(np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found)), width))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minwise values of a non-empty set, one for each lane."""
    low, high = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(LANES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        part = low[at : at + 2048, None] * _MULTIPLY + (high[at : at + 2048, None] ^ _ADD)
        np.minimum(best, part.min(0), out=best)
    return best


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, digest_a, digest_b, lanes``; empty sets have null lanes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches):
            rows = []
            for text in part["text"]:
                own = shingle_set(text, width)
                if len(own):
                    rows.append((len(own), int(own.sum(dtype=np.uint64).view(np.int64)), int(mixed(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)), signature(own).astype(">u4").tobytes()))
                else:
                    rows.append((0, 0, 0, None))
            out = pd.DataFrame(rows, columns=["n_shingles", "digest_a", "digest_b", "lanes"])
            out.insert(0, "doc_id", part["doc_id"].to_numpy())
            yield out

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInPandas(run, "doc_id long, n_shingles long, digest_a long, digest_b long, lanes binary")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_ids(rows: DataFrame, ids: DataFrame, how: str, name: str = "doc_id", limit: int = MAX_BROADCAST_IDS) -> DataFrame:
    """Semi or anti join with a stored list of distinct ids, broadcast only if it is short enough."""
    short = ids.limit(limit + 1).count() <= limit
    return rows.join(F.broadcast(ids) if short else ids, name, how)


def _lane(number: Column) -> Column:
    return F.substring("lanes", number * 4 + 1, F.lit(4))


def candidate_nodes(members: DataFrame, trees: int, node_rows: int, node_shingles: int, max_level: int = MAX_LEVEL) -> tuple[DataFrame, DataFrame]:
    """``node, rep`` of the nodes that one task can compare, and of those that branching did not make small.

    ``members`` is ``rep, n_shingles, lanes``, stored.
    """
    roots = F.explode(F.array(*[F.xxhash64(F.lit(t), _lane(F.lit(t))) for t in range(trees)]))
    rows = members.select("rep", "n_shingles", roots.alias("node"))
    small, left = None, None
    for level in range(max_level + 1):
        sizes = rows.groupBy("node").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total")).filter("n > 1")
        large = (F.col("n") > node_rows) | (F.col("total") > node_shingles)
        sized = stored(rows.join(sizes.select("node", large.alias("large")), "node"), "cp-nodes")
        ready = sized.filter("NOT large").select("node", "rep")
        small = ready if small is None else small.unionByName(ready)
        left = sized.filter("large").select("node", "rep", "n_shingles")
        if left.isEmpty() or level == max_level:
            break
        chosen = F.explode(F.array(*[F.pmod(F.xxhash64("node", F.lit(k)), F.lit(LANES)).cast("int") for k in range(BRANCHES)]))
        paths = left.select("node", "rep", "n_shingles", chosen.alias("lane")).join(members.select("rep", "lanes"), "rep")
        rows = paths.select("rep", "n_shingles", F.xxhash64("node", "lane", _lane(F.col("lane"))).alias("node"))
    return small, left.select("node", "rep")


def _blocked(left: DataFrame, block_rows: int) -> DataFrame:
    """Nodes that stayed large, as pairs of blocks: every two members meet in at least one of the new nodes."""
    sizes = left.groupBy("node").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    placed = left.join(sizes, "node").withColumn("own", F.pmod(F.xxhash64("rep", "node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = placed.select("node", "rep", "own", other.alias("other"))
    return met.select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "rep")


def _walk(count: int, reach) -> list[np.ndarray]:
    """Components of ``count`` members; ``reach(k, outside)`` tells which members in ``outside`` are linked with k."""
    outside = np.arange(count)
    out = []
    while len(outside):
        frontier, outside = [int(outside[0])], outside[1:]
        group = []
        while frontier:
            k = frontier.pop()
            group.append(k)
            if len(outside):
                hit = reach(k, outside)
                frontier.extend(outside[hit].tolist())
                outside = outside[~hit]
        out.append(np.array(group))
    return out


def _by_key(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[int, pd.DataFrame]]:
    """Whole groups of rows that arrive sorted by ``key``; one group is held at a time."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.iloc[a:b]
            if held and held[0][key].iloc[0] != part[key].iloc[0]:
                yield held[0][key].iloc[0], pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield held[0][key].iloc[0], pd.concat(held) if len(held) > 1 else held[0]


def candidate_groups(nodes: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """``grp, rep``: per node, members joined by pairs whose signatures and sizes allow the threshold; equal groups once."""
    least = threshold - 6 * sqrt(threshold * (1 - threshold) / LANES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups, reps = [], []
        for _, rows in _by_key(batches, "node"):
            ids = rows["rep"].to_numpy(np.int64)
            lanes = np.frombuffer(b"".join(rows["lanes"]), ">u4").reshape(len(ids), LANES).astype(np.uint32)
            size = rows["n_shingles"].to_numpy(float)

            def reach(k, outside, lanes=lanes, size=size):
                alike = (lanes[outside] == lanes[k]).sum(1) >= least * LANES
                return alike & (np.minimum(size[outside], size[k]) >= threshold * np.maximum(size[outside], size[k]) - 1e-9)

            if len(ids) == 2:
                found = [np.array([0, 1])] if reach(0, np.array([1]))[0] else []
            else:
                found = [g for g in _walk(len(ids), reach) if len(g) > 1]
            for g in found:
                own = np.unique(ids[g])
                if len(own) > 1:
                    name = np.uint64(len(own)) + mixed(mixed(own.view(np.uint64)) + np.arange(len(own), dtype=np.uint64)).sum(dtype=np.uint64)
                    groups.append(np.full(len(own), name).view(np.int64))
                    reps.append(own)
            if sum(map(len, reps)) > 100_000:
                yield pd.DataFrame({"grp": np.concatenate(groups), "rep": np.concatenate(reps)})
                groups, reps = [], []
        if reps:
            yield pd.DataFrame({"grp": np.concatenate(groups), "rep": np.concatenate(reps)})

    full = nodes.join(members.select("rep", "n_shingles", "lanes"), "rep")
    dealt = full.repartition("node").sortWithinPartitions("node")
    return dealt.mapInPandas(run, "grp long, rep long").distinct()


def confirmed_links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` with a > b: links that tie each group's confirmed components together, from exact comparisons.

    ``sets`` is ``rep, shingles`` (sorted 64-bit hashes as bytes). A pair is linked if 100 times its intersection is at
    least ``percent`` times its union.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = [], []
        for _, rows in _by_key(batches, "grp"):
            ids = rows["rep"].to_numpy(np.int64)
            own = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
            size = np.array([len(x) for x in own])
            if len(ids) == 2:
                common = len(np.intersect1d(own[0], own[1], assume_unique=True))
                found = [np.array([0, 1])] if 100 * common >= percent * (size[0] + size[1] - common) else []
            else:
                _, spots = np.unique(np.concatenate(own), return_inverse=True)
                ends = np.cumsum(size)
                mark = np.zeros(int(spots.max()) + 1 if len(spots) else 0, np.int32)

                def reach(k, outside, spots=spots, ends=ends, size=size, mark=mark):
                    mine = spots[ends[k] - size[k] : ends[k]]
                    mark[mine] = 1
                    if 4 * len(outside) > len(size):
                        total = np.concatenate([[0], np.cumsum(mark[spots])])
                        common = total[ends[outside]] - total[ends[outside] - size[outside]]
                    else:
                        common = np.array([int(mark[spots[ends[j] - size[j] : ends[j]]].sum()) for j in outside])
                    mark[mine] = 0
                    return 100 * common >= percent * (size[outside] + size[k] - common)

                found = [g for g in _walk(len(ids), reach) if len(g) > 1]
            for g in found:
                low = ids[g].min()
                others = ids[g][ids[g] != low]
                a.append(others)
                b.append(np.full(len(others), low))
            if sum(map(len, a)) > 100_000:
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})
                a, b = [], []
        if a:
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    dealt = groups.join(sets, "rep").repartition("grp").sortWithinPartitions("grp")
    return dealt.mapInPandas(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``rep, root``: the smallest id of each linked id's component, by alternating large-star and small-star steps."""
    edges = stored(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cp-edges")
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        best = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(best, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = stored(small.select("e.a", "e.b").filter("a != b").distinct(), "cp-edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            return edges.groupBy(F.col("a").alias("rep")).agg(F.min("b").alias("root"))
        known = state


def near_duplicates(
    docs: DataFrame, width: int, percent: int, trees: int = TREES, node_rows: int = NODE_ROWS, node_shingles: int = NODE_SHINGLES,
    block_rows: int = BLOCK_ROWS, max_level: int = MAX_LEVEL,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs`` (``doc_id, text``)."""
    own = stored(signatures(docs, width), "cp-signatures")
    some = own.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["n_shingles", "digest_a", "digest_b"]
    members = stored(some.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("lanes").alias("lanes")), "cp-members")
    small, left = candidate_nodes(members, trees, node_rows, node_shingles, max_level)
    if not left.isEmpty():
        small = small.unionByName(_blocked(left, block_rows))
    groups = stored(candidate_groups(small, members, percent / 100), "cp-groups")
    active = stored(groups.select(F.col("rep").alias("doc_id")).distinct(), "cp-active")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches):
            yield pd.DataFrame({"rep": part["doc_id"].to_numpy(), "shingles": [shingle_set(t, width).tobytes() for t in part["text"]]})

    texts = by_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), active, "left_semi")
    links = confirmed_links(groups, texts.mapInPandas(sets, "rep long, shingles binary"), percent)
    roots = components(links)
    classes = members.select(*same, "rep").join(roots, "rep", "left").select(*same, F.coalesce("root", "rep").alias("component_id"))
    joined = some.select("doc_id", *same).join(classes, same).select("doc_id", "n_shingles", "component_id")
    alone = own.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``docs`` with one document of each component (that of the smallest id), and one row of each repeated id.

    Rows with a null id stay.
    """
    found = stored(near_duplicates(docs, width, percent), "cp-classes")
    gone = stored(found.filter("NOT kept").select("doc_id").distinct(), "cp-gone")
    rest = by_ids(docs, gone, "left_anti")
    repeated = stored(found.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "cp-repeated")
    if repeated.isEmpty():
        return rest
    single = by_ids(rest, repeated, "left_semi").dropDuplicates(["doc_id"])
    return by_ids(rest, repeated, "left_anti").unionByName(single)
