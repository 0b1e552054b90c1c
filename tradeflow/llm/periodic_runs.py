"""Periodic runs of words by Baier grouping, and texts without their repetitions.

1. Only stretches in which five-word windows recur at a distance that a run could have are looked at. In a run of
   period q every window recurs within q words, and a run of four periods has at least 3 * q - 4 windows in a row that
   do, so a stretch with a wider gap is cut there; no run is lost.
2. Phase one of Baier's suffix sorter groups the positions of a stretch by their Lyndon prefixes: groups are handled
   from the largest to the smallest; the members of a group leave the list of open positions, and the open
   position before each of them (its parent, the previous smaller suffix) takes the member's prefix into its own.
   Parents that took the same prefixes form a group right above their old one. What a position's prefix has grown to
   when its group's turn comes is its longest Lyndon word. This is done under the order of the words and its reverse.
3. Every run has its Lyndon root among these words under one of the orders (the runs theorem). Roots that stand three
   times in a row are extended to both sides by longest common extensions, found by binary search over prefix hashes
   and confirmed word by word.

The work on a text is near linear and holds one text at a time; texts don't meet, so there is no shuffle.

Defined cases: null, empty and blank texts have no words, no runs and an empty collapsed text; a word is any stretch of
characters other than ASCII white space, case counts; equal ids are separate rows; null ids stay null; extra columns
are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.text import STEP_CHARS, mixed, shingle_hashes

#: Least words of a run and least periods it must hold (steps 1 and 3 rely on four periods or more).
LEAST, TIMES = 6, 4
#: Words of the windows whose recurrence is looked at; a run of ``LEAST`` words has one window at least.
WINDOW = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)

Words = list[bytes]


class WordNumbers(dict):
    """Consecutive numbers of words, forgotten between texts once there are many."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def of(self, words: Words, limit: int = 400_000) -> np.ndarray:
        if len(self) > limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_NUMBERS = WordNumbers()


def stretches(numbers: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint ranges of words that hold every run of ``LEAST`` words and ``TIMES`` periods as a whole."""
    n = len(numbers)
    if n < LEAST:
        return []
    keys = shingle_hashes(numbers, WINDOW)
    order = np.argsort(keys, kind="stable")
    again = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    if not len(again):
        return []
    gap = np.zeros(len(keys), np.int64)
    gap[order[again]] = order[again + 1] - order[again]
    while True:
        on = np.concatenate([[0], gap > 0, [0]]).astype(np.int8)
        turns = np.flatnonzero(np.diff(on))
        starts, ends = turns[::2], turns[1::2]
        if not len(starts):
            return []
        size = np.repeat(ends - starts, ends - starts)
        inside = np.flatnonzero(gap)
        wide = inside[3 * gap[inside] - 4 > size]
        if not len(wide):
            break
        gap[wide] = 0
    ends = np.minimum(n, ends + (ends - starts + 4) // 3 + WINDOW)
    found: list[tuple[int, int]] = []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        if found and a <= found[-1][1]:
            found[-1] = (found[-1][0], max(b, found[-1][1]))
        else:
            found.append((a, b))
    return found


def lyndon_lengths(symbols: list[int], count: int) -> list[int]:
    """Length of the longest Lyndon word at each position; ``symbols`` are ranks from 0 to ``count`` - 1."""
    n = len(symbols)
    group, length = list(symbols), [1] * n
    members: list[list[int]] = [[] for _ in range(count)]
    for i, symbol in enumerate(symbols):
        members[symbol].append(i)
    held = [len(m) for m in members]
    below, above = list(range(-1, count - 1)), list(range(1, count + 1))
    # Open positions as a linked list; the place at n (also reached as -1) stands for both ends.
    left, right = list(range(-1, n)), [*range(1, n + 1), 0]
    now = count - 1
    while now >= 0:
        parents: list[int] = []
        times: list[int] = []
        last, size = -1, 0
        for i in members[now]:
            if group[i] == now:
                before, after = left[i], right[i]
                left[after], right[before] = before, after
                size = length[i]
                if before < 0:
                    continue
                if before == last:
                    times[-1] += 1
                else:
                    parents.append(before)
                    times.append(1)
                    last = before
        members[now] = []
        grown: dict[tuple[int, int], list[int]] = {}
        for parent, often in zip(parents, times, strict=True):
            length[parent] += often * size
            old = group[parent]
            if held[old] > 1:
                grown.setdefault((old, often), []).append(parent)
        # The more often, the higher; each new group comes right above the old one.
        for old, often in sorted(grown, reverse=True) if len(grown) > 1 else grown:
            moved = grown[old, often]
            if len(moved) == held[old]:
                continue
            new = len(members)
            members.append(moved)
            held.append(len(moved))
            held[old] -= len(moved)
            for parent in moved:
                group[parent] = new
            upper = above[old]
            below.append(old)
            above.append(upper)
            above[old] = new
            if upper < len(below):
                below[upper] = new
        now = below[now]
    return length


class _Extensions:
    """Longest common extensions of positions by prefix hashes."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
            self.prefix = np.concatenate([[np.uint64(0)], np.cumsum(mixed(symbols + np.uint64(1)) * self.power[:n])])
        self.n = n

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the words at ``a`` and ``b`` (``a`` < ``b``) are equal over ``size`` words."""
        one, other = self.prefix[a + size] - self.prefix[a], self.prefix[b + size] - self.prefix[b]
        return one * self.power[b - a] == other

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._longest(self.n - b, lambda k: self.equal(a, b, k))

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common words before ``a`` and ``b``."""
        return self._longest(a, lambda k: self.equal(a - k, b - k, k))

    @staticmethod
    def _longest(most: np.ndarray, same: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = same(middle)
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low


def _periodic(symbols: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """The given stretch if it is right, else the widest one of this period around its middle, word by word."""
    if np.array_equal(symbols[start : end - period], symbols[start + period : end]):
        return start, end
    same = np.concatenate([[False], symbols[:-period] == symbols[period:], [False]])
    at = (start + end - period) // 2 + 1
    if not same[at]:
        return at, at
    off = np.flatnonzero(~same)
    place = int(np.searchsorted(off, at))
    return int(off[place - 1]), int(off[place]) - 1 + period


def runs_of(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """``start, length, period`` of every run of at least ``LEAST`` words and ``TIMES`` periods, in order."""
    found: set[tuple[int, int, int]] = set()
    for a, b in stretches(numbers):
        kinds, symbols = np.unique(numbers[a:b], return_inverse=True)
        ranks, n = symbols.tolist(), b - a
        top = len(kinds) - 1
        words = [lyndon_lengths(ranks, top + 1), lyndon_lengths([top - r for r in ranks], top + 1)]
        period = np.concatenate([np.array(w, np.int64) for w in words])
        at = np.tile(np.arange(n), 2)
        fits = at + 3 * period <= n
        at, period = at[fits], period[fits]
        common = _Extensions(symbols.astype(np.uint64))
        cubes = common.equal(at, at + period, 2 * period)
        at, period = at[cubes], period[cubes]
        start = at - common.backward(at, at + period)
        end = at + period + common.forward(at, at + period)
        for s, e, q in set(zip(start.tolist(), end.tolist(), period.tolist(), strict=True)):
            s, e = _periodic(symbols, s, e, q)
            if e - s >= max(LEAST, TIMES * q):
                found.add((a + s, e - s, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def without_repeats(words: Words, runs: list[tuple[int, int, int]]) -> Words:
    """Words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def repeated_tail(words: Words, seed: int) -> Words:
    """For seeds divisible by 10, the words from a place on replaced by repetitions of the first ones there."""
    n = len(words)
    if seed % 10 or not n:
        return words
    g = seed // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])


def find(docs: DataFrame, seed: Column | None = None, edit: Callable[[Words, int], Words] | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every text; ``runs`` has ``start, length, period`` by start and period.

    ``edit`` gets a text's words and its ``seed`` (a long column) and returns the words to look at instead.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (F.lit(0) if seed is None else seed).cast("long").alias("seed"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = defaultdict(list)
            chars = 0
            for doc_id, text, own in zip(*(batch.column(k) for k in range(3)), strict=True):
                words = (text.as_py() or "").encode().split()
                if edit is not None:
                    words = edit(words, own.as_py())
                runs = runs_of(_NUMBERS.of(words)) if len(words) >= LEAST else []
                joined = b" ".join(without_repeats(words, runs)).decode()
                for name, value in zip(_SCHEMA.names, (doc_id.as_py(), len(words), [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], joined), strict=True):
                    out[name].append(value)
                chars += len(joined)
                if chars > STEP_CHARS:
                    yield pa.RecordBatch.from_pydict(out, _SCHEMA)
                    out, chars = defaultdict(list), 0
            if out:
                yield pa.RecordBatch.from_pydict(out, _SCHEMA)

    return slim.mapInArrow(rows, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period; the first of equal ones, null without runs."""
    higher = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    return F.aggregate(runs, F.element_at(runs, F.when(F.size(runs) > 0, 1)), lambda best, r: F.when(higher(r, best), r).otherwise(best))


def digests(found: DataFrame) -> DataFrame:
    """Counts, the strongest run and digests of ``find``'s rows."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("best")[name].alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
