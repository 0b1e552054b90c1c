"""Language-model scoring: a causal self-attention model over subword ids, and unigram statistics of the corpus.

Texts are sequences of words (A-Z in lower case), each word encoded with a leading blank by a byte-level BPE, then
one end token. The model predicts the next subword's class by one layer of causal self-attention with a relative
position bias, on top of the current subword's own class preferences; the subword within its class follows its
corpus frequency. Everything is learnt from all training texts: word and subword counts, vocabulary, the classes (from
counts of neighbouring subwords), the symbols' class preferences (from counts of symbol and class) and the attention tables.
Those are fitted by local descent: in each of ``ROUNDS`` rounds every piece of a segment starts from the same tables, goes through its
share of its windows once, and the tables are averaged by the windows they have seen (a step moves the means of its symbols only). After the last round every window of every
training text has been used. A text's score is that of an even mixture of two models of whole texts, the attention model and
the word counts of all training texts: a text that the corpus knows by its words keeps what they say.

Scoring cuts a text's subwords into windows of ``CONTEXT + STRIDE`` that overlap by ``CONTEXT``: a window scores only
its last ``STRIDE`` positions, so every subword is scored once. Many windows go through one masked attention step.

Corpus counts travel by segment. Documents are dealt to segments of about ``SEGMENT_BYTES``; each segment sends its
distinct words' hashes and training counts to the word's vocabulary part, gets the totals of just these words
back, and meets its texts again. No task holds the whole vocabulary, and a word that every document has is one
row for each segment. Texts are encoded once: a segment is stored as pieces of subwords, and learning and scoring read those; a word's hash follows from its subwords.
Sums over pieces are taken in 64-bit integers (the tables' in steps of 2^-24), so they are the same for any partitioning.

Defined cases: null and empty texts are one end token; without training rows all counts are 0 and the attention
tables are neutral; repeated rows and ids are scored one by one; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.bpe import Codec, read_ranks
from tradeflow.session import fresh_path

CONTEXT, STRIDE, WIDTH, CLASSES = 8, 16, 8, 96
#: Subwords with tables of their own; further ones share ``SHARED`` slots by their id.
OWN_SYMBOLS, SHARED = 2_048, 256
#: Frequent subwords whose neighbourhood to a subword tells its class.
NEAR = 256
#: Words of a stored piece of a segment, whose pieces are of like size. A piece goes through its windows once in all rounds, and
#: again where that makes fewer than ``STEPS`` steps; pieces of this size make more.
PIECE_WORDS = 800_000
ROUNDS, STEPS, BATCH, RATE = 3, 400, 96, 0.02
#: Fraction bits of averaged tables, windows of a unit of weight, parts in which sums over pieces meet.
TABLE_BITS, WEIGHT_WINDOWS, SUM_PARTS = 24, 64, 256
#: Text of a segment; at very large inputs it grows with their square root (0.26 GB at 100 TB), so that rows of
#: counts (segments times vocabulary parts) grow no faster than the input.
SEGMENT_BYTES, SEGMENT_GROWTH = 16_000_000, 700
#: Vocabulary parts and shuffle partitions at most; a task reads its segments one after the other.
MAX_PARTS, MAX_PARTITIONS = 20_000, 20_000
#: Windows of one attention step, and subwords of the texts that are scored together.
STEP_WINDOWS, SCORED = 512, 500_000


@lru_cache(maxsize=2)
def _codec(rank_file: bytes, pattern: str) -> Codec:
    return Codec(rank_file, pattern)


#: Bytes of texts whose words are looked for at once.
LOOK_BYTES = 500_000
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def _found(texts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of texts begin, their lengths and 64-bit hashes of their bytes, eight at a time."""
    blank = np.ones(len(texts) + 2, bool)
    blank[1:-1] = _BLANK[np.frombuffer(texts, np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, sizes = edges[::2], np.diff(edges)[::2]
    eight = np.ndarray(len(texts), "<u8", texts + bytes(8), strides=(1,))
    x, left, rest, at = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), slice(None), sizes, 0
    while len(rest):
        part = eight[starts[left] + at] & (_ONES >> (np.uint64(8) * (8 - np.minimum(rest, 8)).astype(np.uint64)))
        part ^= x[left]
        part *= np.uint64(0xBF58476D1CE4E5B9)
        part ^= part >> np.uint64(29)
        part *= np.uint64(0x94D049BB133111EB)
        part ^= part >> np.uint64(32)
        x[left] = part
        left, at = (left[rest > 8] if at else np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD))), at + 8
        rest = sizes[left] - at
    for k in np.flatnonzero(sizes > LONG_WORD):
        x[k] = xxhash.xxh3_64_intdigest(texts[starts[k] : starts[k] + sizes[k]])
    return starts, sizes, x


_ONES = np.uint64(2**64 - 1)


@dataclass
class Words:
    """The words of many texts: word numbers end to end, words of each text, distinct words in number order."""

    numbers: np.ndarray
    lengths: np.ndarray
    distinct: list[bytes]

    @staticmethod
    def of(texts: list[str]) -> Words:
        data = [text.encode().lower() for text in texts]
        ends = np.cumsum([0, *[len(x) + 1 for x in data]])  # a blank parts them
        found, sizes, hashes, low = [], [], [], 0
        while low < len(data):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + LOOK_BYTES, side="right")) - 1)
            starts, size, x = _found(b" ".join(data[low:high]))
            found.append(starts + ends[low])
            sizes.append(size)
            hashes.append(x)
            low = high
        starts, sizes, hashes = (np.concatenate([np.zeros(0, kind), *parts]) for parts, kind in ((found, np.int64), (sizes, np.int64), (hashes, np.uint64)))
        numbers, own = pd.factorize(hashes)
        del hashes, found
        numbers, first = numbers.astype(np.int32), np.empty(len(own), np.int64)
        first[numbers[::-1]] = np.arange(len(numbers))[::-1]
        lengths = np.diff(np.searchsorted(starts, ends))
        text = np.searchsorted(ends, starts[first], side="right") - 1
        begin, size = starts[first] - ends[text], sizes[first]
        distinct = [data[t][b : b + n] for t, b, n in zip(text.tolist(), begin.tolist(), size.tolist(), strict=True)]
        return Words(numbers, lengths, distinct)

    def subwords(self, codec: Codec) -> tuple[np.ndarray, np.ndarray]:
        """Subword ids of the distinct words end to end, and where each word's begin (one more entry at the end).

        Many words are encoded in one call: a match of the pattern never crosses into a blank, and only a word's
        first subword begins with one.
        """
        opens = _opens(codec.encoding)
        ids, firsts, total = [], [], 0
        low = 0
        while low < len(self.distinct):
            high, size = low, 0
            while high < len(self.distinct) and high - low < 20_000 and size < 400_000:
                size += len(self.distinct[high])
                high += 1
            found, at = self._encoded(codec, opens, low, high)
            ids.append(found)
            firsts.append(at + total)
            total += len(found)
            low = high
        return np.concatenate([*ids, np.zeros(0, np.int32)]), np.concatenate([*firsts, [total]]).astype(np.int64)

    def _encoded(self, codec: Codec, opens: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        words = self.distinct[low:high]
        if max(map(len, words)) <= LONG_WORD:
            found = np.array(codec.encoding.encode_ordinary(" " + b" ".join(words).decode()), np.int32)
            at = np.flatnonzero(opens[found])
            if len(at) == len(words):
                return found, at
        parts = [codec.encode(" " + word.decode()) for word in words]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.array([i for p in parts for i in p], np.int32), np.cumsum(sizes) - sizes


@lru_cache(maxsize=2)
def _opens(encoding: tiktoken.Encoding) -> np.ndarray:
    """Which ids' bytes begin with a blank."""
    out = np.zeros(encoding.n_vocab + 1, bool)
    for data in encoding.token_byte_values():
        if data[:1] == b" ":
            out[encoding.encode_single_token(data)] = True
    return out


#: Batches of words with one longer than this are encoded word by word, as ``bpe`` does it, whose merging stays near linear.
LONG_WORD = 1_000


@dataclass
class Model:
    """Tables of the fitted model; ``end`` is the end token's id, also the first input of every text."""

    end: int
    symbol: np.ndarray  # subword id to input symbol
    group: np.ndarray  # subword id to class
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    out: np.ndarray
    own: np.ndarray  # symbol to class preferences
    bias: np.ndarray  # by distance
    within: np.ndarray  # log10 share of a subword in its class

    @property
    def pad(self) -> int:
        return len(self.own) - 1

    def score(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 probability of each text; ``ids`` holds the texts' subwords end to end, each text's end token last."""
        if not len(lengths):
            return np.zeros(0)
        starts, count = np.cumsum(lengths) - lengths, -(-lengths // STRIDE)
        # Texts lie apart by places that weigh nothing, so that each window is a stretch.
        room = CONTEXT + count * STRIDE
        begins = np.cumsum(room) - room
        spot = np.repeat(begins + CONTEXT - starts, lengths) + np.arange(len(ids))
        inputs, target = np.full(room.sum(), self.pad, np.int32), np.zeros(room.sum(), np.int32)
        inputs[spot[1:]] = self.symbol[ids[:-1]]
        inputs[spot[starts]] = self.symbol[self.end]
        target[spot] = self.group[ids]
        window = np.repeat(begins, count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
        places = np.concatenate([self.query, self.key, _ones_after(self.value)], axis=1)
        places[self.pad, 2 * WIDTH :] = 0
        mask, reach, classes = _mask(self.bias), np.arange(CONTEXT + STRIDE), _Classes(self.own, self.out)
        found = np.zeros(len(inputs), np.float32)
        for at in range(0, len(window), STEP_WINDOWS):
            seen = window[at : at + STEP_WINDOWS, None] + reach
            x = inputs[seen]
            now = places.take(x, axis=0)
            weight = now[:, CONTEXT:, :WIDTH] @ np.ascontiguousarray(now[..., WIDTH : 2 * WIDTH].transpose(0, 2, 1))
            weight += mask
            np.exp(weight, out=weight)
            context = weight @ now[..., 2 * WIDTH :]
            context[..., WIDTH:] += np.float32(1e-20)
            scored = seen[:, CONTEXT:].ravel()
            attended = context[..., :WIDTH].reshape(len(scored), WIDTH) / context[..., WIDTH:].reshape(-1, 1)
            found[scored] = classes.log_odds(attended, x[:, CONTEXT:].ravel(), target[scored])
        return np.add.reduceat(self.within[ids] + found[spot] / np.log(10), starts)


#: Rows of class odds that are made at once: they stay in a core's cache, and products of so many the algebra library makes
#: without threads, which would only wait in a task with one core.
ROWS = 320


def _ones_after(value: np.ndarray) -> np.ndarray:
    """Values and a column of ones: weights times this give weighted values and, last, the sum of the weights."""
    out = np.ones((*value.shape[:-1], value.shape[-1] + 1), value.dtype)
    out[..., :-1] = value
    return out


class _Classes:
    """Odds of the classes from symbols' preferences and attended values, some rows at once in the same memory."""

    def __init__(self, own: np.ndarray, out: np.ndarray):
        self.own = own - own.max(1, keepdims=True)
        self.out, self.odds, self.ones = out, np.exp(self.own), np.ones(out.shape[1], out.dtype)
        self.made, self.taken = (np.empty((ROWS, out.shape[1]), out.dtype) for _ in range(2))

    def far(self, attended: np.ndarray) -> bool:
        """Whether a product with these values can leave the range of exponents."""
        return bool(np.abs(attended).max(initial=0) * np.abs(self.out).sum(0).max() > 60)

    def rows(self, attended: np.ndarray, symbol: np.ndarray, far: bool) -> np.ndarray:
        """Odds of the classes, row by row; the memory is used again by the next call."""
        made, taken = self.made[: len(symbol)], self.taken[: len(symbol)]
        np.matmul(attended, self.out, out=made)
        if far:
            np.clip(made, -60, 60, out=made)
        np.exp(made, out=made)
        self.odds.take(symbol, axis=0, out=taken, mode="clip")
        made *= taken
        return made

    def log_odds(self, attended: np.ndarray, symbol: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithm of each row's probability of its target class."""
        hit, whole = (np.empty(len(symbol), self.out.dtype) for _ in range(2))
        cell, far = _cells(target, len(self.ones)), self.far(attended)
        for k in range(0, len(symbol), ROWS):
            own = slice(k, k + ROWS)
            made = self.rows(attended[own], symbol[own], far)
            made.ravel().take(cell[own], out=hit[own], mode="clip")
            np.matmul(made, self.ones, out=whole[own])
        return np.log(hit / whole)


def _cells(column: np.ndarray, width: int) -> np.ndarray:
    """Places of each row's column in blocks of ``ROWS`` rows that lie end to end."""
    return np.resize(np.arange(ROWS) * width, len(column)) + column


def _mask(bias: np.ndarray) -> np.ndarray:
    """Position bias of queries (the last STRIDE places) and keys; far below 0 for keys that come later."""
    distance = (np.arange(STRIDE)[:, None] + CONTEXT) - np.arange(CONTEXT + STRIDE)[None]
    return np.where(distance >= 0, bias[np.maximum(distance, 0)], np.float32(-1e4)).astype(np.float32)


@dataclass
class Symbols:
    """The most frequent subwords with their counts, and every subword's input symbol."""

    end: int
    counts: np.ndarray
    top: np.ndarray
    symbol: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, end: int) -> Symbols:
        top = np.argsort(-counts, kind="stable")[:OWN_SYMBOLS]
        symbol = (OWN_SYMBOLS + np.arange(end + 1) % SHARED).astype(np.int32)
        symbol[top] = np.arange(len(top))
        return Symbols(end, counts, top[counts[top] > 0], symbol)

    @property
    def near(self) -> int:
        return min(NEAR, len(self.top))

    def sources(self, ids: np.ndarray) -> np.ndarray:
        """Input symbols of a run of whole texts."""
        return self.symbol[np.concatenate([[self.end], ids[:-1]])]

    def neighbours(self, ids: np.ndarray) -> np.ndarray:
        """Counts, end to end, of top subwords before each near one and after each near one."""
        n, near = len(self.top), self.near
        a, b = self.sources(ids), self.symbol[ids]
        before, after = (a < n) & (b < near), (b < n) & (a < near)
        pairs = (a[before] * np.int64(near) + b[before], b[after] * np.int64(near) + a[after])
        return np.concatenate([np.bincount(x, minlength=n * near) for x in pairs])

    def preferences(self, ids: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Counts of input symbol and class of the next subword."""
        n = OWN_SYMBOLS + SHARED + 1
        return np.bincount(self.sources(ids) * np.int64(CLASSES) + group[ids], minlength=n * CLASSES)


def _classes(symbols: Symbols, neighbours: np.ndarray, seed: int) -> np.ndarray:
    """Class of every subword: k-means over the neighbours of frequent ones; the others by their id."""
    group = np.arange(symbols.end + 1) % CLASSES
    top = symbols.top
    if len(top) <= CLASSES or not neighbours.any():
        return group.astype(np.int32)
    table = np.concatenate(neighbours.reshape(2, len(top), symbols.near), axis=1).astype(float)
    table = np.sqrt(table / np.maximum(table.sum(1, keepdims=True), 1))
    rng = np.random.default_rng(seed)
    weight = symbols.counts[top] / symbols.counts[top].sum()
    centre = table[rng.choice(len(top), CLASSES, replace=False, p=(weight + 1e-6) / (weight + 1e-6).sum())]
    for _ in range(12):
        label = ((table**2).sum(1)[:, None] - 2 * table @ centre.T + (centre**2).sum(1)).argmin(1)
        for c in range(CLASSES):
            if (label == c).any():
                centre[c] = np.average(table[label == c], axis=0, weights=weight[label == c] + 1e-9)
    group[top] = label
    return group.astype(np.int32)


#: Tables of symbols, and all that descent moves; ``own`` follows the counts of all training texts.
PLACES = ("query", "key", "value")
LEARNT = (*PLACES, "out", "bias")


def _tables(mass: np.ndarray, preferences: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """Tables to start from: the symbols' class preferences, smoothed by the classes' shares, and small random ones."""
    n = OWN_SYMBOLS + SHARED + 1
    rng = np.random.default_rng(seed)
    share, pairs = mass / mass.sum(), preferences.reshape(n, CLASSES)
    p = {
        "query": rng.normal(0, 0.3, (n, WIDTH)), "key": rng.normal(0, 0.3, (n, WIDTH)), "value": rng.normal(0, 0.3, (n, WIDTH)),
        "out": rng.normal(0, 0.1, (WIDTH, CLASSES)), "own": np.log((pairs + 20 * share) / (pairs.sum(1, keepdims=True) + 20)),
        "bias": -0.1 * np.arange(CONTEXT + STRIDE),
    }
    return {k: v.astype(np.float32) for k, v in p.items()}


def _finished(symbols: Symbols, group: np.ndarray, mass: np.ndarray, tables: dict[str, np.ndarray]) -> Model:
    small = dict(tables)
    small["query"] = np.clip(small["query"] / np.float32(np.sqrt(WIDTH)), -5, 5)
    small["key"] = np.clip(small["key"], -5, 5)  # keeps every exponent far from overflow
    within = np.log10((symbols.counts + 0.5) / mass[group]).astype(np.float32)
    return Model(symbols.end, symbols.symbol, group, within=within, **small)


def _mass(counts: np.ndarray, group: np.ndarray) -> np.ndarray:
    return np.bincount(group, weights=counts + 0.5, minlength=CLASSES)


def fit(texts: list[np.ndarray], counts: np.ndarray, end: int, seed: int = 5, steps: int = STEPS) -> Model:
    """Model of a few texts in memory, from their subword ids (each closed by ``end``) and subword counts."""
    ids = np.concatenate(texts) if texts else np.zeros(0, np.int64)
    symbols = Symbols.of(counts, end)
    group = _classes(symbols, symbols.neighbours(ids), seed)
    tables = _tables(mass := _mass(counts, group), symbols.preferences(ids, group), seed)
    for round_ in range(ROUNDS):
        learn(tables, symbols.sources(ids), group[ids], round_, steps, np.random.default_rng([seed, round_]))
    return _finished(symbols, group, mass, tables)


def learn(p: dict[str, np.ndarray], source: np.ndarray, target: np.ndarray, round_: int, steps: int, rng: np.random.Generator) -> int:
    """Descent over a round's share of the windows of a run of texts, every ``ROUNDS``-th one; how many windows that are.

    The windows lie side by side; the last one ends with the run, so every position is in one.
    """
    span, source, target = CONTEXT + STRIDE, source.astype(np.intp), target.astype(np.intp)
    if len(source) <= span:
        return 0
    starts = np.minimum(np.arange(0, len(source), span), len(source) - span)[round_::ROUNDS]
    if not len(starts):
        return 0
    turns = max(1, -(-(-(-steps // ROUNDS) * BATCH) // len(starts)))
    order = np.concatenate([rng.permutation(starts) for _ in range(turns)])
    batches = [order[k : k + BATCH] for k in range(0, len(order), BATCH)]
    whole = np.linspace(round_ / ROUNDS, (round_ + 1) / ROUNDS, len(batches), endpoint=False)
    _steps(p, source, target, span, batches, RATE * np.minimum(1.0, 2 * (1 - whole)), LEARNT)
    return len(starts)


def _descend(p: dict[str, np.ndarray], source: np.ndarray, target: np.ndarray, span: int, rng: np.random.Generator, steps: int) -> None:
    """Descent of all tables on random windows."""
    batches = [rng.integers(0, len(source) - span, BATCH) for _ in range(steps)]
    _steps(p, source, target, span, batches, RATE * np.minimum(1.0, 2 * (1 - np.arange(1, steps + 1) / (steps + 1))), (*LEARNT, "own"))


def _steps(p: dict[str, np.ndarray], source: np.ndarray, target: np.ndarray, span: int, batches: list[np.ndarray], rates: np.ndarray, moved: tuple[str, ...]) -> None:
    """Adam on the cross-entropy of the windows that begin at each batch's places, with gradients through softmax attention.

    Of the symbols' tables a step moves the rows of the batch's symbols, and these rows' means only.
    """
    kind = p["out"].dtype
    moves_own = "own" in moved
    # Queries, keys, values and a column of ones: weights times the last two give weighted values and the weights' sum.
    symbols, rest = {"places": _ones_after(np.concatenate([p[k] for k in PLACES], axis=1))}, {k: p[k] for k in moved if k not in (*PLACES, "own")}
    if moves_own:
        symbols["own"] = p["own"]
    w, places = p["query"].shape[1], symbols["places"]
    means = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in (symbols | rest).items()}
    distance = np.arange(span)[:, None] - np.arange(span)[None]
    later = np.where(distance < 0, -1e4, 0).astype(kind)
    far = np.maximum(distance, 0)
    scale, reach, width = kind.type(1 / np.sqrt(w)), np.arange(span), p["out"].shape[1]
    classes = _Classes(p["own"], p["out"])
    for step, (begin, rate) in enumerate(zip(batches, rates, strict=True), 1):
        at = (begin[:, None] + reach).ravel()
        flat, y = source[at], target[at]
        size = len(flat)
        now = places.take(flat, axis=0).reshape(len(begin), span, 3 * w + 1)
        q, k, v = now[..., :w], now[..., w : 2 * w], now[..., 2 * w :]
        turned = [np.ascontiguousarray(x.transpose(0, 2, 1)) for x in (k, v)]  # products with these are faster
        turned[0] *= scale
        # Weights are not divided by their sums; what is made of them is.
        a = q @ turned[0]
        a += p["bias"][far] + later
        if not (a[:, reach, reach].min() > -60 and a.max() < 60):
            a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        h = a @ v
        whole = h[..., w:].reshape(size, 1)
        h = h[..., :w].reshape(size, w) / whole
        if moves_own:
            classes = _Classes(p["own"], p["out"])
        dh, share, grads = np.empty((size, w), kind), np.empty((size, 1), kind), {"out": np.zeros_like(p["out"])}
        down = np.empty((size, width), kind) if moves_own else None
        cell, extreme, outwards = _cells(y, width), classes.far(h), np.ascontiguousarray(p["out"].T)
        for low in range(0, size, ROWS):
            part = slice(low, low + ROWS)
            d = classes.rows(h[part], flat[part], extreme)
            total = d @ classes.ones
            d.ravel()[cell[part]] -= total
            total *= kind.type(size)
            np.divide(1, total, out=share[part, 0])
            np.matmul(d, outwards, out=dh[part])
            grads["out"] += (h[part] * share[part]).T @ d
            if moves_own:
                np.multiply(d, share[part], out=down[part])
        u = np.empty((size, w + 1), kind)
        np.multiply(dh, share / whole, out=u[:, :w])
        np.negative(np.vecdot(u[:, :w], h), out=u[:, w])
        u = u.reshape(len(begin), span, w + 1)
        da = u @ turned[1]
        da *= a
        grads["bias"] = np.bincount(far.ravel(), weights=da.sum(0).ravel(), minlength=span).astype(kind)
        da *= scale
        back = np.empty_like(now)
        np.matmul(da, k, out=back[..., :w])
        np.matmul(da.transpose(0, 2, 1), q, out=back[..., w : 2 * w])
        np.matmul(a.transpose(0, 2, 1), u, out=back[..., 2 * w :])
        back[..., 3 * w] = 0
        order = np.argsort(flat.astype(np.uint16), kind="stable")  # there are fewer symbols
        sorted_ = flat[order]
        cuts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        touched = sorted_[cuts]
        for name, rows in (("places", back.reshape(size, 3 * w + 1)), *([("own", down)] if moves_own else [])):
            g = np.add.reduceat(rows.take(order, axis=0), cuts, axis=0)
            first, second = (m.take(touched, axis=0) for m in means[name])
            symbols[name][touched] -= _moved(g, first, second, step, rate)
            means[name][0][touched], means[name][1][touched] = first, second
        for name, table in rest.items():
            table -= _moved(grads[name], *means[name], step, rate)
    for j, name in enumerate(PLACES):
        p[name][:] = places[:, j * w : (j + 1) * w]


def _moved(g: np.ndarray, first: np.ndarray, second: np.ndarray, step: int, rate: float) -> np.ndarray:
    """How far a step of Adam goes; the means of gradients and of their squares are brought up to date in place."""
    kind = g.dtype.type
    first *= kind(0.9)
    first += kind(0.1) * g
    second *= kind(0.99)
    g *= g
    g *= kind(0.01)
    second += g
    out = np.sqrt(second * kind(1 / (1 - 0.99**step)))
    out += kind(1e-8)
    np.divide(first, out, out=out)
    out *= kind(rate / (1 - 0.9**step))
    return out


# ---------------------------------------------------------------- over the corpus


def _partitions(segments: int) -> int:
    return min(4 * segments, MAX_PARTITIONS)


def segment_of(segments: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(segments)).cast("int")


def _dealt(docs: DataFrame, segments: int) -> DataFrame:
    """``seg, doc_id, text, train``; texts are not null. Spare partitions keep segments from meeting in one task.

    A segment's texts have one order, in which descent goes through them.
    """
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "train")
    dealt = slim.select(segment_of(segments).alias("seg"), "doc_id", "text", "train").repartition(_partitions(segments), "seg")
    return dealt.sortWithinPartitions("seg", "doc_id", "text", "train")


def _words_of_segment(rows: pd.DataFrame) -> tuple[Words, np.ndarray]:
    """Words of a segment's texts and the training count of each distinct word."""
    own = Words.of(list(rows["text"]))
    weight = np.repeat(rows["train"].to_numpy(bool), own.lengths)
    return own, np.bincount(own.numbers, weights=weight, minlength=len(own.distinct)).astype(np.int64)


@dataclass
class Piece:
    """Texts of a segment that hold about ``PIECE_WORDS`` words: subwords end to end, each text's end token last."""

    ids: np.ndarray
    lengths: np.ndarray
    train: np.ndarray

    @staticmethod
    def of(row, end: int) -> Piece:
        return Piece(np.frombuffer(row.ids, _kind(end)), np.frombuffer(row.lengths, np.int32).astype(np.int64), np.frombuffer(row.train, bool))

    def training(self) -> np.ndarray:
        return self.ids if self.train.all() else self.ids[np.repeat(self.train, self.lengths)]

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Subwords and lengths of whole texts that hold about ``SCORED`` subwords together."""
        ends, low = np.cumsum(self.lengths), 0
        while low < len(ends):
            begin = ends[low] - self.lengths[low]
            high = max(low + 1, int(np.searchsorted(ends, begin + SCORED)))
            yield self.ids[begin : ends[high - 1]], self.lengths[low:high]
            low = high


def _kind(end: int) -> type:
    """The type of stored subwords."""
    return np.uint16 if end < 2**16 else np.int32


def _pieces(own: Words, ids: np.ndarray, starts: np.ndarray, end: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts ``low`` to ``high`` of each piece with their subwords, and how many each text has with its end."""
    sizes, ends = np.diff(starts), np.cumsum(own.lengths)
    count = max(1, round(len(own.numbers) / PIECE_WORDS))
    low = 0
    for k in range(1, count + 1):
        high = len(ends) if k == count else int(np.searchsorted(ends, len(own.numbers) * k // count))
        if high <= low:
            continue
        begin = ends[low] - own.lengths[low]
        numbers = own.numbers[begin : ends[high - 1]]
        long = sizes[numbers]
        flat = np.repeat(starts[numbers] - (np.cumsum(long) - long), long) + np.arange(long.sum())
        text = np.repeat(np.arange(high - low), own.lengths[low:high])
        each = np.bincount(text, weights=long, minlength=high - low).astype(np.int64) + 1
        joined = np.full(int(each.sum()), end, _kind(end))
        body = np.ones(len(joined), bool)
        body[np.cumsum(each) - 1] = False
        joined[body] = ids[flat]
        yield low, high, joined, each
        low = high


#: Random numbers of subwords and of places in a word, for hashes of words.
_MIX = np.random.default_rng(20).integers(0, 2**64, 2**12, np.uint64) | np.uint64(1)


def word_hashes(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of words whose subwords begin at ``starts``; a word and its subwords stand for each other."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    long = place.max() >= len(_MIX) - 1
    x = (ids.astype(np.uint64) + np.uint64(1)) * _MIX[place % len(_MIX) if long else place]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= _MIX[(place + place // len(_MIX) + 1) % len(_MIX)] + (place // len(_MIX)).astype(np.uint64) * np.uint64(2) if long else _MIX[place + 1]
    x = np.add.reduceat(x, starts)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Columns of ``word_counts``.
COUNTS = "kind int, seg int, part int, hashes binary, counts binary, names array<{kind}>, ids binary, lengths binary, train binary"


def word_counts(dealt: DataFrame, parts: int, rank_file, pattern: str) -> DataFrame:
    """Per segment and vocabulary part: ``kind, seg, part, hashes, counts`` as bytes.

    Rows of kind 1 hold the segment's subword ids and counts, those of kind 2 its training rows, those of kind 3 (``part``: their
    order) the texts themselves: ids of documents, and the fields of ``Piece``.
    """

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        own, counts = _words_of_segment(rows)
        codec = _codec(rank_file.value, pattern)
        ids, starts = own.subwords(codec)
        hashes = word_hashes(ids, starts[:-1])
        part = (hashes % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        rest = None, b"", b"", b""
        out = [(0, key[0], int(part[s[0]]), hashes[s].tobytes(), counts[s].tobytes(), *rest) for s in np.split(order, cuts) if len(s)]
        weights = np.repeat(counts, np.diff(starts))
        kept = np.flatnonzero(tally := np.bincount(ids, weights=weights).astype(np.int64)) if len(ids) else np.zeros(0, np.int64)
        if len(kept):
            out.append((1, key[0], -1, kept.astype(np.int64).tobytes(), tally[kept].tobytes(), *rest))
        train = rows["train"].to_numpy(bool)
        out.append((2, key[0], -1, b"", np.array([train.sum()], np.int64).tobytes(), *rest))
        names = [None if x is None or x != x else x for x in rows["doc_id"].tolist()]
        end = codec.encoding.n_vocab
        for number, (low, high, joined, each) in enumerate(_pieces(own, ids, starts, end)):
            texts = joined.tobytes(), each.astype(np.int32).tobytes(), train[low:high].tobytes()
            out.append((3, key[0], number, b"", b"", names[low:high], *texts))
        return pd.DataFrame(out, columns=["kind", "seg", "part", "hashes", "counts", "names", "ids", "lengths", "train"])

    return dealt.groupBy("seg").applyInPandas(run, COUNTS.format(kind=dealt.schema["doc_id"].dataType.simpleString()))


def shared_counts(counts: DataFrame) -> DataFrame:
    """``part, seg, hashes, counts`` with counts of the whole corpus, and rows of ``seg`` -1 with a part's totals."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.frombuffer(x, np.uint64) for x in rows["hashes"]]
        own = np.concatenate([np.frombuffer(x, np.int64) for x in rows["counts"]])
        _, at = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(at, weights=own).astype(np.int64)
        ends = np.cumsum([len(h) for h in hashes])
        out = [(key[0], int(seg), h.tobytes(), total[at[end - len(h) : end]].tobytes()) for seg, h, end in zip(rows["seg"], hashes, ends, strict=True)]
        out.append((key[0], -1, b"", np.array([total.sum(), (total > 0).sum()], np.int64).tobytes()))
        return pd.DataFrame(out, columns=["part", "seg", "hashes", "counts"])

    return counts.filter("kind = 0").groupBy("part").applyInPandas(run, "part int, seg int, hashes binary, counts binary")


def _summed(rows: DataFrame, name: str, seconds: int) -> list[tuple[int, int]]:
    """Sums of pairs packed in bytes, by the first number; at most ``seconds`` rows reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, values in zip(batch["hashes"], batch["counts"], strict=True):
                yield pd.DataFrame({"id": np.frombuffer(keys, np.int64), name: np.frombuffer(values, np.int64)})

    flat = rows.mapInPandas(run, f"id long, {name} long").groupBy("id").agg(F.sum(name).alias(name))
    return [(r["id"], r[name]) for r in flat.limit(seconds).collect()]


def _over_pieces(stored: DataFrame, end: int, size: int, add: Callable[[np.ndarray, Piece, list[int]], None]) -> np.ndarray:
    """Sums of ``size`` integers that ``add`` fills from each piece; they meet in parts, and only the totals reach the driver."""
    cuts = [len(x) for x in np.array_split(np.empty(size, bool), SUM_PARTS)]
    begins = np.concatenate([[0], np.cumsum(cuts)])

    def filled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros(size, np.int64), False
        for batch in batches:
            for row in batch.itertuples(index=False):
                add(total, Piece.of(row, end), [row.seg, row.part])
                seen = True
        if seen:
            yield _packed((k, total[begins[k] : begins[k + 1]]) for k in range(SUM_PARTS))

    def met(key, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(cuts[key[0]], np.int64)
        for cells, sums in zip(rows["cells"], rows["sums"], strict=True):
            total[np.frombuffer(cells, np.int32)] += np.frombuffer(sums, np.int64)
        return _packed([(key[0], total)])

    schema = "part int, cells binary, sums binary"
    read = stored.select("seg", "part", "ids", "lengths", "train")
    out = np.zeros(size, np.int64)
    for r in read.mapInPandas(filled, schema).groupBy("part").applyInPandas(met, schema).collect():  # at most one row a part
        out[begins[r["part"]] + np.frombuffer(bytes(r["cells"]), np.int32)] = np.frombuffer(bytes(r["sums"]), np.int64)
    return out


def _packed(parts: Iterable[tuple[int, np.ndarray]]) -> pd.DataFrame:
    """The cells of each part that aren't 0."""
    rows = [(k, at.astype(np.int32).tobytes(), own[at].tobytes()) for k, own in parts if len(at := np.flatnonzero(own))]
    return pd.DataFrame(rows, columns=["part", "cells", "sums"])


def fit_corpus(stored: DataFrame, counts: np.ndarray, end: int, seed: int = 5, steps: int = STEPS) -> Model:
    """The model of all training texts of the stored pieces, from their subword counts."""
    context, symbols = stored.sparkSession.sparkContext, Symbols.of(counts, end)
    sent = context.broadcast(symbols)

    def neighbours(total: np.ndarray, own: Piece, _) -> None:
        total += sent.value.neighbours(own.training())

    found = _over_pieces(stored, end, 2 * len(symbols.top) * symbols.near, neighbours) if len(symbols.top) > CLASSES else np.zeros(0, np.int64)
    group = _classes(symbols, found, seed)
    groups, n = context.broadcast(group), (OWN_SYMBOLS + SHARED + 1) * CLASSES

    def preferences(total: np.ndarray, own: Piece, _) -> None:
        total += sent.value.preferences(own.training(), groups.value)

    mass = _mass(counts, group)
    tables = _tables(mass, _over_pieces(stored, end, n, preferences), seed)
    for round_ in range(ROUNDS):
        now = context.broadcast(tables)

        def learnt(total: np.ndarray, own: Piece, number: list[int], now=now, round_=round_) -> None:
            p, ids = {k: v.copy() for k, v in now.value.items()}, own.training()
            windows = learn(p, sent.value.sources(ids), groups.value[ids], round_, steps, np.random.default_rng([seed, round_, *number]))
            weight = -(-windows // WEIGHT_WINDOWS)
            flat = np.concatenate([p[k].ravel() for k in LEARNT]).astype(float)
            total[:-1] += np.rint(flat * 2**TABLE_BITS).astype(np.int64) * weight
            total[-1] += weight

        sums = _over_pieces(stored, end, sum(tables[k].size for k in LEARNT) + 1, learnt)
        now.destroy()
        if sums[-1]:
            flat = np.split(sums[:-1] / sums[-1] / 2**TABLE_BITS, np.cumsum([tables[k].size for k in LEARNT])[:-1])
            tables |= {k: x.reshape(tables[k].shape).astype(np.float32) for k, x in zip(LEARNT, flat, strict=True)}
    return _finished(symbols, group, mass, tables)


def score_documents(
    docs: DataFrame, rank_path: str, pattern: str, segment_bytes: int = SEGMENT_BYTES, segment_growth: int = SEGMENT_GROWTH, steps: int = STEPS,
) -> DataFrame:
    """``doc_id, train, n_tokens, n_known, train_tokens, base_score, score, n_subwords`` of ``docs(doc_id, text, train)``.

    ``train`` (never null) marks the rows that counts and model learn from.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(rank_path))
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    segments = max(1, -(-size // max(segment_bytes, int((segment_growth * size) ** 0.5))))

    path = fresh_path(spark, "lm-counts")
    word_counts(_dealt(docs, segments), min(segments, MAX_PARTS), ranks, pattern).write.partitionBy("kind").parquet(path)
    written = spark.read.schema(COUNTS.format(kind=docs.schema["doc_id"].dataType.simpleString())).parquet(path)
    counts, stored = written.filter("kind < 3"), written.filter("kind = 3")
    path = fresh_path(spark, "lm-shared")
    shared_counts(counts).write.parquet(path)
    shared = spark.read.parquet(path)

    end = len(ranks.value.splitlines())
    texts_seen = _summed(counts.filter("kind = 2").select(F.unhex(F.lit("0" * 16)).alias("hashes"), "counts"), "n", 1)
    train_docs = texts_seen[0][1] if texts_seen else 0
    both = _summed(shared.filter("seg = -1").select(F.unhex(F.lit("0" * 16 + "01" + "0" * 14)).alias("hashes"), "counts"), "n", 2)
    found = dict(both)
    total = found.get(0, 0) + train_docs
    distinct = found.get(1, 0) + (train_docs > 0)
    tally = np.zeros(end + 1, np.int64)
    for i, n in _summed(counts.filter("kind = 1"), "n", end + 1):
        tally[i] = n
    tally[end] = train_docs
    model = spark.sparkContext.broadcast(fit_corpus(stored, tally, end, steps=steps))
    rest = float(np.log10(total + distinct + 1))

    def run(key, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        counts, opens = known_counts(known), _opens(_codec(ranks.value, pattern).encoding)
        scored = [_score_rows(row, counts, model.value, opens, train_docs, rest) for row in rows.itertuples(index=False)]
        return pd.concat(scored) if scored else pd.DataFrame(columns=["doc_id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, train boolean, n_tokens long, n_known long, base_score double, score double, n_subwords long"
    texts = stored.select("seg", "names", "ids", "lengths", "train").repartition(_partitions(segments), "seg")
    back = shared.filter("seg >= 0").select("seg", "hashes", "counts").repartition(_partitions(segments), "seg")
    scored = texts.groupBy("seg").cogroup(back.groupBy("seg")).applyInPandas(run, schema)
    return scored.withColumn("train_tokens", F.lit(int(total)).cast("long"))


def known_counts(known: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes of a segment and their counts in the whole corpus."""
    if not len(known):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in known["hashes"]])
    counts = np.concatenate([np.frombuffer(x, np.int64) for x in known["counts"]])
    at = np.argsort(hashes)
    return hashes[at], counts[at]


def _score_rows(row, known, model: Model, opens: np.ndarray, train_docs: int, rest: float) -> pd.DataFrame:
    own = Piece.of(row, model.end)
    size, table, counts = len(own.lengths), *known
    body = own.ids != model.end
    text, ids = np.repeat(np.arange(size), own.lengths)[body], own.ids[body]
    starts = np.flatnonzero(opens[ids])
    hashes, text = word_hashes(ids, starts), text[starts]
    at = np.minimum(np.searchsorted(table, hashes), max(0, len(table) - 1))
    c = np.where(table[at] == hashes, counts[at], 0) if len(table) else np.zeros(len(hashes), np.int64)
    n = np.bincount(text, minlength=size) + 1
    base = np.bincount(text, weights=np.log10(c + 1.0), minlength=size) + np.log10(train_docs + 1.0) - n * rest
    seen = np.bincount(text, weights=c > 0, minlength=size).astype(np.int64) + (train_docs > 0)
    # Half the prior goes to the corpus' word counts, half to the attention model: log10 of the mean of both probabilities.
    attended = np.concatenate([model.score(*part) for part in own.runs()])
    score = np.logaddexp(base * np.log(10), attended * np.log(10)) / np.log(10) - np.log10(2)
    return pd.DataFrame({"doc_id": row.names, "train": own.train, "n_tokens": n, "n_known": seen, "base_score": base, "score": score, "n_subwords": own.lengths - 1})
