"""Quality classifier: a factorisation machine over hashed words, structure statistics and text metadata.

A document is a sparse vector ``x``: one entry for each distinct hashed word (weighted by its damped share of
the text), and one for the bin that each structure or metadata statistic falls into. The model is
``w0 + w.x + sum_{i<j} <v_i, v_j> x_i x_j``; the pairwise sum costs linear time by
``0.5 * (|sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2)``. It is fitted by AdaGrad on a bounded sample of labelled rows
(``MAX_ROWS`` rows and ``MAX_ENTRIES`` feature entries, those with the smallest hashes of their ids), which only leave the
executors as feature vectors of whole texts.

Defined cases: a null or empty text has statistics only (all in their lowest bins) and gets a score like any
other; rows with a null label are no training rows; without training rows, or with one class only, every score
is the share of label 1 (0.5 without rows). Repeated rows score alike; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.chosen_path import stored
from tradeflow.llm.text import map_texts, slices

#: Hashed word slots, and bins of each statistic.
WORD_SLOTS, BINS = 1 << 15, 16
RANK = 8
#: Bounds of the labelled sample the classifier is fitted on: its rows, and their feature entries together. Rows are whole.
MAX_ROWS, MAX_ENTRIES = 8_000, 3_000_000
#: Small tables are gone through more often, until so many steps are done.
EPOCHS, MIN_STEPS, BATCH, RATE, DECAY = 8, 400, 256, 0.1, 1e-5

#: Upper ends of the bins are quantile-free: evenly spaced on a fixed scale for each statistic.
STATISTICS = ("upper", "digit", "space", "symbol", "pipe", "bang", "distinct", "word_length", "long_words", "top_word", "repeat", "lines", "line_length", "ends", "size", "wide")


class _Slots(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = slot = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_SLOTS
        return slot


_SLOTS = _Slots()
_KIND = np.zeros(256, np.uint8)
_KIND[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)] = 1
_KIND[np.frombuffer(b"0123456789", np.uint8)] = 2
_KIND[np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8)] = 3
_KIND[np.frombuffer(b"#$%&*<>=@^_~`{}[]\\+", np.uint8)] = 4
_KIND[np.frombuffer(b"|", np.uint8)] = 5
_KIND[np.frombuffer(b"!?", np.uint8)] = 6


def describe(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots and values of one text: its distinct words, then one bin slot for each statistic."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(_KIND[data], minlength=7) if len(data) else np.zeros(7, np.int64)
    wide = int((data > 127).sum())
    words = text.split()
    n = len(words)
    slots, counts = np.unique(np.fromiter(map(_SLOTS.__getitem__, map(str.lower, words)), np.int64, n), return_counts=True)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = text.split("\n")
    size = max(1, len(data))
    seen = max(1, n)
    stats = np.array([
        4 * kinds[1] / size, 8 * kinds[2] / size, 2 * kinds[3] / size, 8 * kinds[4] / size, 16 * kinds[5] / size, 16 * kinds[6] / size,
        len(slots) / seen, (lengths.mean() if n else 0) / 16, 4 * (lengths > 15).sum() / seen, 2 * (counts.max() if n else 0) / seen,
        2 * float((slots_repeat(words)) / seen), np.log1p(len(lines)) / 8, np.log1p(size / len(lines)) / 10,
        sum(1 for x in lines if x.rstrip()[-1:] in ".!?") / len(lines), np.log1p(size) / 14, 2 * wide / size,
    ])
    bins = np.minimum((np.clip(stats, 0, 0.9999) * BINS).astype(np.int64), BINS - 1)
    weight = np.sqrt(counts / seen)
    stat_slots = WORD_SLOTS + np.arange(len(STATISTICS)) * BINS + bins
    return np.concatenate([slots, stat_slots]), np.concatenate([weight, np.full(len(STATISTICS), 0.5)])


def slots_repeat(words: list[str]) -> int:
    """Words that equal the word before them."""
    return sum(map(str.__eq__, words, words[1:]))


N_SLOTS = WORD_SLOTS + len(STATISTICS) * BINS


@dataclass
class Machine:
    bias: float
    w: np.ndarray
    v: np.ndarray

    def margins(self, slots: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Raw scores of rows whose entries lie end to end, row k from ``starts[k]``; every row has entries."""
        if not len(starts):
            return np.zeros(0)
        x = values[:, None]
        linear = np.add.reduceat(self.w[slots] * values, starts)
        vx = self.v[slots] * x
        total = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx * vx).sum(1), starts)
        return self.bias + linear + 0.5 * ((total * total).sum(1) - squares)


def pack(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(s) for s, _ in rows]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if rows else np.zeros(0, np.int64)
    empty = np.zeros(0)
    return np.concatenate([s for s, _ in rows] or [empty]).astype(np.int64), np.concatenate([v for _, v in rows] or [empty]), starts


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss; the same rows in the same order give the same machine."""
    rng = np.random.default_rng(seed)
    share = float(y.mean()) if len(y) else 0.5
    machine = Machine(float(np.log(np.clip(share, 1e-3, 0.999) / np.clip(1 - share, 1e-3, 0.999))), np.zeros(N_SLOTS), rng.normal(0, 0.02, (N_SLOTS, RANK)))
    if not len(y) or share in (0.0, 1.0):
        machine.v[:] = 0
        return machine
    gw, gv, gb = np.full(N_SLOTS, 1e-2), np.full((N_SLOTS, RANK), 1e-2), 1e-2
    epochs = max(EPOCHS, -(-MIN_STEPS // -(-len(y) // BATCH)))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            picked = order[at : at + BATCH]
            slots, values, starts = pack([rows[k] for k in picked])
            own = np.repeat(np.arange(len(picked)), np.diff(np.append(starts, len(slots))))
            vx = machine.v[slots] * values[:, None]
            total = np.add.reduceat(vx, starts, axis=0)
            error = _sigmoid(machine.margins(slots, values, starts)) - y[picked]
            step = (error[own] * values) / len(picked)
            touched, inverse = np.unique(slots, return_inverse=True)
            dw = np.bincount(inverse, weights=step, minlength=len(touched)) + DECAY * machine.w[touched]
            pull = step[:, None] * (total[own] - vx)
            dv = np.stack([np.bincount(inverse, weights=pull[:, r], minlength=len(touched)) for r in range(RANK)], 1) + DECAY * machine.v[touched]
            gw[touched] += dw * dw
            gv[touched] += dv * dv
            machine.w[touched] -= RATE * dw / np.sqrt(gw[touched])
            machine.v[touched] -= RATE * dv / np.sqrt(gv[touched])
            db = error.mean()
            gb += db * db
            machine.bias -= RATE * db / np.sqrt(gb)
    return machine


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_entries: int = MAX_ENTRIES) -> Machine:
    """Machine from ``docs(doc_id, text)`` joined with ``labels(doc_id, label)``: whole texts, in the order of their ids' hash
    at most ``max_rows`` rows and ``max_entries`` feature entries (and one row at least)."""
    wanted = labels.select("doc_id", "label").filter("label IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")

    def work(part: pd.DataFrame) -> pd.DataFrame:
        found = [describe(t) for t in part["text"]]
        return pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "label": part["label"].to_numpy(), "slots": [s.tolist() for s, _ in found], "values": [v.astype(np.float32).tolist() for _, v in found]})

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("doc_id", "label")}
    described = stored(map_texts(rows, work, f"doc_id {kinds['doc_id']}, label {kinds['label']}, slots array<int>, values array<float>"), "quality-sample")
    order, size = F.xxhash64("doc_id"), F.size("slots")
    # Distinct sizes in order, of max_rows ids at most (more only where ids repeat): up to where do the entries fit?
    sizes = described.groupBy(order.alias("h")).agg(F.sum(size).alias("n")).orderBy("h").limit(max_rows).collect()
    total = np.cumsum([r["n"] for r in sizes])
    fits = max(1, int(np.searchsorted(total, max_entries, side="right")))
    last = sizes[min(fits, len(sizes)) - 1]["h"] if sizes else 0
    sample = described.filter(order <= last).toPandas()
    sample = sample.assign(_h=[zlib.crc32(f"{a}|{b}".encode()) for a, b in zip(sample["doc_id"], sample["label"], strict=True)])
    sample = sample.sort_values(["_h", "doc_id", "label"], kind="stable")
    vectors = [(np.asarray(s, np.int64), np.asarray(v, float)) for s, v in zip(sample["slots"], sample["values"], strict=True)]
    return fit(vectors, sample["label"].to_numpy(float))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def work(part: pd.DataFrame) -> pd.DataFrame:
        out = np.empty(len(part))
        texts = part["text"].to_numpy()
        for at in range(0, len(texts), 200):
            out[at : at + 200] = _sigmoid(shared.value.margins(*pack([describe(t) for t in texts[at : at + 200]])))
        return pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "score": out})

    return map_texts(docs.select("doc_id", "text"), work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, machine: Machine, threshold: float) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, unchanged and without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices([batch]):
                texts = part["text"].to_numpy()
                good = np.empty(len(part), bool)
                for at in range(0, len(texts), 200):
                    good[at : at + 200] = _sigmoid(shared.value.margins(*pack([describe(t) for t in texts[at : at + 200]]))) >= threshold
                yield batch.loc[part.index[good]]

    return docs.mapInPandas(run, docs.schema)
