"""Helpers that several text operators share: whole-text batches, word and letter tables, stable hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of text that one vectorised step handles at once; more rows wait for the next step.
STEP_CHARS = 4_000_000


def slices(batches: Iterator[pd.DataFrame], text: str = "text", chars: int = STEP_CHARS) -> Iterator[pd.DataFrame]:
    """Batches cut so that each holds at most about ``chars`` characters (a single longer text stays whole).

    A null text becomes the empty text.
    """
    for batch in batches:
        texts = batch[text].where(batch[text].notna(), "")
        batch = batch.assign(**{text: texts})
        step = (texts.str.len().cumsum() // chars).to_numpy()
        ends = np.flatnonzero(np.diff(step)) + 1
        start = 0
        for end in [*ends, len(batch)]:
            if end > start:
                yield batch.iloc[start:end]
            start = end


def map_texts(df: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, text: str = "text") -> DataFrame:
    """``work`` over bounded slices of whole texts; it must return the columns of ``schema``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches, text):
            yield work(part)

    return df.mapInPandas(run, schema)


class WordHashes(dict):
    """Word (bytes) to a stable signed or unsigned 64-bit hash, remembered for at most ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8 with A-Z in lower case; other letters keep their case."""
    return text.encode().lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` word hashes; of the whole sequence if it is shorter; none of no words."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    out = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n - width + 1 + k]
    return mixed(out)


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus
