"""Homomorphic multiset fingerprints of documents.

A paragraph (a non-empty line) hashes to a wide vector of two bands, and a document's fingerprint is the sum
of its paragraphs' vectors:

* ``EQUAL`` 32-bit lanes from SHAKE-256 of the paragraph, summed modulo 2**32. Sums of different multisets of
  paragraphs agree by chance only, so equality of fingerprints means equal multisets, in any order.
* ``LIKE`` 16-bit lanes, summed modulo 2**16: a signed count sketch of the paragraph's word shingles. Inner
  products of sums estimate how many shingles two documents share.

Since fingerprints are plain sums, ``combine`` inserts and ``remove`` deletes paragraphs or whole documents
without the rest of the text. ``likeness`` is 1 for equal fingerprints, else the estimated Dice share of common
shingles, cut to 0..1.

Defined cases: a null or empty text, or one of line breaks only, has the zero fingerprint; two such are alike
(1); repeated rows have equal fingerprints; empty tables give empty tables.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.functions.search import with_upper_bound
from tradeflow.llm.text import WordHashes, shingle_hashes, slices

EQUAL, LIKE, SHINGLE = 32, 256, 3
#: Stands for a null id, which sorts last.
NO_ID = -(2**63) + 1
_HASHES = WordHashes()


def _sketch(hashes: np.ndarray) -> np.ndarray:
    sign = 1 - 2 * ((hashes >> np.uint64(32)) & np.uint64(1)).astype(np.int64)
    return np.bincount((hashes % np.uint64(LIKE)).astype(np.int64), weights=sign, minlength=LIKE).astype(np.int64)


def paragraphs(text: str) -> list[bytes]:
    return [p for p in text.encode("utf-8", "surrogatepass").split(b"\n") if p]


def fingerprint(text: str) -> np.ndarray:
    """The document's vector: ``EQUAL`` then ``LIKE`` lanes, as unsigned 32-bit numbers."""
    equal = np.zeros(EQUAL, np.uint32)
    shingles = []
    parts = paragraphs(text)
    for at in range(0, len(parts), 4096):
        block = parts[at : at + 4096]
        lanes = np.frombuffer(b"".join([hashlib.shake_256(p).digest(4 * EQUAL) for p in block]), "<u4").reshape(-1, EQUAL)
        equal += lanes.sum(0, dtype=np.uint32)
    for part in parts:
        found = part.lower().split()
        if found:
            shingles.append(shingle_hashes(np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found)), SHINGLE))
    like = _sketch(np.concatenate(shingles)) if shingles else np.zeros(LIKE, np.int64)
    return np.concatenate([equal, (like & 0xFFFF).astype(np.uint32)])


def combine(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """Fingerprint of both multisets together."""
    total = a.astype(np.int64) + sign * b.astype(np.int64)
    total[:EQUAL] &= 0xFFFFFFFF
    total[EQUAL:] &= 0xFFFF
    return total.astype(np.uint32)


def remove(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of ``a`` without the paragraphs of ``b``."""
    return combine(a, b, -1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if np.array_equal(a, b):
        return 1.0
    x = ((a[EQUAL:].astype(np.int64) + 0x8000) % 0x10000 - 0x8000).astype(float)
    y = ((b[EQUAL:].astype(np.int64) + 0x8000) % 0x10000 - 0x8000).astype(float)
    size = x @ x + y @ y
    return float(np.clip(2 * (x @ y) / size, 0.0, 1.0)) if size else 0.0


def to_text(vector: np.ndarray) -> str:
    return base64.b64encode(vector[:EQUAL].astype("<u4").tobytes() + vector[EQUAL:].astype("<u2").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    data = base64.b64decode(text)
    return np.concatenate([np.frombuffer(data[: 4 * EQUAL], "<u4"), np.frombuffer(data[4 * EQUAL :], "<u2").astype(np.uint32)])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in slices(batches):
            yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "fingerprint": [to_text(fingerprint(t)) for t in part["text"]]})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def next_in_order(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows by descending ``doc_id`` in ordered blocks, each followed by a copy of the row that comes next.

    Returns ``block, place, doc_id, text``; ``place`` is 0 for the block's own rows and 1 for the copy of the
    next block's first row (of the very first row after the last). Texts are shuffled once: cut points come from
    ids alone. Null ids come last; equal ids are ordered by text.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = slim.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 1 / (4 * parts)) if parts > 1 else []
    ends = sorted({-int(c) for c in cuts or []})
    placed = slim.withColumn("block", F.lit(0))
    if ends:
        placed = with_upper_bound(slim.withColumn("ends", F.array(*map(F.lit, ends))), "block", "ends", -F.col("doc_id"), len(ends)).drop("ends")
    heads = placed.groupBy("block").agg(F.max("doc_id").alias("doc_id")).collect()  # one row for each block
    filled = sorted(r["block"] for r in heads)
    if not filled:
        return placed.select("block", F.lit(0).alias("place"), "doc_id", "text")
    before = {b: filled[k - 1] for k, b in enumerate(filled)}  # the first block's head follows the last block
    head_rows = spark.createDataFrame([(r["block"], r["doc_id"], before[r["block"]]) for r in heads], "block int, head long, goes int")
    copies = (
        placed.join(F.broadcast(head_rows), "block").filter(F.col("doc_id") == F.col("head"))
        .groupBy("goes").agg(F.max("doc_id").alias("doc_id"), F.max("text").alias("text"))
        .select(F.col("goes").alias("block"), F.lit(1).alias("place"), "doc_id", "text")
    )
    return placed.select("block", F.lit(0).alias("place"), "doc_id", "text").unionByName(copies)


def edited_pairs(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Each document against its edited text (the last half replaced by the next document's start) and the next document.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. A block is
    read in order and only two texts are held at a time.
    """
    rows = next_in_order(docs, parts)
    kind = docs.schema["doc_id"].dataType.simpleString()
    n = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(n, "block").sortWithinPartitions("block", "place", F.col("doc_id").desc(), F.col("text").desc())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in slices(batches):
            out = []
            for block, place, doc_id, text in zip(part["block"], part["place"], part["doc_id"], part["text"], strict=True):
                own = fingerprint(text)
                if held is not None and held[0] == block:
                    out.append(_pair(held[1], held[2], held[3], text, own))
                held = None if place else (block, doc_id, text, own)
            yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]).astype({"n_chars": "int64", "near_edited": float, "near_next": float})

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInPandas(run, schema).withColumn("doc_id", F.expr(f"CASE WHEN doc_id != {NO_ID} THEN doc_id END").cast(kind))


def _pair(doc_id, text: str, own: np.ndarray, following: str, following_own: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    changed = fingerprint(edited)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return (int(doc_id), len(text), digest, to_text(own), to_text(changed), likeness(own, changed), likeness(own, following_own))
