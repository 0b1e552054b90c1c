"""Byte-level BPE encoding with the tiktoken library and a local rank file, and raw-byte decoding.

Long texts are cut before encoding, at places where every match of the pre-splitting pattern ends: between
a character that is not white space and white space. No match crosses such a place, and what follows it is
matched alike without what precedes it, so ids equal those of the uncut text. A single match longer than
``LONG_PIECE`` bytes (one giant run of letters, say) is merged with a heap in n log n steps.

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated rows give repeated results;
an empty table gives an empty table; other columns are left out, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame

from tradeflow.llm.text import map_texts

#: Texts above so many characters are cut, into parts of about this size.
PART_CHARS = 100_000
#: Bytes of one match from which the heap merges it.
LONG_PIECE = 2_000
#: The rank file travels to the executors with the job; larger files are refused.
MAX_RANK_BYTES = 64_000_000

_CUT = re.compile(r"(?<=[^\s])(?=\s)")


def read_ranks(path: str) -> bytes:
    """The bytes of a local rank file, whose size is checked because every executor gets a copy."""
    if os.path.getsize(path) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    with open(path, "rb") as file:
        return file.read()


class Codec:
    """Encoder and decoder over one rank file and one pre-splitting pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.long_run = regex.compile(rf"\p{{L}}{{{LONG_PIECE // 4},}}|\p{{N}}{{{LONG_PIECE // 4},}}|[^\s\p{{L}}\p{{N}}]{{{LONG_PIECE // 4},}}|\s{{{LONG_PIECE // 4},}}")

    def parts(self, text: str) -> list[str]:
        """The text in parts of about ``PART_CHARS`` that are cut at safe places only."""
        out, start = [], 0
        while len(text) - start > PART_CHARS:
            found = _CUT.search(text, start + PART_CHARS)
            if found is None:
                break
            out.append(text[start : found.start()])
            start = found.start()
        out.append(text[start:])
        return out

    def _heap_merge(self, piece: bytes) -> list[int]:
        """Merges of one match, lowest rank first and leftmost among equals, over a linked list of parts."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        right, left, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = bytearray(b"\x01") * n
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n:
                rank = self.ranks.get(piece[i : end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = right[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j] = 0
            end[i], right[i] = stop, right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = right[i]
        return out

    def encode(self, text: str) -> list[int]:
        if len(text) >= LONG_PIECE // 4 and self.long_run.search(text):
            return self._encode_long_runs(text)
        if len(text) <= PART_CHARS:
            return self.encoding.encode_ordinary(text)
        return [i for part in self.parts(text) for i in self.encoding.encode_ordinary(part)]

    def _encode_long_runs(self, text: str) -> list[int]:
        """Match by match, for texts with a giant run, which the library's matcher and merger handle badly."""
        out: list[int] = []
        for found in self.pattern.finditer(text):
            piece = found[0].encode()
            out += self._heap_merge(piece) if len(piece) >= LONG_PIECE else self.encoding.encode_ordinary(found[0]) if piece.strip() else self._heap_merge(piece)
        return out

    def decode(self, ids: list[int]) -> bytes:
        """Raw bytes, whether or not they are whole characters."""
        return self.encoding.decode_bytes(ids)


@lru_cache(maxsize=2)
def codec(rank_file: bytes, pattern: str) -> Codec:
    return Codec(rank_file, pattern)


def _over_texts(docs: DataFrame, rank_path: str, pattern: str, one, schema: str, id_col: str, text_col: str) -> DataFrame:
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    names = [field.split()[0] for field in schema.split(", ")]

    def work(part: pd.DataFrame) -> pd.DataFrame:
        own = codec(ranks.value, pattern)
        rows = [one(own, text) for text in part["text"]]
        return pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), **{n: [r[k] for r in rows] for k, n in enumerate(names)}})

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return map_texts(slim, work, f"doc_id {kind}, {schema}")


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>``: the ids of every whole text, without special tokens."""
    return _over_texts(docs, rank_path, pattern, lambda own, text: (own.encode(text),), "ids array<int>", id_col, text_col)


def decode_ids(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``doc_id, bytes binary`` of ``encode_documents``' rows; null ids decode to no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def run(batches):
        own = codec(ranks.value, pattern)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "bytes": [own.decode([] if x is None else list(x)) for x in batch["ids"]]})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInPandas(run, f"doc_id {kind}, bytes binary")


def encode_and_verify(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip``: ids of every whole text, and whether they decode to its bytes."""

    def one(own: Codec, text: str) -> tuple:
        ids = own.encode(text)
        return (len(ids), np.array(ids, np.int32), own.decode(ids) == text.encode())

    return _over_texts(docs, rank_path, pattern, one, "n_tokens long, ids array<int>, round_trip boolean", id_col, text_col)


def token_digests(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes, round_trip`` of every text, encoded and decoded again."""

    def one(own: Codec, text: str) -> tuple:
        ids = own.encode(text)
        data = own.decode(ids)
        written = ",".join(np.asarray(ids, dtype=np.int32).astype("U6").tolist()) if len(ids) > 50_000 else ",".join(map(str, ids))
        return (len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(data).hexdigest(), len(data), data == text.encode())

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, round_trip boolean"
    return _over_texts(docs, rank_path, pattern, one, schema, id_col, text_col)
