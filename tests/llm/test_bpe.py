import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeflow.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
CODEC = bpe.Codec(bpe.read_ranks(PATH), PATTERN)
with open(PATH, "rb") as file:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
PLAIN = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})

pieces = st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", "\t", "\xa0", "é", "漢", "1", "'s", "!", "😀", "-", "abc" * 5]), max_size=80)


@settings(max_examples=150, deadline=None)
@given(pieces)
def test_cut_texts_give_the_same_ids(monkeypatch_parts, parts):
    text = "".join(parts)
    assert CODEC.encode(text) == PLAIN.encode_ordinary(text)
    assert CODEC._encode_long_runs(text) == PLAIN.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode()


@pytest.fixture(scope="module")
def monkeypatch_parts():
    old, bpe.PART_CHARS = bpe.PART_CHARS, 7
    yield
    bpe.PART_CHARS = old


@settings(max_examples=100, deadline=None)
@given(st.text("abcthein", min_size=1, max_size=300))
def test_heap_merges_like_the_library(word):
    assert CODEC._heap_merge(word.encode()) == PLAIN.encode_ordinary(word)


def test_giant_runs_round_trip():
    for text in ("a" * 60_000, " " * 60_000, "!?" * 30_000, "\n" * 20_000 + "x"):
        assert CODEC.decode(CODEC.encode(text)) == text.encode()


def test_ids_may_split_a_character():
    ids = CODEC.encode("漢")
    assert b"".join(CODEC.decode([i]) for i in ids) == "漢".encode()


def test_awkward_rows(docs_of, awkward):
    rows = {r.doc_id: r for r in bpe.token_digests(docs_of(awkward), PATH, PATTERN).collect()}
    assert len(rows) == len(awkward)
    for k, text in enumerate(awkward):
        text = text or ""
        ids = PLAIN.encode_ordinary(text) if len(set(text)) > 1 or len(text) < 100 else CODEC.encode(text)
        assert rows[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[k].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest() and rows[k].round_trip
    assert bpe.token_digests(docs_of([]), PATH, PATTERN).count() == 0


def test_encode_then_decode_tables(docs_of, awkward):
    encoded = bpe.encode_documents(docs_of(awkward), PATH, PATTERN)
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode_ids(encoded, PATH, PATTERN).collect()}
    assert back == {k: (t or "").encode() for k, t in enumerate(awkward)}
