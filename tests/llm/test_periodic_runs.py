"""Periodic runs against brute force, and the defined cases."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tradeflow.llm import periodic_runs


def longest_lyndon(symbols):
    out = []
    for i in range(len(symbols)):
        j = i + 1
        while j < len(symbols) and symbols[j:] > symbols[i:]:
            j += 1
        out.append(j - i)
    return out


def brute_runs(words):
    """Every stretch of equal neighbours at each distance whose own smallest period that distance is."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            own = words[i : j + q]
            smaller = any(own[d:] == own[:-d] for d in range(1, q))
            if len(own) >= max(6, 4 * q) and j > i and not smaller:
                out.append((i, len(own), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    kinds = rng.choice([1, 2, 3, 6, 40])
    words = [rng.randrange(kinds) for _ in range(rng.randint(0, 70))]
    if words and rng.random() < 0.6:
        a, p = rng.randrange(len(words)), rng.randint(1, max(1, len(words) // 5))
        words = words[:a] + [words[min(len(words) - 1, a + (i - a) % p)] for i in range(a, len(words))]
    return words + [99] * rng.randint(0, 1) + words[: rng.randint(0, 8)]


def test_lyndon_words_under_both_orders():
    rng = random.Random(3)
    for _ in range(300):
        words = some_words(rng)
        assert periodic_runs.lyndon_lengths(words, 100) == longest_lyndon(words)
        turned = [99 - w for w in words]
        assert periodic_runs.lyndon_lengths(turned, 100) == longest_lyndon(turned)


def test_runs_like_brute_force():
    rng, seen = random.Random(5), 0
    for _ in range(1500):
        words = some_words(rng)
        runs = periodic_runs.runs_of(np.array(words, np.uint64))
        assert runs == brute_runs(words)
        seen += len(runs)
    assert seen > 500


def test_a_wrong_extension_is_mended_word_by_word():
    symbols = np.array([7, 1, 2, 1, 2, 1, 2, 1, 2, 8, 1, 2], np.int64)
    assert periodic_runs._periodic(symbols, 0, 12, 2) == (1, 9)
    assert periodic_runs._periodic(symbols, 1, 9, 2) == (1, 9)


def test_long_repetitions_take_near_linear_work():
    rng = random.Random(1)
    period = [rng.randrange(3_000) for _ in range(20_000)]
    assert periodic_runs.runs_of(np.array(period * 5, np.uint64)) == [(0, 100_000, 20_000)]
    assert periodic_runs.runs_of(np.zeros(100_000, np.uint64)) == [(0, 100_000, 1)]


def expected(doc_id, text):
    words = (text or "").encode().split()
    seed = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n = len(words)
    if seed % 10 == 0 and n:
        g = seed // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_like_brute_force(spark, docs_of, awkward, tmp_path):
    from tradeflow.llm.queries import QUERIES

    rng = random.Random(9)
    texts = [*awkward[:6], "\u00e9 \u6f22 " * 9, "A a " * 4, "a b\u00a0c a\tb\u00a0c\n" * 5, *(" ".join(f"w{w}" for w in some_words(rng)) for _ in range(150))]
    ids = [None, 7, 7, *range(8, len(texts) + 5)]
    df = docs_of(texts, ids[: len(texts)])
    df.withColumnRenamed("source", "runs").write.parquet(str(tmp_path / "documents.parquet"))
    found = sorted(map(tuple, QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    assert found == sorted((expected(i, t) for i, t in zip(ids, texts, strict=False)), key=str)


def test_texts_without_repetitions(spark, docs_of):
    text = "one " * 7 + "x y z " * 5 + "end"
    row = periodic_runs.find(docs_of([text, None, " \n "])).orderBy("n_words").collect()
    assert [r.collapsed for r in row] == ["", "", "one x y z end"]
    assert [tuple(r) for r in row[2].runs] == [(0, 7, 1), (7, 15, 3)]


def test_empty_table(spark, docs_of):
    found = periodic_runs.digests(periodic_runs.find(docs_of([])))
    assert found.count() == 0 and found.columns[:3] == ["doc_id", "n_runs", "start"]


@pytest.mark.parametrize("words", [["a"] * 5, ["a", "b", "c"] * 3 + ["a", "b"]])
def test_runs_that_are_too_short(words):
    assert periodic_runs.runs_of(periodic_runs._NUMBERS.of([w.encode() for w in words])) == []
