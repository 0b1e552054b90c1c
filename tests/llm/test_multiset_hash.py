import hashlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from tradeflow.llm import multiset_hash as mh

lines = st.lists(st.sampled_from(["one two three four", "five six", "a", "b", "one two three five", "é"]), max_size=12)


@given(lines, st.randoms())
def test_order_does_not_matter(parts, rng):
    mixed = list(parts)
    rng.shuffle(mixed)
    assert np.array_equal(mh.fingerprint("\n".join(parts)), mh.fingerprint("\n".join(mixed)))


@given(lines, lines)
def test_insertion_and_deletion(a, b):
    both = mh.combine(mh.fingerprint("\n".join(a)), mh.fingerprint("\n".join(b)))
    assert np.array_equal(both, mh.fingerprint("\n".join(a + b)))
    assert np.array_equal(mh.remove(both, mh.fingerprint("\n".join(b))), mh.fingerprint("\n".join(a)))


@given(lines, lines)
def test_different_multisets_differ(a, b):
    same = np.array_equal(mh.fingerprint("\n".join(a)), mh.fingerprint("\n".join(b)))
    assert same == (sorted(a) == sorted(b))


def test_text_form_round_trips():
    own = mh.fingerprint("one two three\nfour")
    assert np.array_equal(mh.from_text(mh.to_text(own)), own)


def test_likeness_follows_the_shared_share():
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in rng.integers(0, 10**6, 2000)]
    for share in (0.0, 0.25, 0.5, 0.75):
        cut = int(2000 * share)
        other = words[:cut] + [f"v{k}" for k in rng.integers(0, 10**6, 2000 - cut)]
        got = mh.likeness(mh.fingerprint(" ".join(words)), mh.fingerprint(" ".join(other)))
        assert abs(got - share) < 0.25
    assert mh.likeness(mh.fingerprint(""), mh.fingerprint(None or "")) == 1.0


def brute(texts):
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        half = len(text) // 2
        yield i, len(text), text[: len(text) - half] + after[:half], after


def check(docs, texts, parts):
    rows = {r.doc_id: r for r in mh.edited_pairs(docs, parts).collect()}
    assert len(rows) == len(texts)
    for i, n, edited, after in brute(texts):
        r = rows[i]
        own = mh.fingerprint(texts[i] or "")
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == mh.to_text(own) and r.edited_fingerprint == mh.to_text(mh.fingerprint(edited))
        assert r.near_next == mh.likeness(own, mh.fingerprint(after)) and 0 <= r.near_edited <= 1


def test_next_document_across_blocks(docs_of, awkward):
    texts = {3 * k - 5: t for k, t in enumerate(awkward * 3)}
    docs = docs_of(list(texts.values()), list(texts))
    for parts in (1, 2, 7):
        check(docs.repartition(3), texts, parts)


def test_one_row_is_its_own_next(docs_of):
    check(docs_of(["abc def"]), {0: "abc def"}, 4)


def test_null_ids_repeats_and_empty_tables(docs_of):
    rows = mh.edited_pairs(docs_of(["a b", "a b", "c", "d"], [1, 1, None, 2]), 3).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in rows if r.doc_id is not None) == [(False, 1), (False, 1), (False, 2)] and len(rows) == 4
    assert mh.edited_pairs(docs_of([]), 3).count() == 0
    assert mh.fingerprints(docs_of([None, "x"])).count() == 2
