import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tradeflow.llm import kneser_ney as kn

EN = ["the cat and the dog went over the hill with them", "this is the house that they built for her", "when will you come and see the water"]
ES = ["el perro y el gato fueron por la colina con ellos", "esta es la casa que hicieron para la mujer", "cuando vienes tú a ver el agua de la sierra"]


@pytest.fixture
def model(docs_of):
    return kn.train(docs_of(EN * 3 + ES * 3, langs=["en"] * 9 + ["es"] * 9))


def test_probabilities_sum_to_at_most_one(model):
    for order in (1, 2, 3):
        keys, probs = model.keys[order - 1], np.exp2(model.logs[order - 1])
        contexts = keys >> np.uint64(16)
        for c in np.unique(contexts):
            assert (probs[contexts == c].sum(0) <= 1 + 1e-5).all()


def test_interpolation_by_hand(docs_of):
    model = kn.train(docs_of(["ab", "ab", "ac"], langs=["x"] * 3), order=2, min_count=1)
    key = lambda a, b: (np.uint64(ord(a)) << np.uint64(16)) | np.uint64(ord(b))
    value = lambda a, b: 2.0 ** model.logs[1][np.searchsorted(model.keys[1], key(a, b)), 0]
    # Bigrams " a" 3, "ab" 2, "ac" 1, "b " 2, "c " 1: no two discounts apart from ones=2, twos=2.
    d2 = 2 / (2 + 2 * 2)
    # Continuations: a 1, b 1, c 1, blank 2; ones=3, twos=1; four letters.
    d1 = 3 / (3 + 2 * 1)
    uni = lambda n: max(n - d1, 0) / 5 + d1 * 4 / 5 * (1 / 5)
    assert value("a", "b") == pytest.approx((2 - d2) / 3 + d2 * 2 / 3 * uni(1), rel=1e-5)
    assert value("a", "c") == pytest.approx((1 - d2) / 3 + d2 * 2 / 3 * uni(1), rel=1e-5)


def test_new_sentences(model, docs_of):
    docs = docs_of(["they went with the dog", "la casa de la mujer", "12 34", None, "", "the dog"])
    rows = {r.doc_id: r for r in kn.identify(docs, model).collect()}
    assert [rows[k].lang_pred for k in range(6)] == ["en", "es", "und", "und", "und", "en"]
    assert all(0 <= r.score <= 1 for r in rows.values()) and not rows[2].accepted


def test_cross_entropy_of_a_batch_equals_single_texts(model):
    texts = ["the water", "", "el agua", "é 1 漢", "x" * 5_000, "a-b  c"]
    whole, n = model.cross_entropy(texts)
    for k, t in enumerate(texts):
        one, m = model.cross_entropy([t])
        assert np.allclose(one[0], whole[k]) and m[0] == n[k]


def test_rejection_is_calibrated(model, docs_of):
    learn = docs_of(EN * 3 + ES * 3 + ["the la el"], langs=["en"] * 9 + ["es"] * 9 + ["es"])
    assert kn.calibrate(model, learn).margin >= 0
    wrong = docs_of(EN + ES, langs=["es"] * 3 + ["en"] * 3)
    assert kn.calibrate(model, wrong).margin == float("inf")


@given(st.lists(st.text(max_size=30), max_size=5))
def test_letters_by_brute_force(texts):
    points, own = kn.letters(texts)
    for k, text in enumerate(texts):
        low = [(c.lower() if len(c.lower()) == 1 else c) if c.isalpha() and ord(c) < 0x30000 else " " for c in text]
        want = " ".join("".join(low).split(" ")).split()
        assert "".join(map(chr, points[own == k])) == "".join(w + " " for w in want)


def test_awkward_tables(docs_of, awkward):
    assert kn.train(docs_of([])) is None and kn.train(docs_of(["abc"], langs=[None])) is None
    rows = kn.identify(docs_of(awkward), None).collect()
    assert len(rows) == len(awkward) and {r.lang_pred for r in rows} == {"und"}
    one = kn.calibrate(kn.train(docs_of(awkward)), docs_of(awkward))
    rows = {r.doc_id: r for r in kn.identify(docs_of(awkward), one).collect()}
    assert [rows[k].lang_pred for k in range(5)] == ["und", "und", "und", "en", "en"] and kn.identify(docs_of([]), one).count() == 0


def test_counts_of_one_stay_and_set_the_discount(docs_of):
    model = kn.train(docs_of(["ab", "ab", "ac"], langs=["x"] * 3), order=2)
    key = lambda a, b: (np.uint64(ord(a)) << np.uint64(16)) | np.uint64(ord(b))
    assert key("a", "c") in model.keys[1]
    # ones=2, twos=2 of the bigrams and ones=3, twos=1 of the continuations, as by hand above.
    want = (1 - 1 / 3) / 3 + (1 / 3) * 2 / 3 * ((1 - 0.6) / 5 + 0.6 * 4 / 5 / 5)
    assert 2.0 ** model.logs[1][np.searchsorted(model.keys[1], key("a", "c")), 0] == pytest.approx(want, rel=1e-5)


def test_a_model_beyond_memory_gives_the_same_scores(docs_of, awkward):
    texts, langs = EN * 40 + ES + ["漢字仮名交じり文 を書く"], ["en"] * 120 + ["es"] * 3 + ["ja"]
    docs = docs_of([*EN, *ES, "漢字 を", "they went", "él ñandú жук", *awkward, "again", "again"], ids=[*range(len(awkward) + 9), None, None])
    in_memory = kn.train(docs_of(texts, langs=langs))
    for limit in (3, 60):
        large = kn.train(docs_of(texts, langs=langs), max_grams=limit)
        assert isinstance(large, kn.StoredModel) and large.languages == ["en", "es", "ja"] and len(large.head[0]) == limit // 3
        key = lambda r: (r.doc_id is None, r.doc_id or 0)
        a, b = (sorted(kn.identify(docs, m).collect(), key=key) for m in (in_memory, large))
        assert [(r.doc_id, r.lang_pred) for r in a] == [(r.doc_id, r.lang_pred) for r in b]
        for name in ("score", "cross_entropy", "margin"):
            assert np.allclose(*[np.array([r[name] for r in rows], float) for rows in (a, b)], rtol=1e-4, atol=1e-5, equal_nan=True)
