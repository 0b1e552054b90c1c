import random

import pytest

from tradeflow.llm import chosen_path as cp
from tradeflow.llm.text import words


def brute(texts, width, percent):
    """Component of every id by comparing all pairs."""
    sets = {}
    for i, t in texts.items():
        w = words(t or "")
        n = min(width, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in texts:
        for j in texts:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in texts}


def family(rng, base, copies, edits):
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    texts = [None, "", "  \n", "one", "one", "One two", "one TWO", "Ünï çode", "ünï çode"]
    for size, copies, edits in ((60, 40, 4), (200, 12, 12), (30, 6, 1), (120, 3, 0)):
        texts += family(rng, [word() for _ in range(size)], copies, edits)
    passage = " ".join(word() for _ in range(40))
    texts += [f"{passage} {' '.join(word() for _ in range(60))}" for _ in range(25)]
    texts += [" ".join(word() for _ in range(rng.randint(1, 80))) for _ in range(60)]
    rng.shuffle(texts)
    return {5 * k + 2: t for k, t in enumerate(texts)}


# The second and third settings force branching, and blocks of nodes that do not get small.
@pytest.mark.parametrize("limits", [{}, {"node_rows": 6, "trees": 16}, {"node_rows": 4, "max_level": 1, "block_rows": 3}])
def test_components_equal_brute_force(docs_of, limits):
    texts = corpus(4)
    want = brute(texts, 3, 85)
    found = cp.near_duplicates(docs_of(list(texts.values()), list(texts)), 3, 85, **limits).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want and len(found) == len(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_keep_one_of_each(docs_of):
    texts = corpus(9)
    want = {i for i, (_, c) in brute(texts, 5, 80).items() if i == c}
    docs = docs_of(list(texts.values()), list(texts)).withColumnRenamed("source", "component_id")
    got = cp.keep_one_of_each(docs, 5, 80)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_null_and_repeated_ids(docs_of):
    docs = docs_of(["a b c d"] * 5, [7, 7, None, 3, None])
    rows = cp.near_duplicates(docs, 3, 85).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id is not None) == [(3, 3, True), (7, 3, False), (7, 3, False)]
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)] * 2
    assert sorted(map(str, (r.doc_id for r in cp.keep_one_of_each(docs_of(["a b c"] * 2 + ["x"], [1, 1, 2]), 3, 85).collect()))) == ["1", "2"]


def test_empty_table(docs_of):
    assert cp.near_duplicates(docs_of([]), 3, 85).count() == 0


def test_components_of_a_long_chain(spark):
    rng = random.Random(1)
    ids = list(range(400))
    rng.shuffle(ids)
    links = [(a, b) for a, b in zip(ids[:-1], ids[1:], strict=True)]
    got = cp.components(spark.createDataFrame([(max(x), min(x)) for x in links], "a long, b long")).collect()
    assert {r.root for r in got} == {0} and len(got) == 399
