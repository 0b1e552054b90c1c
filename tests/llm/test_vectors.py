"""Near-duplicate vectors and hard negatives against brute force, and their defined cases."""

import math
import random

import numpy as np
import pytest

from tradeflow.llm import product_codes, strassen_negatives
from tradeflow.llm.queries import QUERIES

SCHEMA = "vec_id long, label int, embedding array<float>, source string"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def clusters(seed, n, dim=16, labels=3):
    """Rows around a few centres, with copies, scaled copies, and chains that link only through their middle."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = []
    for _ in range(n):
        v = rng.normal(size=dim) if rng.random() < 0.3 else centres[rng.integers(6)] + rng.normal(size=dim) * rng.choice([0.01, 0.08, 0.15, 0.3])
        rows.append((rng.integers(labels), v))
    rows += [(label, v) for label, v in rows[:20]] + [(label, 3 * v) for label, v in rows[20:30]]
    rows += [(0, np.eye(dim)[0] + 0.15 * k * np.eye(dim)[1]) for k in range(12)]
    return [(i, int(label), [float(x) for x in np.float32(v)], "s") for i, (label, v) in enumerate(rows)]


AWKWARD = [
    (None, 1, [1.0] * 16, "n"),
    (9_000, None, [1.0] * 16, "n"),
    (9_001, 1, None, "n"),
    (9_002, 1, [0.0] * 16, "n"),
    (9_003, 1, [1.0, None] + [0.0] * 14, "n"),
    (9_004, 1, [float("nan")] + [1.0] * 15, "n"),
    (9_005, 1, [float("inf")] + [1.0] * 15, "n"),
    (9_006, 2, [1.0] * 16, "n"),
    (9_007, 2, [-1.0] * 16, "n"),
    (9_008, 2, [], "n"),
    (9_009, 2, [2.0, -0.0], "n"),
    (9_010, 2, [1.0, 0.0], "n"),
]


def padded(v, dim=16):
    return np.array([*v, *[0.0] * (dim - len(v))], float)


def brute_duplicates(rows, least=0.98):
    good = [(i, label, padded(v)) for i, label, v, _ in rows if i is not None and label is not None and usable(v) and any(v)]
    links = {i: set() for i, *_ in rows if i is not None}
    for a, la, u in good:
        for b, lb, v in good:
            if a != b and la == lb and u @ v / math.sqrt((u @ u) * (v @ v)) >= least:
                links[a].add(b)
    out = []
    for i, *_ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((i, len(links.get(i, ())), None if i is None else min(seen), i is None or i == min(seen)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("list_rows", "tile"), [(4_096, 4_096), (40, 30)])
def test_duplicates_like_brute_force(spark, list_rows, tile):
    rows = clusters(2, 420) + AWKWARD
    df = spark.createDataFrame(rows, SCHEMA)
    found = product_codes.near_duplicates(df, 0.98, list_rows, tile)
    expected = brute_duplicates(rows)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert sum(r[1] > 0 for r in expected) > 100


def test_no_probe_and_no_code_loses_a_neighbour():
    """Every pair within the radius is probed and passes the table lookup, for many directions of the difference."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    quantiser = product_codes.fit(x, [64])[64]
    own, distance = quantiser.nearest(x)
    # Neighbours at the very radius, towards another centroid (the worst direction).
    toward = quantiser.centroids[rng.integers(64, size=len(x))]
    tangent = toward - (toward * x).sum(1)[:, None] * x
    y = x * 0.9801 + tangent / np.linalg.norm(tangent, axis=1)[:, None] * math.sqrt(1 - 0.9801**2)
    needed = product_codes.probes(quantiser, distance, own, 0.98)
    there, _ = quantiser.nearest(y)
    assert needed[np.arange(len(x)), there].all()
    assert (there != own).sum() > 300 and needed.mean() < 0.9
    residual = y - quantiser.centroids[there]
    codes, error = quantiser.encode(residual)
    tables = quantiser.tables(x - quantiser.centroids[there])
    looked_up = np.sqrt(tables[np.arange(len(x))[:, None], np.arange(product_codes.SUBSPACES), codes].sum(1))
    assert (looked_up <= product_codes.radius(0.98) + error + product_codes.SLACK).all()


def test_repeated_ids_and_many_copies(spark):
    rows = [(1, 0, [1.0, 0.0], "a")] * 3 + [(k, 0, [0.6, 0.8], "b") for k in range(10, 310)] + [(400, 0, [0.6, 0.81], "c")]
    found = {r.vec_id: tuple(r)[1:] for r in product_codes.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[1] == (0, 1, True) and len(found) == 302
    assert found[10] == (300, 10, True) and found[400] == (300, 10, False) and found[200] == (300, 10, False)


def test_empty_table_of_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert product_codes.near_duplicates(empty).collect() == []
    assert spark.createDataFrame(AWKWARD[1:4], SCHEMA).transform(product_codes.near_duplicates).filter("kept AND n_links = 0").count() == 3


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (40, 33, 65), (129, 64, 200), (2, 300, 9)])
def test_strassen_is_exact(shape):
    m, n, k = shape
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-(2**20), 2**20, (m, k)), rng.integers(-(2**20), 2**20, (n, k))
    assert (strassen_negatives.strassen(a, b, 4) == a @ b.T).all()
    assert strassen_negatives.strassen(a, b).dtype == np.int64


def brute_negatives(rows):
    good = []
    for i, label, v, _ in rows:
        if i is not None and label is not None and usable(v):
            good.append((i, (label + 1) % 10 if i % 7 == 0 else label, np.array([math.floor(256 * x) for x in padded(v)], np.int64)))
    out = []
    for a, la, u in (r for r in good if r[0] % 50 == 0):
        scored = [(-int(u @ v), b, lb) for b, lb, v in good if b != a]
        for ps, p, _ in sorted(s for s in scored if s[2] == la)[:5]:
            inside = sorted(s for s in scored if s[2] != la and 50 * -ps <= 100 * -s[0] <= 95 * -ps)
            out += [(a, p, rank, n, -ps, -ns) for rank, (ns, n, _) in enumerate(inside[:3], 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(2_048, 8_192), (4, 100)])
def test_negatives_like_brute_force(spark, tmp_path, monkeypatch, sizes):
    rows = [(i * 5, label, v, s) for i, label, v, s in clusters(8, 600)] + [r for r in AWKWARD if r[2] != []]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    monkeypatch.setattr(strassen_negatives.mine, "__defaults__", (5, 3, 50, 95, *sizes))
    found = QUERIES["op13_hard_negatives"](spark, str(tmp_path))
    expected = brute_negatives(rows)
    assert sorted(map(tuple, found.collect())) == expected and len(expected) > 100
    assert dict(found.dtypes)["rank"] == "int"


def test_heaps_take_ties_by_id():
    rng = random.Random(2)
    heaps, entries = strassen_negatives.Heaps(4, 3), []
    for start in range(0, 60, 10):
        part = [(rng.randrange(4), rng.randrange(3), start + k) for k in range(10)]
        entries += part
        heaps.offer(*(np.array(c, np.int64) for c in zip(*part, strict=True)))
    for slot in range(4):
        best = sorted((-s, i) for k, s, i in entries if k == slot)[:3]
        assert [(-int(s), int(i)) for k, s, i in zip(heaps.slot, heaps.score, heaps.id, strict=True) if k == slot] == best


def test_scores_beyond_64_bits_are_an_error(spark):
    rows = spark.createDataFrame([(50, 1, [2**40, 1]), (51, 1, [2**40, 2])], "vec_id long, label int, vec array<long>")
    with pytest.raises(ArithmeticError):
        strassen_negatives.mine(rows, rows.vec_id == 50)


def test_negatives_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, label int, vec array<long>")
    assert strassen_negatives.mine(empty, empty.vec_id == 50).collect() == []
