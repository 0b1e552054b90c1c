"""Mergeable rollups within their bounds, and located differences against a plain comparison."""

import datetime as dt
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeflow.operators import differences as df_
from tradeflow.operators import monitoring, rollups

START = dt.datetime(2026, 5, 1)


def log_rows(n=3_000, seed=2):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        value = [float(rng.lognormal(2, 3)), 0.0, -float(rng.lognormal()), None, float("nan")][rng.choice(5, p=[0.9, 0.03, 0.03, 0.02, 0.02])]
        out.append((START + dt.timedelta(seconds=int(rng.integers(0, 40_000))), ["a", "b", None][rng.integers(3)], value, None if k % 50 == 0 else int(rng.integers(900))))
    return out


@pytest.fixture
def log(spark):
    return spark.createDataFrame(log_rows(), "timestamp timestamp, model string, ms double, key long")


def test_merged_quantiles_stay_within_the_error(spark, log):
    stored = rollups.rollup(log, ["model"], "ms", "key", "20 minutes").cache()
    for by in (["model"], []):
        found = {tuple(r[c] for c in by): r for r in rollups.merged(stored, by, [0.0, 0.25, 0.5, 0.99, 1.0]).collect()}
        groups = Counter()
        values = {}
        for _, model, ms, _ in log_rows():
            own = (model,) if by else ()
            groups[own] += 1
            if ms is not None and ms == ms:
                values.setdefault(own, []).append(ms)
        assert {k: r.rows for k, r in found.items()} == groups
        for own, xs in values.items():
            xs.sort()
            assert found[own].average == pytest.approx(np.mean(xs))
            for q in (0.0, 0.25, 0.5, 0.99, 1.0):
                exact = xs[int(q * (len(xs) - 1))]
                assert abs(found[own][f"q{round(100 * q)}"] - exact) <= abs(exact) * (rollups.ERROR + 1e-9)


def test_merging_in_any_order_gives_the_same(spark, log):
    whole = rollups.rollup(log, ["model"], "ms", "key", "1 day")
    parts = [rollups.rollup(log.filter(F.hash("timestamp", "ms") % 3 == k), ["model"], "ms", "key", "10 minutes") for k in (0, 1, 2, -1, -2)]
    many = parts[0]
    for part in reversed(parts[1:]):
        many = many.unionByName(part)
    one, other = ({r.model: r for r in rollups.merged(x, ["model"]).collect()} for x in (whole, many))
    assert one.keys() == other.keys()
    for model, r in one.items():
        assert (r.rows, r.q50, r.q99) == (other[model].rows, other[model].q50, other[model].q99)
        assert abs(r.distinct_keys - other[model].distinct_keys) <= 0.03 * r.distinct_keys


def test_distinct_keys_and_repeated_batches(spark, log):
    stored = rollups.rollup(log, [], "ms", "key").cache()
    exact = len({k for *_, k in log_rows() if k is not None})
    once, twice = (rollups.merged(x, []).first().distinct_keys for x in (stored, stored.unionByName(stored)))
    assert once == twice and abs(once - exact) <= 0.065 * exact


def test_batches_merge_to_the_quality_of_all(spark, trades):
    trades = trades.withColumn("volume", F.col("volume").cast("double"))
    empty = trades.limit(0)
    whole = monitoring.batch_quality(trades).drop("batch_id").first()
    parts = [rollups.batch_rollup(p, k) for k, p in enumerate([trades.filter("symbol = 'AAPL'"), empty, trades.filter("symbol = 'MSFT'")])]
    merged = rollups.merged_quality(parts[0].unionByName(parts[1]).unionByName(parts[2])).first()
    assert all(
        a == pytest.approx(b) if isinstance(b, float) else a == b for a, b in zip(merged, (whole[c] for c in merged.asDict()), strict=True)
    )
    none = rollups.merged_quality(parts[1]).first()
    assert (none["count"], none.distinct_symbols, none.avg_price, none.stddev_price, none.min_timestamp) == (0, 0, 0.0, 0.0, None)


def test_empty_log(spark, log):
    assert rollups.rollup(log.limit(0), ["model"], "ms", "key").count() == 0


SCHEMA = "id long, part string, x double, note string"


def both(spark, seed=4, n=600):
    rng = np.random.default_rng(seed)
    was = [(None if k == 5 else k % 400, "ab"[k % 2], float(rng.integers(9)), None if k % 7 == 0 else str(rng.integers(5))) for k in range(n)]
    now = [r for k, r in enumerate(was) if k % 90 != 11]
    now = [(i, p, x + 1, note) if k % 100 == 3 else (i, p, x, None) if k % 131 == 9 else (i, p, x, note) for k, (i, p, x, note) in enumerate(now)]
    now += [(10_000 + k, "a", 1.0, "new") for k in range(3)] + [was[5], was[5], was[8]]
    return was, now


def plain(was, now):
    rows = [{}, {}]
    for side, table in zip(rows, (was, now), strict=True):
        for r in table:
            side.setdefault(r[:2], Counter())[r] += 1
    out = set()
    for key in rows[0].keys() | rows[1].keys():
        a, b = rows[0].get(key), rows[1].get(key)
        if a != b:
            out.add((*key, "removed" if b is None else "added" if a is None else "changed"))
    return out


def test_located_differences_equal_a_plain_comparison(spark):
    was, now = both(spark)
    one, other = spark.createDataFrame(was, SCHEMA), spark.createDataFrame(now, SCHEMA).repartition(5).select("note", "x", "part", "id")
    found = df_.locate(one, other, ["id", "part"]).collect()
    assert {tuple(r) for r in found} == plain(was, now) and len(found) == len(plain(was, now)) > 15


def test_equal_tables_end_at_the_root(spark):
    was, _ = both(spark)
    one = spark.createDataFrame(was, SCHEMA)
    trees = [df_.digest_tree(t, ["id", "part"]).cache() for t in (one, one.orderBy(F.rand(3)).repartition(3))]
    assert df_.unequal_leaves(*trees) == []
    assert df_.locate(one, one, ["id", "part"], tuple(trees)).count() == 0
    assert {r.level: r.rows for r in trees[0].groupBy("level").agg(F.sum("rows").alias("rows")).collect()} == {0: 600, 1: 600, 2: 600}


def test_only_unequal_leaves_are_wanted(spark):
    one = spark.range(5_000).select("id", F.lit("p").alias("part"), F.lit(1.0).alias("x"), F.lit("n").alias("note"))
    other = one.withColumn("x", F.when(F.col("id").isin(17, 4_000), 2.0).otherwise(F.col("x")))
    trees = [df_.digest_tree(t, ["id"]) for t in (one, other)]
    assert len(df_.unequal_leaves(*trees)) == 2
    assert {tuple(r) for r in df_.locate(one, other, ["id"]).collect()} == {(17, "changed"), (4_000, "changed")}


def test_empty_sides_and_other_columns(spark):
    was, _ = both(spark)
    one = spark.createDataFrame(was, SCHEMA)
    assert {r.difference for r in df_.locate(one, one.limit(0), ["id", "part"]).collect()} == {"removed"}
    assert df_.locate(one.limit(0), one.limit(0), ["id"]).count() == 0
    with pytest.raises(ValueError):
        df_.locate(one, one.drop("x"), ["id"])
