"""Percentiles of many columns at once against numpy, for every way the cells can fall."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradeflow.operators.boosting import cut_points
from tradeflow.operators.quantiles import column_percentiles

PROBS = [i / 32 for i in range(1, 32)]


def _columns(n: int) -> pd.DataFrame:
    rng = np.random.default_rng(3)
    x = rng.normal(size=n)
    holes = np.where(rng.random(n) < 0.3, np.nan, rng.exponential(size=n))
    return pd.DataFrame({"x": x, "holes": holes, "few": rng.integers(0, 4, n).astype(float), "same": 1.5, "nothing": np.nan})


@pytest.mark.parametrize(("edges", "limit"), [(8_192, 1_000_000), (16, 1_000_000), (2, 1_000_000), (16, 10)])
def test_percentiles_equal_numpy(spark, edges, limit):
    own = _columns(5_000)
    found = column_percentiles(spark.createDataFrame(own).repartition(5), list(own), PROBS, cell_limit=limit, edges=edges)
    for name, got in zip(own, found, strict=True):
        x = own[name].dropna().to_numpy()
        want = np.quantile(x, PROBS) if len(x) else np.empty(0)
        np.testing.assert_allclose(got, want, rtol=1e-12, atol=1e-12)


def test_empty_and_one_row(spark):
    none = spark.createDataFrame([], "x double")
    assert [len(x) for x in column_percentiles(none, ["x"], PROBS)] == [0]
    one = spark.createDataFrame([(2.0,)], "x double")
    assert column_percentiles(one, ["x"], [0.1, 0.9])[0].tolist() == [2.0, 2.0]


def test_many_cut_points_of_many_distinct_values_are_quick(spark):
    """Spark's own percentile looks at every distinct value once more for each percentile."""
    rows = spark.range(1_000_000).select(*[F.rand(k).alias(f"f{k}") for k in range(17)])
    started = time.monotonic()
    found = cut_points(rows, [f"f{k}" for k in range(17)], 256)
    assert [len(x) for x in found] == [255] * 17
    assert time.monotonic() - started < 25
