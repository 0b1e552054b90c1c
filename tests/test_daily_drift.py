"""The report from stored daily counts equals the report over all rows."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeflow.operators import daily_drift as dd
from tradeflow.operators import drift

NUMERIC, CATEGORICAL = ["price", "size", "flat", "gone", "codes"], ["symbol", "venue"]
START = dt.datetime(2026, 3, 1)


def rows(days=34, per_day=60, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for day in range(days):
        for k in range(per_day):
            at = START + dt.timedelta(days=day, seconds=int(rng.integers(0, 86_400)) if k else 0)  # midnight itself
            price = float(np.round(rng.normal(0, 50 if day < days - 1 else 90), int(rng.integers(0, 4))))
            size = None if rng.random() < 0.1 else float(rng.lognormal(3, 2))
            out.append((at, price, size, 7.0, None if day > 3 else 1.0, int(rng.integers(-3, 4)), str(rng.integers(5)), None if k % 9 == 0 else "ABC"[day % 3]))
    return out


def table(spark, data):
    return spark.createDataFrame(data, "timestamp timestamp, price double, size double, flat double, gone double, codes int, symbol string, venue string")


def by_feature(report):
    return {r.feature: (r.metric, r.value, r.threshold, r.drifted) for r in report.collect()}


def assert_same(got, expected):
    assert got.keys() == expected.keys()
    for name, (metric, value, threshold, drifted) in expected.items():
        assert got[name][0] == metric and got[name][2:] == (threshold, drifted)
        assert math.isclose(got[name][1], value, rel_tol=1e-9, abs_tol=1e-12), name


@pytest.fixture(scope="module")
def last(spark):
    return table(spark, rows()).agg(F.max(dd.day_of(F.col("timestamp")))).first()[0]


def test_days_end_at_midnight(spark):
    times = [START, START + dt.timedelta(microseconds=1), START - dt.timedelta(microseconds=1), dt.datetime(1969, 12, 31, 12), dt.datetime(1970, 1, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp")
    first = (START - dt.datetime(1970, 1, 1)).days
    assert [r[0] for r in df.select(dd.day_of(F.col("t"))).collect()] == [first, first + 1, first, 0, 0]


def test_cells_follow_the_order_of_values(spark):
    values = sorted([0.0, 1e-300, -1e-300, 5.0, -5.0, 5.01, 1e300, -1e300, float("inf"), float("-inf"), *np.random.default_rng(3).normal(0, 9, 300).tolist()])
    cells = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(dd.cell_of(F.col("v"))).collect()]
    assert cells == sorted(cells) and len(set(cells)) > 200


def test_day_by_day_equals_the_full_report(spark, tmp_path, last):
    data, folder = table(spark, rows()), str(tmp_path / "daily")
    dd.record_new(data, folder, NUMERIC, CATEGORICAL, last - 2)
    for day in (last - 1, last):
        dd.record_new(data, folder, NUMERIC, CATEGORICAL, day)
        for days in (30, 5):
            expected = by_feature(drift.drift_report(dd.day_sides(data, day, days), NUMERIC, CATEGORICAL))
            assert_same(by_feature(dd.report(spark, folder, day, days)), expected)
    assert "gone" not in expected and expected["price"][3]
    sides = dd.day_sides(data, last).groupBy("side").count()
    size = dd.sizes(spark, folder, last).first()
    assert {r["side"]: r["count"] for r in sides.collect()} == {"reference": size.reference_size, "current": size.current_size}


def test_a_run_reads_the_new_day_only(spark, tmp_path, last):
    """Old rows that have changed since are not seen, and the filter on time reaches the scan."""
    folder = str(tmp_path / "daily")
    data = table(spark, rows())
    dd.record_new(data, folder, NUMERIC, CATEGORICAL, last - 1)
    changed = data.withColumn("price", F.when(dd.day_of(F.col("timestamp")) < last, 1e6).otherwise(F.col("price")))
    changed.write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    dd.record_new(source, folder, NUMERIC, CATEGORICAL, last)
    assert_same(by_feature(dd.report(spark, folder, last)), by_feature(drift.drift_report(dd.day_sides(data, last), NUMERIC, CATEGORICAL)))
    plan = dd._within(source, "timestamp", last - 1, last)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(timestamp" in plan
    dd.record_new(source, folder, NUMERIC, CATEGORICAL, last)  # nothing is new
    assert dd.recorded_days(spark, folder).agg(F.sum("rows")).first()[0] == data.count()


def test_a_repeated_day_is_replaced(spark, tmp_path, last):
    data, folder = table(spark, rows(days=6)), str(tmp_path / "daily")
    day = data.agg(F.max(dd.day_of(F.col("timestamp")))).first()[0]
    dd.record(data, folder, NUMERIC, CATEGORICAL)
    dd.record(data.filter(dd.day_of(F.col("timestamp")) == day), folder, NUMERIC, CATEGORICAL)
    assert_same(by_feature(dd.report(spark, folder, day)), by_feature(drift.drift_report(dd.day_sides(data, day), NUMERIC, CATEGORICAL)))


def test_nothing_recorded(spark, tmp_path):
    assert dd.report(spark, str(tmp_path / "none"), 3).collect() == []
    dd.record(table(spark, []), str(tmp_path / "empty"), NUMERIC, CATEGORICAL)
    assert dd.report(spark, str(tmp_path / "empty"), 3).collect() == []
    assert tuple(dd.sizes(spark, str(tmp_path / "none"), 3).first()) == (0, 0)
