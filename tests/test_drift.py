import math

import numpy as np
import pandas as pd
import pytest

from tradeflow import schemas
from tradeflow.operators import drift
from tradeflow.operators import monitoring as mon
from tradeflow.operators.quantiles import exact_percentiles


def numpy_psi(reference, current, bins=10):
    edges = np.unique(np.percentile(reference, np.linspace(0, 100, bins + 1)))
    r = (np.histogram(reference, bins=edges)[0] + 1) / (len(reference) + len(edges))
    c = (np.histogram(current, bins=edges)[0] + 1) / (len(current) + len(edges))
    return float(((c - r) * np.log(c / r)).sum())


def sides(spark, reference, current, **kinds):
    kind = kinds.get("kind", "double")
    to = (lambda v: None if v is None else float(v)) if kind == "double" else (lambda v: v)
    rows = [("reference", to(v)) for v in reference] + [("current", to(v)) for v in current]
    return spark.createDataFrame(rows, f"side string, f {kind}")


def psi(spark, reference, current, **options):
    found = drift.psi(sides(spark, reference, current), ["f"], **options).collect()
    return found[0].value if found else None


@pytest.mark.parametrize("direct_limit", [10**6, 50])
@pytest.mark.parametrize("shift", [0.0, 2.0])
def test_psi_equals_numpy(spark, direct_limit, shift):
    rng = np.random.default_rng(1)
    reference, current = rng.normal(0, 1, 1000), rng.normal(shift, 1, 1000)
    value = psi(spark, reference, current, direct_limit=direct_limit)
    assert value == pytest.approx(numpy_psi(reference, current), rel=1e-9)
    assert value < 0.1 if shift == 0 else value > 0.5


@pytest.mark.parametrize("direct_limit", [10**6, 20])
def test_psi_with_heavy_ties_and_outside_values(spark, direct_limit):
    rng = np.random.default_rng(2)
    reference = np.concatenate([np.zeros(400), rng.integers(1, 20, 300)])
    current = np.concatenate([rng.integers(-5, 30, 200), [1e9, -1e9]])
    got = psi(spark, reference, current, direct_limit=direct_limit)
    assert got == pytest.approx(numpy_psi(reference, current), rel=1e-9)


def test_psi_edge_cases(spark):
    assert psi(spark, [5] * 20, [5] * 7 + [6]) == 0.0
    assert psi(spark, [1, 2, 3], [None, None]) is None
    few = [1.0, 2.0, 10.0]
    assert psi(spark, few, [1.5, 9.0]) == pytest.approx(numpy_psi(few, [1.5, 9.0]), rel=1e-9)


@pytest.mark.parametrize("direct_limit", [10**6, 100, 5])
def test_exact_percentiles_with_a_hot_value(spark, direct_limit):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 4000, p=[0.9, 0.1]), "v": rng.lognormal(0, 3, 4000)})
    pdf.loc[rng.random(4000) < 0.35, "v"] = 1.25
    probs = [0.0, 0.01, 0.3, 0.5, 0.99, 1.0]
    got = exact_percentiles(spark.createDataFrame(pdf), ["g"], "v", probs, direct_limit)
    for row in got.collect():
        mine = pdf[pdf["g"] == row.g]["v"]
        assert row.n == len(mine)
        np.testing.assert_allclose(row.percentiles, np.percentile(mine, [p * 100 for p in probs]), rtol=1e-12)


def js(spark, reference, current):
    found = drift.js_divergence(sides(spark, reference, current, kind="string"), ["f"]).collect()
    return found[0].value if found else None


def test_js(spark):
    assert js(spark, list("AABC"), list("AABC")) < 0.01
    assert js(spark, list("AABC"), list("BBCD")) > 0.1
    assert js(spark, ["A"] * 5, ["B"] * 5) == pytest.approx(math.log(2), abs=1e-6)
    assert js(spark, list("AAB") + [None], list("AAB")) < 1e-9
    assert js(spark, list("AB"), [None]) is None


def report_input(spark):
    rng = np.random.default_rng(4)
    rows = [("reference", float(x), c) for x, c in zip(rng.normal(0, 1, 100), "AB" * 50)]
    rows += [("current", float(x), c) for x, c in zip(rng.normal(3, 1, 100), "AB" * 50)]
    return spark.createDataFrame(rows, "side string, num double, cat string")


def test_report_summary_and_alert(spark):
    df = report_input(spark)
    report = drift.drift_report(df, ["num", "absent"], ["cat"])
    assert {r.feature: r.drifted for r in report.collect()} == {"num": True, "cat": False}
    summary = drift.drift_summary(df, report)
    row = schemas.conform(summary, schemas.DRIFT_AUDIT).first()
    assert (row.reference_size, row.current_size, row.overall_drift) == (100, 100, True)
    assert row.drifted_features == '["num"]' and '"metric":"psi"' in row.feature_drift_details
    alert = mon.drift_alerts(summary).first()
    assert alert.alert_type == "drift_alert" and "num" in alert.message and len(alert.message) <= 500
    with pytest.raises(ValueError):
        drift.drift_report(df, ["nope"], [])


def test_windows_and_shared_features(spark):
    df = spark.sql(
        "SELECT explode(sequence(timestamp'2026-01-01', timestamp'2026-03-01', interval 12 hours)) AS timestamp"
    )
    counts = {r.side: r["count"] for r in drift.drift_windows(df).groupBy("side").count().collect()}
    assert counts == {"current": 2, "reference": 61}
    a, b = spark.sql("SELECT 1 x, 2 y"), spark.sql("SELECT 3 x")
    assert drift.tag_sides(a, b).columns == ["x", "side"]


def test_prediction_drift(spark):
    rng = np.random.default_rng(5)
    df = sides(spark, rng.random(500), rng.random(500) ** 3)
    row = drift.prediction_drift(df, "f").first()
    assert row.drifted and row.threshold == 0.2
