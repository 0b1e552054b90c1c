from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeflow.operators import iforest, snapshots
from tradeflow.operators import models as md


def test_versions(spark, tmp_path, trades):
    path = str(tmp_path / "features")
    assert snapshots.latest_version(spark, path) is None
    with pytest.raises(ValueError):
        snapshots.read_version(spark, path)
    assert snapshots.write_version(trades, path) == 0
    assert snapshots.write_version(trades.limit(2), path) == 1
    assert snapshots.read_version(spark, path).count() == 2
    state = snapshots.capture_state(spark, path, str(tmp_path / "states"), "12", "serving").first()
    assert (state.model_version, state.feature_version) == ("12", 1)
    assert snapshots.captured_states(spark, str(tmp_path / "states")).count() == 1
    assert not snapshots.verify_restore(spark, path, 0)
    assert snapshots.restore_version(spark, path, 0) == 2
    assert snapshots.verify_restore(spark, path, 0) and not snapshots.verify_restore(spark, path, 1)
    log = [(r.version, r.operation, r.rows) for r in snapshots.history(spark, path).orderBy("version").collect()]
    assert log == [(0, "WRITE", 5), (1, "WRITE", 2), (2, "RESTORE 0", 5)]
    with pytest.raises(ValueError):
        snapshots.read_version(spark, path, 9)


def test_fingerprint_ignores_order_but_not_copies(spark):
    a = spark.range(100).withColumn("x", F.col("id") % 3)
    assert snapshots.same_content(a, a.orderBy(F.col("id").desc()).repartition(5))
    assert not snapshots.same_content(a, a.unionByName(a.limit(1)))


def points(spark, n=400):
    rng = np.random.default_rng(9)
    rows = [(str(i), float(x), float(y), 0) for i, (x, y) in enumerate(rng.normal(0, 1, (n, 2)))]
    rows += [(f"o{i}", 8.0 + i, -9.0 - i, 1) for i in range(6)]
    return spark.createDataFrame(rows, "trade_id string, price double, volume double, is_anomaly int")


def test_isolation_forest_finds_outliers(spark):
    df = points(spark)
    forest = iforest.fit_isolation_forest(df, ["price", "volume"], trees=60, feature_share=1.0)
    scored = forest.score(df).orderBy(F.col("score").desc()).limit(6).collect()
    assert sum(r.is_anomaly for r in scored) >= 5
    assert forest.nodes.groupby("tree").size().max() <= 2 * iforest.SAMPLE
    flagged = forest.score(df).filter("prediction = 1").count()
    assert 5 <= flagged <= 9  # 1.5 % of 406


def test_expected_path():
    assert iforest.expected_path(1) == 0 and iforest.expected_path(2) == 1
    assert iforest.expected_path(256) == pytest.approx(10.244, abs=1e-3)


def test_tournament_survives_a_failing_model(spark):
    df = points(spark)
    data = md.prepare(df.filter("hash(trade_id) % 3 != 0"), df.filter("hash(trade_id) % 3 = 0"))

    def broken(*_):
        raise RuntimeError("no such library")

    models = {
        "random_forest": md.random_forest({"trees": 2, "depth": 3, "min_rows": 1}),
        "broken": broken,
        "boosted": md.boosted_trees(replace(md.BOOSTED_B, rounds=5, step=1.0, depth=2)),
    }
    result = md.run_tournament(data, models)
    assert set(result.errors) == {"broken"}, {name: text[:600] for name, text in result.errors.items()}
    found = {(r.model_type, r.metric): r.value for r in result.metrics.collect()}
    assert found["broken", "pr_auc"] == 0.0 and "no such library" in result.errors["broken"]
    assert [r.error for r in result.metrics.collect() if r.model_type == "broken"] == ["no such library"]
    assert found["boosted", "training_time_s"] > 0
    assert found["random_forest", "pr_auc"] > 0.5 and ("boosted", "f1_score") in found
    served = md.score_output(result.scorers["random_forest"](data.test))
    assert set(served.columns) >= {"prediction", "probability", "risk_level"}


def test_the_catalogue_tournament_runs_all_models_as_configured(monkeypatch):
    from tradeflow.plans.catalog import models as catalogue

    class Fitted:
        score = None

    seen = {}
    monkeypatch.setattr(md.boosting, "fit", lambda train, features, target, settings, valid=None: seen.setdefault(train, settings) and Fitted)
    monkeypatch.setattr(md, "fit_forest", lambda train, features, target, *given: seen.setdefault(train, given) and Fitted)
    monkeypatch.setattr(md, "fit_isolation_forest", lambda train, features, trees: seen.setdefault(train, trees) and Fitted)
    for name, trainer in catalogue.MODELS.items():
        trainer(name, ["price"], "is_anomaly")
    assert seen == {"boosted_a": md.BOOSTED_A, "boosted_b": md.BOOSTED_B, "random_forest": (500, 12, 5), "isolation_forest": 300}
    a, b = seen["boosted_a"], seen["boosted_b"]
    assert (a.rounds, a.step, a.depth, a.leaves, b.rounds, b.step, b.depth) == (1500, 0.01, 8, 63, 1200, 0.01, 8)
