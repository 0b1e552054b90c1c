"""The rejection threshold of op7 comes from every training row."""

import numpy as np

from tradeflow.llm import kneser_ney as kn


def test_threshold_equals_brute_force_over_all_rows(spark):
    rng = np.random.default_rng(2)
    words = {"a": ["lorem", "ipsum", "dolor"], "b": ["lorum", "ipsem", "doler"]}
    rows = []
    for k in range(6_000):  # more than the bounded sample there was
        lang = "ab"[k % 2]
        spoken = "ab"[(k + (k % 23 == 0)) % 2]
        rows.append((k, lang, " ".join(rng.choice(words[spoken], rng.integers(1, 4)))))
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    model = kn.calibrate(kn.train(df), df, precision=0.96)
    found = kn.identify(df, model).toPandas().merge(df.toPandas()[["doc_id", "lang"]], on="doc_id")
    right = (found["lang_pred"] == found["lang"]).to_numpy()
    margin = found["margin"].to_numpy()
    good = [m for m in np.unique(margin) if right[margin >= m].mean() >= 0.96]
    assert model.margin == (min(good) if good else float("inf"))
    assert found["accepted"].sum() == (margin >= model.margin).sum()
