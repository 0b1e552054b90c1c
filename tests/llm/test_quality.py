import numpy as np
import pytest

from tradeflow.llm import quality_fm as fm


def test_linear_time_identity_equals_all_pairs():
    rng = np.random.default_rng(3)
    machine = fm.Machine(0.3, rng.normal(size=fm.N_SLOTS), rng.normal(size=(fm.N_SLOTS, fm.RANK)))
    rows = [fm.describe(t) for t in ("one two two three", "", "A | B!! c")]
    got = machine.margins(*fm.pack(rows))
    for (slots, values), z in zip(rows, got, strict=True):
        pairs = sum(machine.v[slots[i]] @ machine.v[slots[j]] * values[i] * values[j] for i in range(len(slots)) for j in range(i))
        assert z == pytest.approx(0.3 + machine.w[slots] @ values + pairs)


def texts(n):
    rng = np.random.default_rng(1)
    vocab = ["tha", "ner", "ing", "ed", "on", "the", "of"]
    good = [" ".join(rng.choice(vocab, 60)).capitalize() + "." for _ in range(n)]
    bad = [" ".join(w.upper() + "!!" for w in rng.choice(vocab, 40)) for _ in range(n // 2)]
    return good, bad


def test_learns_and_holds_out(spark, docs_of):
    good, bad = texts(80)
    docs = docs_of(good + bad)
    labels = spark.createDataFrame([(k, int(k < len(good))) for k in range(len(good) + len(bad)) if k % 2], "doc_id long, label int")
    machine = fm.train(docs, labels)
    rows = fm.score(docs, machine).collect()
    assert all((r.score >= 0.3) == (r.doc_id < len(good)) for r in rows)
    kept = fm.keep_good(docs, machine, 0.3)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(len(good)))


def test_bound_on_training_rows(spark, docs_of):
    good, bad = texts(30)
    docs = docs_of(good + bad)
    labels = spark.createDataFrame([(k, int(k < 30)) for k in range(45)], "doc_id long, label int")
    assert fm.train(docs, labels, max_rows=10).w.shape == (fm.N_SLOTS,)


def test_bound_on_entries_keeps_whole_rows(spark, docs_of):
    good, bad = texts(30)
    long = " ".join(f"w{k}" for k in range(3_000))
    docs, labels = docs_of(good + bad + [long]), spark.createDataFrame([(k, int(k < 30)) for k in range(46)], "doc_id long, label int")
    whole = fm.train(docs, labels)
    same = fm.train(docs, labels, max_entries=10**9)
    assert (whole.w == same.w).all() and (fm.train(docs, labels, max_entries=40).w != whole.w).any()
    learnt = {s for s in fm.describe(long)[0].tolist() if whole.w[s]}
    assert len(learnt) > 0.9 * len(fm.describe(long)[0])
    assert fm.train(docs, labels, max_entries=0).w.shape == (fm.N_SLOTS,)


def test_awkward_rows_and_labels(spark, docs_of, awkward):
    docs = docs_of(awkward).withColumnRenamed("lang", "score")
    for labels in ([], [(3, 1)], [(3, None), (0, 0), (1, 1)]):
        machine = fm.train(docs, spark.createDataFrame(labels, "doc_id long, label int"))
        rows = {r.doc_id: r.score for r in fm.score(docs, machine).collect()}
        assert len(rows) == len(awkward) and all(0 <= s <= 1 for s in rows.values()) and rows[3] == rows[4]
    assert fm.score(docs_of([]), machine).count() == 0


def test_one_class_scores_its_share(spark, docs_of):
    docs = docs_of(["a b", "c d"])
    machine = fm.train(docs, spark.createDataFrame([], "doc_id long, label int"))
    assert {r.score for r in fm.score(docs, machine).collect()} == {0.5}
