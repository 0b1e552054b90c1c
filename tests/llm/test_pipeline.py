import sys

import public_tokenizers

import __spark_entry__ as entry
import corpus_pipeline as cp
from tradeflow.llm import bpe, templates

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left, columns = docs, docs.columns
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, left, SF)
        assert out.columns == columns, name
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert 0 < len(ids) == out.count() and ids <= {r.doc_id for r in left.select("doc_id").collect()}
        left = spark.createDataFrame(out.collect(), docs.schema)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = cp.quality(spark, docs, SF)
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    assert sum(labels[i] == 1 for i in kept if i in labels) >= 0.98 * sum(labels.values())
    assert templates.contaminated(left.select("doc_id", "text"), spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    last = cp.STAGES[-1][1](spark, left, SF).collect()
    codec = bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text for r in left.collect()}
    assert all(codec.decode(r.ids).decode() == texts[r.doc_id] and r.round_trip for r in last) and len(last) == len(texts)


def test_stages_take_awkward_rows(spark, docs_of, awkward, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = docs_of([*awkward, "null id"], [*range(len(awkward)), None]).withColumnRenamed("source", "score")
    for name, stage in cp.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() > 0, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name


def test_registered_queries_and_absence_of_the_subpackage(monkeypatch):
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {x.split("_")[0] + "_" for x in names if x.startswith("op")} and "pipeline" in names
    monkeypatch.setitem(sys.modules, "tradeflow.llm", None)
    less = entry.queries()
    assert "gold_features" in less and not any(x.startswith("op") or x == "pipeline" for x in less)


def test_leaks_without_an_id_are_removed(spark, docs_of, tmp_path):
    item = "one two three four five six seven eight nine ten eleven twelve"
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    halves = ["one two three four five six seven eight", "x x x four five six seven eight nine ten eleven twelve"]
    docs = docs_of([f"so {item}", *halves, None, "clean", f"it is {item}", item, "other"], ids=[None] * 5 + [5, 6, 7])
    left = cp.decontaminate(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert {(r.doc_id, r.text) for r in left.collect()} == {(None, halves[0]), (None, halves[1]), (None, None), (None, "clean"), (7, "other")}
