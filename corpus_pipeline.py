"""From raw documents to token ids: reject bad texts, keep one of near copies, drop benchmark leaks, redact, encode.

Every stage takes ``(spark, docs, sf_dir)`` with ``docs`` as its predecessor left them, and all but the last return
the columns they got. The SQL of the whole is None: learnt scores and token ids have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm import bpe, chosen_path, pii_crf, quality_fm, templates
from tradeflow.llm.queries import PATTERN, RANKS, table
from tradeflow.llm.text import remainder
from tradeflow.session import fresh_path

#: Score from which a document is kept.
GOOD = 0.3
#: Words of a shingle and similarity in percent from which two documents count as copies.
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).filter(remainder("doc_id", 5) != 0)
    return quality_fm.keep_good(docs, quality_fm.train(docs, labels), GOOD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return chosen_path.keep_one_of_each(docs, SHINGLE, PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item; rows with a null id are told apart by their texts."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    key = F.when(F.col("doc_id").isNotNull(), F.concat(F.lit("i"), F.col("doc_id").cast("string"))).otherwise(F.concat(F.lit("t"), digest))
    keyed = docs.withColumn("__key", key)
    found = templates.contaminated(keyed.select(F.col("__key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    leaked = chosen_path.stored(found.select(F.col("doc_id").alias("__key")).distinct(), "leaked")
    return chosen_path.by_ids(keyed, leaked, "left_anti", "__key").drop("__key")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the new text."""
    clean = pii_crf.redact(docs, pii_crf.train())
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding."""
    return bpe.encode_and_verify(docs, RANKS, PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pii", redact),
    ("bpe", encode),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
