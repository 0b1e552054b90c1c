"""Adapters from the driver's generic tables to trades, bars, inference logs and scored labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def k_of_props() -> Column:
    """The ``k`` of the flat JSON text in ``props``; a pattern reads it far faster than a JSON parser."""
    return F.regexp_extract("props", '"k":\\s*([0-9]+)', 1).try_cast("int")


def _trade_columns() -> list[Column]:
    return [
        F.col("event_id").cast("string").alias("trade_id"),
        F.upper("event_type").alias("symbol"),
        F.col("value").alias("price"),
        (2 * k_of_props() * k_of_props()).cast("double").alias("volume"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit("US").alias("exchange"),
    ]


def trades_from_events(events: DataFrame) -> DataFrame:
    """Works on a batch or a streaming frame of the events table."""
    return events.select(*_trade_columns())


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(table(spark, sf_dir, "events"))


def dirty_from_events(events: DataFrame) -> DataFrame:
    """Trades with invalid prices and symbols, missing volumes and venues, and duplicates."""

    def every(n: int) -> Column:
        return F.col("event_id") % n == 0

    copies = F.when(every(50), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    raw = events.select("event_id", *_trade_columns(), F.explode(copies).alias("_copy"))
    return raw.select(
        "trade_id",
        F.when(every(89), F.lit(None).cast("string"))
        .when(every(83), F.lit(""))
        .otherwise(F.col("symbol"))
        .alias("symbol"),
        F.when(every(97), -F.col("price")).otherwise(F.col("price")).alias("price"),
        F.when(~every(79), F.col("volume")).alias("volume"),
        "timestamp",
        F.when(~every(7), F.col("exchange")).alias("exchange"),
    )


def dirty_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_from_events(table(spark, sf_dir, "events"))


def user_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades spread over many symbols (one per user)."""
    events = table(spark, sf_dir, "events")
    columns = [c for c in _trade_columns()]
    columns[1] = F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol")
    return events.select(*columns)


def tied_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trades: day-precision times (many ties) and ids that repeat."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trade_id"),
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("volume"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.lit("US").alias("exchange"),
    )


def bars(spark: SparkSession, sf_dir: str, interval: str = "1 hour") -> DataFrame:
    clean = trades(spark, sf_dir)
    return (
        clean.groupBy("symbol", F.window("timestamp", interval).alias("w"))
        .agg(
            F.min_by("price", "timestamp").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "timestamp").alias("close"),
            F.sum("volume").cast("bigint").alias("volume"),
        )
        .select("symbol", F.col("w.start").alias("timestamp"), "open", "high", "low", "close", "volume")
    )


def log_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.when(k_of_props() >= 50, "anomaly").otherwise("normal").alias("prediction"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("model_name"),
        F.col("value").alias("execution_duration_ms"),
        F.col("user_id").alias("key"),
    )


def inference_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_from_events(table(spark, sf_dir, "events"))


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a score that has many ties; one model per language."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return labels.join(documents, "doc_id").select(
        F.col("lang").alias("model"),
        ((F.col("n_chars") % 1000) / 1000).alias("score"),
        F.col("toxic").alias("y"),
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and outcomes of eight runs for each of five model types, derived from events."""
    events = table(spark, sf_dir, "events")
    run = F.col("user_id") % 8
    return events.select(
        F.col("event_type").alias("model_type"),
        F.concat_ws("-", F.col("event_type"), run.cast("string")).alias("run_id"),
        ((k_of_props() * (run + 3) + F.col("event_id") % 41) % 100 / 100).alias("score"),
        (k_of_props() >= 70).cast("int").alias("y"),
    )


def retraining_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups of one user group read as past retraining runs, other events as noise."""
    events = table(spark, sf_dir, "events")
    started = (F.col("event_type") == "signup") & (F.col("user_id") < 10)
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(started, "retraining_triggered").otherwise("checked").alias("event_type"),
        F.col("props").alias("details"),
    )
