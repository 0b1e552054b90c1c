"""The end-to-end batch plan: feeds to clean trades, features, labels and training tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradeflow.operators.enrich import bronze_to_silver
from tradeflow.operators.features import anomaly_labels, gold_features
from tradeflow.operators.labels import contract_columns, stratified_split
from tradeflow.operators.quality import layer_flags, rule_report
from tradeflow.operators.snapshots import read_version, write_train_test, write_version
from tradeflow.schemas import REQUIRED_GOLD, REQUIRED_SILVER, require_columns
from tradeflow.sources.decode import all_trades
from tradeflow.sources.sinks import cluster_layout, write_table


@dataclass(frozen=True)
class Layers:
    """The stored tables, read back from where they were written."""

    silver: DataFrame
    gold: DataFrame
    report: DataFrame
    flags: DataFrame
    versions: tuple[int, int]


def run_medallion(
    spark: SparkSession, ticks: DataFrame, bars: DataFrame, folder: str, mode: str = "sma", test_size: float = 0.2
) -> Layers:
    """Write every layer below ``folder``.

    Each layer is stored before the next one reads it: the operators scan their input more than
    once, and a stored table is cheaper to scan than the whole chain before it.
    """
    bronze = all_trades(ticks, bars)
    silver_path, gold_path = f"{folder}/silver", f"{folder}/gold"
    write_table(cluster_layout(bronze_to_silver(bronze)), silver_path, mode="overwrite")
    silver = require_columns(spark.read.parquet(silver_path), REQUIRED_SILVER)

    write_table(gold_features(silver, mode=mode), gold_path, mode="overwrite")
    gold = require_columns(spark.read.parquet(gold_path), REQUIRED_GOLD)

    features = f"{folder}/trade_features"
    write_version(anomaly_labels(gold), features)
    labelled = contract_columns(read_version(spark, features), keep=["trade_id"])
    versions = write_train_test(stratified_split(labelled, test_size=test_size), folder)
    flags = layer_flags({"bronze": bronze, "silver": silver, "gold": gold})
    return Layers(silver, gold, rule_report(bronze), flags, versions)
