"""Quality rules (drop, fail, warn), their report, and the checks run over finished layers."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str  # drop | fail | warn

    def holds(self) -> Column:
        """A NULL predicate counts as a failure."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def silver_rules(allow_empty_symbol: bool = False) -> list[Rule]:
    symbol = "symbol IS NOT NULL" if allow_empty_symbol else "symbol IS NOT NULL AND symbol != ''"
    return [
        Rule("valid_price", "price > 0", "drop"),
        Rule("valid_symbol", symbol, "drop"),
        Rule("valid_timestamp", "timestamp IS NOT NULL", "fail"),
        Rule("valid_volume", "volume >= 0", "warn"),
    ]


def enforce(df: DataFrame, rules: list[Rule], observation: Observation | None = None) -> DataFrame:
    """Drop rows that fail a drop rule and abort on a failed fail rule.

    The failing check is part of the filter itself, so column pruning cannot remove it. With an
    ``observation``, warnings are counted while the job runs instead of in a second pass.
    """
    keep = [rule.holds() for rule in rules if rule.action == "drop"]
    fatal = [
        F.when(rule.holds(), F.lit(True)).otherwise(F.raise_error(F.lit(f"rule failed: {rule.name}")).cast("boolean"))
        for rule in rules
        if rule.action == "fail"
    ]
    checks = keep + fatal
    if checks:
        df = df.filter(reduce(lambda a, b: a & b, checks))
    warnings = [rule for rule in rules if rule.action == "warn"]
    if observation is not None and warnings:
        df = df.observe(observation, *[F.count_if(~rule.holds()).alias(rule.name) for rule in warnings])
    return df


def rule_report(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Passed and failed rows per rule, from one aggregation of ``df``."""
    rules = rules or silver_rules()
    totals = df.agg(
        F.count(F.lit(1)).alias("_all"), *[F.count_if(rule.holds()).alias(rule.name) for rule in rules]
    )
    entries = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.action).alias("action"),
            F.col(rule.name).alias("passed"),
            (F.col("_all") - F.col(rule.name)).alias("failed"),
        )
        for rule in rules
    ]
    return totals.select(F.inline(F.array(*entries)))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count per layer and whether it has any rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("ok", (F.col("row_count") > 0).cast("int"))


def layer_flags(layers: dict[str, DataFrame]) -> DataFrame:
    """One row: a 0/1 flag per layer."""
    counts = layer_counts(layers)
    return counts.agg(
        *[F.max(F.when(F.col("table_name") == name, F.col("ok"))).alias(f"{name}_ok") for name in layers]
    )


def duplicate_keys(df: DataFrame, key: str = "trade_id") -> DataFrame:
    """How many keys occur more than once."""
    repeated = df.groupBy(key).count().filter(F.col("count") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("duplicate_keys"))


def invalid_rows(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("price") <= 0).alias("invalid_price"),
        F.count_if(F.col("symbol").isNull() | (F.col("symbol") == "")).alias("invalid_symbol"),
        F.count_if(F.col("timestamp").isNull()).alias("invalid_timestamp"),
    )


def gold_completeness(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count_if(F.col("symbol").isNull() | F.col("timestamp").isNull()).alias("null_critical_features"),
        F.min("price_volatility_1h").alias("min_volatility"),
        F.max("price_volatility_1h").alias("max_volatility"),
        F.min("trade_intensity_1m").alias("min_intensity"),
        F.max("trade_intensity_1m").alias("max_intensity"),
    )


def freshness(bronze: DataFrame, silver: DataFrame, ingested: str, processed: str) -> DataFrame:
    """Newest arrival and newest processing time: each table is reduced to one row before they meet."""
    newest = bronze.agg(F.max(ingested).alias("latest_bronze_ingest"))
    done = silver.agg(F.max(processed).alias("latest_silver_process"))
    both = newest.unionByName(done, allowMissingColumns=True)
    return both.agg(
        F.max("latest_bronze_ingest").alias("latest_bronze_ingest"),
        F.max("latest_silver_process").alias("latest_silver_process"),
    )
