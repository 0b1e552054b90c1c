"""Streaming bronze to silver and streaming monitoring. The column logic is the batch logic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeflow.operators.enrich import enrich, typed
from tradeflow.operators.monitoring import batch_quality, inference_profile
from tradeflow.operators.quality import enforce, silver_rules
from tradeflow.sources.decode import bars_to_trades
from tradeflow.sources.sinks import start_append

WATERMARK = "2 minutes"


def silver_stream(
    bronze: DataFrame,
    watermark: str = WATERMARK,
    session: str = "utc",
    allow_empty_symbol: bool = False,
    stamp: bool = True,
) -> DataFrame:
    """Cast, filter, de-duplicate within the watermark, enrich.

    The watermark comes before the de-duplication, so the set of remembered keys is bounded: a key is
    forgotten once the watermark passes it, and rows older than the watermark are dropped.
    """
    valid = enforce(typed(bronze), silver_rules(allow_empty_symbol)).withWatermark("timestamp", watermark)
    silver = enrich(valid.dropDuplicatesWithinWatermark(["trade_id"]), session)
    return silver.withColumn("_processed_at", F.current_timestamp()) if stamp else silver


def union_sources(ticks: DataFrame, bars: DataFrame) -> DataFrame:
    """Two streams as one; the global watermark follows the slower of the two."""
    mapped = bars_to_trades(bars)
    return ticks.select(*mapped.columns).unionByName(mapped)


def profile_stream(log: DataFrame, granularity: str = "30 minutes", watermark: str = WATERMARK) -> DataFrame:
    """Predictions per model and window; a window is emitted once the watermark has passed its end."""
    return inference_profile(log, granularity, watermark)


def start_with_quality(
    stream: DataFrame, data_path: str, quality_path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write each micro-batch together with one row of quality metrics.

    Both writes go to a folder named after the batch and replace it, so a repeated batch after a
    failure leaves no duplicates.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{data_path}/batch={batch_id}")
            batch_quality(batch, batch_id).write.mode("overwrite").json(f"{quality_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return start_batches(stream, on_batch, checkpoint, every)


def start_batches(
    stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def run_to_end(stream: DataFrame, folder: str) -> DataFrame:
    """Process all available input into ``folder`` and return what was written."""
    spark: SparkSession = stream.sparkSession
    query = start_append(stream, checkpoint=f"{folder}/checkpoint", path=f"{folder}/data")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/data")
