"""Gold features on a stream, equal to the batch result.

Each micro-batch runs the batch operator over the new trades plus the last trades of every symbol
from the batches before it. What is carried is small (rows per symbol needed by the longest frame,
and trades that may still be overtaken by late ones) and lives in a folder per batch, so a repeated
batch starts from the same state and replaces its own output. Keyed Python state would run a busy
symbol in one task; here its trades are cut into blocks like in batch.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeflow.operators.ema import EMA_HISTORY
from tradeflow.operators.features import KEYS, ORDER, SMA_HISTORY, rolling_features
from tradeflow.streaming.pipeline import start_batches

_DONE = "_done"
_KEEP_STATES = 2
# Instants are microseconds, which no time zone can shift.
_PROGRESS = "late_rows long, horizon long, newest long"


class GoldStream:
    """Where a gold stream keeps its state and output, and how it turns a batch into features."""

    def __init__(
        self,
        folder: str,
        delay: timedelta = timedelta(minutes=2),
        mode: str = "sma",
        rows_per_block: int | None = None,
    ) -> None:
        self.folder = folder
        self.delay = delay
        self.mode = mode
        self.rows_per_block = rows_per_block
        self.history = EMA_HISTORY if mode == "ema" else SMA_HISTORY

    def start(self, silver: DataFrame, every: str | None = None) -> StreamingQuery:
        return start_batches(silver, self.on_batch, f"{self.folder}/checkpoint", every)

    def on_batch(self, batch: DataFrame, batch_id: int, final: bool = False) -> None:
        """Emit features of every trade that no on-time trade can precede any more."""
        spark = batch.sparkSession
        state, horizon, newest = self._state_before(spark, batch_id, batch)
        batch.persist()
        try:
            at = F.unix_micros("timestamp")
            is_late = F.lit(False) if horizon is None else at <= F.lit(horizon)
            seen = batch.agg(F.max(at).alias("newest"), F.count_if(is_late).alias("late_rows")).first()
            newest = max((t for t in (seen["newest"], newest) if t is not None), default=None)
            reach = newest if final or newest is None else newest - self.delay // timedelta(microseconds=1)
            horizon_now = max((t for t in (reach, horizon) if t is not None), default=None)

            known = state.unionByName(batch.filter(~is_late).withColumn(_DONE, F.lit(False)))
            ready = F.lit(False) if horizon_now is None else at <= F.lit(horizon_now)
            closed = known.filter(F.col(_DONE) | ready)

            features = rolling_features(closed, mode=self.mode, rows_per_block=self.rows_per_block)
            features.filter(~F.col(_DONE)).drop(_DONE).write.mode("overwrite").parquet(self._output(batch_id))

            newest_first = Window.partitionBy(*KEYS).orderBy(*[F.col(c).desc() for c in ORDER])
            recent = (
                closed.withColumn("_nth", F.row_number().over(newest_first))
                .filter(F.col("_nth") <= self.history)
                .drop("_nth")
                .withColumn(_DONE, F.lit(True))
            )
            waiting = known.filter(~F.col(_DONE) & ~ready)
            recent.unionByName(waiting).write.mode("overwrite").parquet(self._state(batch_id))
            row = [(seen["late_rows"], horizon_now, newest)]
            spark.createDataFrame(row, _PROGRESS).coalesce(1).write.mode("overwrite").parquet(self._progress(batch_id))
        finally:
            batch.unpersist()
        self._forget(spark, batch_id - _KEEP_STATES)

    def flush(self, spark: SparkSession) -> None:
        """Emit the trades still waiting for late ones, once the input has ended."""
        last = self._last_batch(spark)
        if last is not None:
            empty = spark.read.parquet(self._state(last)).drop(_DONE).limit(0)
            self.on_batch(empty, last + 1, final=True)

    def output(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", f"{self.folder}/features").parquet(f"{self.folder}/features/batch=*").drop(
            "batch"
        )

    def late_rows(self, spark: SparkSession) -> DataFrame:
        """Rows dropped for being older than what was already emitted, per batch."""
        return spark.read.parquet(f"{self.folder}/progress").select("batch", "late_rows")

    def _output(self, batch_id: int) -> str:
        return f"{self.folder}/features/batch={batch_id}"

    def _state(self, batch_id: int) -> str:
        return f"{self.folder}/state/batch={batch_id}"

    def _progress(self, batch_id: int) -> str:
        return f"{self.folder}/progress/batch={batch_id}"

    def _state_before(self, spark: SparkSession, batch_id: int, like: DataFrame):
        """Carried trades, the time up to which features are out, and the newest time seen."""
        if batch_id == 0:
            return like.withColumn(_DONE, F.lit(False)).limit(0), None, None
        before = spark.read.schema(_PROGRESS).parquet(self._progress(batch_id - 1)).first()
        state = spark.read.schema(like.withColumn(_DONE, F.lit(False)).schema).parquet(self._state(batch_id - 1))
        return state, before["horizon"], before["newest"]

    def _last_batch(self, spark: SparkSession) -> int | None:
        root = _path(spark, f"{self.folder}/progress")
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return None
        return max(int(s.getPath().getName().split("=")[1]) for s in files.listStatus(root))

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        old = _path(spark, self._state(batch_id))
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)
