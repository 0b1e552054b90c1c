"""Gold features on a stream with the symbols' history in Spark's own state.

A stateful processor keeps, for each symbol, the trades that still wait for late ones and the last trades that are out; a timer
in event time wakes a symbol once the watermark passes its first waiting trade. Only symbols with new or ripe trades are
touched, whatever the number of symbols, and state is versioned, cleaned up and restored by Spark with the query's checkpoint.
What ripens leaves together with the trades before it, and the batch operator computes the features of each micro-batch, so they
equal the batch result by construction and a busy symbol's features are computed in blocks by many tasks.

The processor itself only keeps and hands on, in packed columns: it sees all trades of a symbol in a micro-batch in one task, one
piece of at most an Arrow batch at a time, and looks into a piece once, when the watermark has reached it.
Where one symbol fills whole micro-batches, bound them (``row_stream``), or use ``GoldStream``, which has no keyed step.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from tradeflow.operators.ema import EMA_HISTORY
from tradeflow.operators.features import KEYS, SMA_HISTORY, rolling_features
from tradeflow.streaming.pipeline import start_batches

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# A piece's first and last instant, its name, and its rows as packed columns.
_PIECE, _PACKED = "low long, high long, name string", "rows binary"
# Spark hands rows over as named tuples, whose names cannot start with an underscore.
_DONE, _AT = "_done", "at_micros"


class _Waiting(StatefulProcessor):
    """Holds trades until the watermark has passed them; hands them on after the ``history`` trades before them."""

    def __init__(self, history: int, columns: list[str], id_col: str) -> None:
        self.history, self.columns, self.id_col = history, columns, id_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", _PIECE, _PACKED)
        self.recent = handle.getListState("recent", _PACKED)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            if not part.empty:
                low = self._hold(part)
                first = low if first is None else min(low, first)
        if first is not None:
            self.handle.registerTimer(_ripe(first))
        yield from ()

    def _hold(self, part: pd.DataFrame) -> int:
        """Keeps a piece; its first instant."""
        at = part[_AT].to_numpy(np.int64)
        low, high = int(at.min()), int(at.max())
        self.waiting.updateValue((low, high, uuid.uuid4().hex), (_packed(part, [_AT, *self.columns]),))
        return low

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        pieces = sorted(tuple(piece) for piece in self.waiting.keys()) if self.waiting.exists() else []
        ripe, later = [p for p in pieces if p[0] <= now], [p[0] for p in pieces if p[0] > now]
        if not ripe:
            return
        held = [_unpacked(bytes(x[0]), [_AT, *self.columns]) for x in self.recent.get()] if self.recent.exists() else []
        last = held[0] if held else None
        if last is not None:
            yield last[self.columns].assign(**{_DONE: True})
        for piece in ripe:
            part = _unpacked(bytes(self.waiting.getValue(piece)[0]), [_AT, *self.columns])
            self.waiting.removeKey(piece)
            out = part[_AT].to_numpy(np.int64) <= now
            if not out.all():
                later.append(self._hold(part[~out]))
                part = part[out]
            last = self._newest(part if last is None else pd.concat([last, part], ignore_index=True))
            yield part[self.columns].assign(**{_DONE: False})
        self.recent.put([(_packed(last, [_AT, *self.columns]),)])
        if later:
            self.handle.registerTimer(_ripe(min(later)))

    def _newest(self, rows: pd.DataFrame) -> pd.DataFrame:
        """The last ``history`` rows, in order; equal times are ordered by id."""
        if len(rows) > self.history:
            at = rows[_AT].to_numpy(np.int64)
            rows = rows[at >= np.partition(at, -self.history)[-self.history]]
        order = sorted(range(len(rows)), key=list(zip(rows[_AT], rows[self.id_col].astype(str), strict=True)).__getitem__)
        return rows.iloc[order[-self.history :]]

    def close(self) -> None:
        pass


@contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """List state needs this store; the session's own setting comes back afterwards (a running query keeps what it started with)."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _ripe(at: int) -> int:
    """The first millisecond at which a trade of this microsecond is certainly past."""
    return -(-at // 1000)


def _packed(rows: pd.DataFrame, columns: list[str]) -> bytes:
    return pickle.dumps([rows[c].to_numpy() for c in columns], protocol=5)


def _unpacked(packed: bytes, columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(columns, pickle.loads(packed), strict=True)), columns=columns)


class KeyedGoldStream:
    """A gold stream below ``folder``; ``delay`` is how late trades may come."""

    def __init__(self, folder: str, delay: timedelta = timedelta(minutes=2), mode: str = "sma", rows_per_block: int | None = None) -> None:
        self.folder, self.delay, self.mode, self.rows_per_block = folder, delay, mode, rows_per_block
        self.history = EMA_HISTORY if mode == "ema" else SMA_HISTORY
        self.schema: StructType | None = None

    def start(self, silver: DataFrame, every: str | None = None) -> StreamingQuery:
        spark = silver.sparkSession
        self.schema = silver.schema
        out = StructType([*silver.schema, *StructType.fromDDL(f"{_DONE} boolean")])
        marked = silver.withColumn(_AT, F.unix_micros("timestamp")).withWatermark("timestamp", f"{self.delay // timedelta(milliseconds=1)} milliseconds")
        processor = _Waiting(self.history, silver.columns, "trade_id")
        ripe = marked.groupBy(*KEYS).transformWithStateInPandas(processor, outputStructType=out, outputMode="append", timeMode="eventTime")
        with _rocks(spark):
            return start_batches(ripe, self._on_batch, f"{self.folder}/checkpoint", every)

    def _on_batch(self, batch: DataFrame, batch_id: int | str) -> None:
        """Features of the trades that have ripened; a repeated batch replaces its own output."""
        # The batch comes in one partition for a symbol.
        batch = batch.repartition(2 * batch.sparkSession.sparkContext.defaultParallelism).persist()
        try:
            features = rolling_features(batch, mode=self.mode, rows_per_block=self.rows_per_block)
            features.filter(~F.col(_DONE)).drop(_DONE).write.mode("overwrite").parquet(f"{self.folder}/features/batch={batch_id}")
        finally:
            batch.unpersist()

    def flush(self, spark: SparkSession) -> None:
        """Emit the trades still waiting for late ones, once the input has ended and the query has stopped."""
        with _rocks(spark):
            waiting, recent = self._state(spark, "waiting", "user_map_value.rows", False), self._state(spark, "recent", "list_element.rows", True)
            touched = waiting.select(*KEYS).distinct()
            self._on_batch(waiting.unionByName(recent.join(touched, list(KEYS), "left_semi")), "last")

    def _state(self, spark: SparkSession, name: str, packed: str, done: bool) -> DataFrame:
        """The rows of one of the processor's variables, as of the last batch."""
        columns, schema = self.schema.names, StructType([*self.schema, *StructType.fromDDL(f"{_DONE} boolean")])
        stored = spark.read.format("statestore").option("path", f"{self.folder}/checkpoint").option("stateVarName", name).load()

        def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for rows in batch["rows"]:
                    yield _unpacked(bytes(rows), [_AT, *columns])[columns].assign(**{_DONE: done})

        return stored.select(F.col(packed).alias("rows")).mapInPandas(unpack, schema)

    def output(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", f"{self.folder}/features").parquet(f"{self.folder}/features/batch=*").drop("batch")
