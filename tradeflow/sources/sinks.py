"""Batch and streaming sinks on plain Spark tables or paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradeflow.functions.scalar import utc_now
from tradeflow.functions.search import with_upper_bound
from tradeflow.operators.blocks import row_numbers
from tradeflow.session import cut_lineage

#: Distinct texts up to which their ranks are broadcast.
MAX_TEXTS_TO_BROADCAST = 500_000


def write_table(
    df: DataFrame, path: str | None = None, table: str | None = None, mode: str = "append", stamp: bool = False
) -> None:
    """Write parquet to a path or a named table; ``stamp`` adds ``update_timestamp_utc``."""
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table name")
    if stamp:
        df = df.withColumn("update_timestamp_utc", utc_now())
    writer = df.write.mode(mode).format("parquet")
    writer.save(path) if path else writer.saveAsTable(table)


def append_bars(bars: DataFrame, path: str | None = None, table: str | None = None) -> bool:
    """Append bars; an empty input writes nothing and returns False."""
    if bars.isEmpty():
        return False
    write_table(bars, path, table, mode="append")
    return True


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def cluster_layout(df: DataFrame, *by: str, partitions: int | None = None) -> DataFrame:
    """Range layout for storage: neighbours in ``by`` share files, so min/max statistics prune scans.

    Ranges are cut over all of ``by``, so a key with very many rows spreads over several files.
    """
    by = by or ("symbol", "timestamp")
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


def _cells(df: DataFrame, column: str, bits: int, name: str) -> DataFrame:
    """Add ``name``: which of ``2 ** bits`` equal shares of the column's order a value lies in; NULL is in the first.

    Numbers and times are cut at approximate quantiles. Texts are ranked among the distinct ones, so a text is in one share.
    """
    shares = 2**bits
    if isinstance(df.schema[column].dataType, T.StringType):
        texts = cut_lineage(df.select(column).filter(F.col(column).isNotNull()).distinct())
        ranks = cut_lineage(row_numbers(texts, [], [column], "_rank"))
        total = ranks.count()
        placed = ranks.select(column, F.floor((F.col("_rank") - 1) * shares / max(total, 1)).cast("int").alias(name))
        placed = F.broadcast(placed) if total <= MAX_TEXTS_TO_BROADCAST else placed
        return df.join(placed, column, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    number = (F.unix_micros(column) if isinstance(df.schema[column].dataType, T.TimestampType) else F.col(column)).cast("double")
    wanted = F.array(*[F.lit(k / shares) for k in range(1, shares)])
    edges = df.agg(F.array_sort(F.percentile_approx(number, wanted, 20 * shares))).first()[0] or []  # one number a share
    return with_upper_bound(df.withColumn("_edges", F.array(*map(F.lit, edges)).cast("array<double>")), name, "_edges", number, shares).drop("_edges")


def zorder_layout(df: DataFrame, *by: str, bits: int = 8, partitions: int | None = None) -> DataFrame:
    """Layout along a z-curve over the given columns (``symbol`` and ``timestamp``): filters on any one of them skip files and row groups.

    The bits of the columns' shares are interleaved, and rows are dealt in ranges of the result and then of the columns, so
    a value with very many rows still spreads over several files. ``df`` is read once for each column more.
    """
    by = by or ("symbol", "timestamp")
    placed, names = df, [f"_z{k}" for k in range(len(by))]
    for column, name in zip(by, names, strict=True):
        placed = _cells(placed, column, bits, name)
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for k, name in enumerate(names):
            one = F.shiftright(F.col(name), bit).bitwiseAND(F.lit(1)).cast("long")
            z = z.bitwiseOR(F.shiftleft(one, bit * len(by) + len(by) - 1 - k))
    placed = placed.withColumn("_z", z)
    ranged = placed.repartitionByRange(partitions, "_z", *by) if partitions else placed.repartitionByRange("_z", *by)
    return ranged.sortWithinPartitions("_z", *by).select(*df.columns)


def start_append(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start an append sink: every ``every`` (say ``"30 seconds"``), or once over all that is available."""
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table name")
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.toTable(table)
