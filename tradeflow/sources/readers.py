"""File sources with declared schemas; the same function serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.schemas import BAR, TRADE


def read_files(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: T.StructType,
    stream: bool = False,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    name_glob: str | None = None,
    **options: object,
) -> DataFrame:
    """Files of one format. A stream can bound its micro-batches by file count or by bytes."""
    reader = (spark.readStream if stream else spark.read).schema(schema).format(fmt)
    limits = {"maxFilesPerTrigger": max_files_per_trigger, "maxBytesPerTrigger": max_bytes_per_trigger}
    settings = {**options, "pathGlobFilter": name_glob, **(limits if stream else {})}
    for name, value in settings.items():
        if value is not None:
            reader = reader.option(name, value)
    return reader.load(path)


def with_ingest_metadata(df: DataFrame, source_file: bool = True) -> DataFrame:
    """Add arrival time and, for file sources, the file each row came from."""
    df = df.withColumn("_ingested_at", F.current_timestamp())
    return df.withColumn("_source_file", F.col("_metadata.file_path")) if source_file else df


def read_trades_json(spark: SparkSession, path: str, stream: bool = False, **options: object) -> DataFrame:
    """Raw trades. Fields that do not parse as declared become NULL."""
    options.setdefault("mode", "PERMISSIVE")
    return with_ingest_metadata(read_files(spark, "json", path, TRADE, stream, **options))


def read_bars_csv(spark: SparkSession, path: str, stream: bool = False, **options: object) -> DataFrame:
    """Raw price bars from CSV files with a header."""
    return with_ingest_metadata(read_files(spark, "csv", path, BAR, stream, header=True, **options), False)


def read_trades_parquet(spark: SparkSession, path: str, stream: bool = True, **options: object) -> DataFrame:
    """Trades landed as parquet, rate-limited by files per micro-batch."""
    return read_files(spark, "parquet", path, TRADE, stream, **options)
