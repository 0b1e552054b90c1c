"""Versioned feature tables on plain parquet folders.

A table is a folder with ``version=N`` subfolders and an append-only manifest. Data is written
first and announced in the manifest afterwards, so readers never see a half-written version.
One writer per table is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.functions.scalar import utc_now
from tradeflow.session import cut_lineage

MANIFEST = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)
DEPLOYMENT = "model_version string, endpoint string, feature_version long, captured_at timestamp"


def _data_path(path: str, version: int) -> str:
    return f"{path}/data/version={version}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def history(spark: SparkSession, path: str) -> DataFrame:
    """All committed versions (an empty table before the first commit)."""
    if not _exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{path}/manifest")


def latest_version(spark: SparkSession, path: str) -> int | None:
    return history(spark, path).agg(F.max("version")).first()[0]


def _commit(spark: SparkSession, path: str, version: int, operation: str, rows: int) -> None:
    entry = spark.createDataFrame([(version, operation, rows)], "version long, operation string, rows long")
    entry.withColumn("committed_at", utc_now()).coalesce(1).write.mode("append").json(f"{path}/manifest")


def write_version(df: DataFrame, path: str, operation: str = "WRITE", stamp: bool = True) -> int:
    """Write ``df`` as the next version and return its number."""
    spark = df.sparkSession
    version = (latest_version(spark, path) if _exists(spark, f"{path}/manifest") else None)
    version = 0 if version is None else version + 1
    if stamp:
        df = df.withColumn("update_timestamp_utc", utc_now())
    # Overwrite clears what a failed earlier attempt at this number may have left.
    df.write.mode("overwrite").parquet(_data_path(path, version))
    # Parquet footers answer this count without reading the data back.
    rows = spark.read.parquet(_data_path(path, version)).count()
    _commit(spark, path, version, operation, rows)
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The given version, or the latest."""
    if version is None:
        version = latest_version(spark, path)
    known = history(spark, path).filter(F.col("version") == (-1 if version is None else version))
    if version is None or known.isEmpty():
        raise ValueError(f"{path} has no version {version}")
    return spark.read.parquet(_data_path(path, version))


def write_train_test(split: DataFrame, path: str) -> tuple[int, int]:
    """Store the rows of a split (column ``is_test``) as a pair of versioned tables, from one run of the split."""
    split = cut_lineage(split)
    train = write_version(split.filter(~F.col("is_test")).drop("is_test"), f"{path}/train_set")
    test = write_version(split.filter(F.col("is_test")).drop("is_test"), f"{path}/test_set")
    return train, test


def read_train_test(spark: SparkSession, path: str, versions: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    train, test = versions or (None, None)
    return read_version(spark, f"{path}/train_set", train), read_version(spark, f"{path}/test_set", test)


def capture_state(spark: SparkSession, features: str, log: str, model_version: str, endpoint: str) -> DataFrame:
    """Record which feature version is live with which model; returns the recorded row."""
    row = spark.createDataFrame(
        [(model_version, endpoint, latest_version(spark, features))],
        "model_version string, endpoint string, feature_version long",
    ).withColumn("captured_at", utc_now())
    row.coalesce(1).write.mode("append").json(log)
    return row


def captured_states(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(DEPLOYMENT).json(log).orderBy("captured_at")


def restore_version(spark: SparkSession, path: str, version: int) -> int:
    """Make an old version current by writing it forward as a new one."""
    return write_version(read_version(spark, path, version), path, operation=f"RESTORE {version}", stamp=False)


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-independent digest, both combined map-side."""
    row = F.xxhash64(*sorted(df.columns))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest_sum"),
        F.coalesce(F.bit_xor(row), F.lit(0)).alias("digest_xor"),
    )


def same_content(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows in any order."""
    return sorted(a.columns) == sorted(b.columns) and fingerprint(a).first() == fingerprint(b).first()


def verify_restore(spark: SparkSession, path: str, expected_version: int) -> bool:
    """Whether the current version holds exactly the rows of ``expected_version``."""
    return same_content(read_version(spark, path), read_version(spark, path, expected_version))
