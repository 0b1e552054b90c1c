"""Ordered search inside an array column, compiled into the surrounding stage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FAN = 4


def with_upper_bound(df: DataFrame, name: str, sorted_array: str, key: Column, max_size: int) -> DataFrame:
    """Add ``name``: how many elements of ``sorted_array`` are <= ``key`` (0 when the array is NULL).

    A search with ``_FAN - 1`` probes per level. Each level is a projection of plain comparisons, so
    all of them run inside one generated loop, unlike a fold over a lambda. ``max_size`` bounds the
    array length. Keys may be structs, which compare field by field.
    """
    probe_key = f"_{name}_key"
    df = df.withColumn(probe_key, key).withColumn(name, F.lit(0))
    stride = 1
    while stride * _FAN <= max_size:
        stride *= _FAN
    while stride:
        at = F.col(name)
        hits = [
            # A probe past the end reads NULL and counts as a miss.
            F.coalesce((F.get(F.col(sorted_array), at + (i * stride - 1)) <= F.col(probe_key)).cast("int"), F.lit(0))
            for i in range(1, _FAN)
        ]
        df = df.withColumn(name, at + reduce(lambda a, b: a + b, hits) * stride)
        stride //= _FAN
    return df.drop(probe_key)
