"""Helpers that the operators on embedding vectors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def one_per_id(rows: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """An id names one vector: of rows that share one, the smallest by the other columns; rows with a null id stay.

    The vectors are shuffled only if there are repeated ids.
    """
    if rows.groupBy(id_col).count().filter(F.col(id_col).isNotNull() & (F.col("count") > 1)).isEmpty():
        return rows
    others = [c for c in rows.columns if c != id_col]
    known = rows.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(F.struct(*others)).alias("own")).select(id_col, "own.*")
    return known.select(*rows.columns).unionByName(rows.filter(F.col(id_col).isNull()))
