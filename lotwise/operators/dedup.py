"""Keep-first and full-row deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in the given order; null keys are equal to each other.

    The rank filter stands right on the window, so Spark puts a group limit before the shuffle: every
    task sends at most one row per key, however many copies a key has.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def top_rows(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], limit: int, rank: str
) -> DataFrame:
    """The first ``limit`` rows per key with their 1-based rank, limited before the shuffle too."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= limit)


def drop_copies(df: DataFrame, position: str | None = None) -> DataFrame:
    """One row per set of identical rows. ``position`` is not compared; its smallest value is kept."""
    if position is None or position not in df.columns:
        return df.dropDuplicates()
    columns = [c for c in df.columns if c != position]
    return df.groupBy(*columns).agg(F.min(position).alias(position)).select(*df.columns)
