"""Column plumbing shared by the cleaning, loading and market jobs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns in input: {missing}")


def rename_if_free(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename only when the new name is not taken."""
    return df.withColumnRenamed(old, new) if old in df.columns and new not in df.columns else df


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def keep_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed column order, limited to what is there."""
    return df.select(*[c for c in columns if c in df.columns])


def fill_absent(df: DataFrame, columns: Iterable[str], value: object) -> DataFrame:
    """Add absent columns with one literal."""
    return df.withColumns({c: F.lit(value) for c in columns if c not in df.columns})


def ragged_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames under the sorted union of their columns; absent cells are null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result.select(*[F.col(f"`{c}`") for c in sorted(result.columns)])


def column_or_null(df: DataFrame, name: str, data_type: str) -> Column:
    return F.col(name).cast(data_type) if name in df.columns else F.lit(None).cast(data_type)
