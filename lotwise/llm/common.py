"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared one and read it back: lineage ends here, on shared storage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def residue(key: Column, divisor: int) -> Column:
    """crc32 of a key written as text, modulo ``divisor``; null stays null."""
    return (F.crc32(key.cast("string").cast("binary")) % divisor).cast("int")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def hex_digest(c: Column) -> Column:
    """Lower-case hex SHA-256 of a text's UTF-8 bytes, or of bytes."""
    return F.sha2(c.cast("binary"), 256)


def text_slices(batch: pa.RecordBatch, column: int, chars: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices whose texts have about ``chars`` bytes, one row at least; bounds a worker's memory."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    slot = (np.cumsum(sizes) - sizes) // chars
    cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)
