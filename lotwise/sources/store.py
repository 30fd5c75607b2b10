"""Writers and the stored tables of a market."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.operators.columns import ragged_union
from lotwise.operators.dedup import keep_first


# the CSV writer would trim fields by default
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def cleaned_path(input_path: str, out_dir: str) -> str:
    """``<out_dir>/cleaned_<input name>``"""
    return f"{out_dir.rstrip('/')}/cleaned_{os.path.basename(input_path.rstrip('/'))}"


def write_cleaned(df: DataFrame, input_path: str, out_dir: str, fmt: str = "parquet") -> str:
    path = cleaned_path(input_path, out_dir)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(**_CSV).csv(path)
    else:
        writer.parquet(path)
    return path


def append_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Append rows; every part file has its own header, so readers see one header per file.

    Raw listings are wide text. Files are packed; readers take whole files anyway, since fields may have line breaks.
    """
    df.write.mode("append").options(**_CSV, compression=compression).csv(path)


def write_ragged_csv(frames: Sequence[DataFrame], path: str) -> None:
    """Rows of frames with different columns under one sorted header; absent cells are empty."""
    ragged_union(frames).write.mode("overwrite").options(**_CSV).csv(path)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write Parquet and hand back a scan of it; a partitioned table keeps its other partitions."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(
    df: DataFrame, name: str, path: str, key: str, buckets: int, partition_by: str | None = None
) -> DataFrame:
    """Write a table bucketed and sorted by ``key``.

    Tables with the same number of buckets join on their keys without a shuffle. Rows are sent to
    their bucket first, so each bucket is one file and not one per task.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


#: rows that a bucket of a stored table is to have about
ROWS_PER_BUCKET = 1_000_000


def bucket_count(rows: int, least: int = 8) -> int:
    """A power of two, so that tables of different sizes have numbers of buckets that divide each other."""
    return max(least, 1 << max(0, -(-rows // ROWS_PER_BUCKET) - 1).bit_length())


_MANIFEST = (
    "name string, version bigint, path string, columns string, key string, buckets int, partition string, stored_at timestamp"
)


@dataclass(frozen=True)
class Written:
    """A table that is written but that nobody sees by its name yet."""

    df: DataFrame
    name: str
    path: str
    key: str | None
    buckets: int
    partition: str | None


class Versions:
    """Named tables below ``root``, each as its last complete load left it.

    A load writes its tables to folders of their own and then adds one row per table to a manifest, all rows in one
    file. Readers by name see the whole load or nothing of it; readers of an earlier version are not disturbed.
    Versions are numbered in the order of their loads. One load at a time may publish below a root.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def write(
        self, df: DataFrame, name: str, key: str | None = None, buckets: int = 0, partition_by: str | None = None
    ) -> Written:
        """Write a table without showing it. With ``buckets`` it is bucketed and sorted by ``key``."""
        mark = uuid.uuid4().hex
        path = f"{self.root}/{name}/{mark}"
        if buckets:
            found = write_bucketed(df, f"{name}_{mark}", path, key, buckets, partition_by)
        else:
            found = write_table(df, path, partition_by)
        return Written(found, name, path, key, buckets, partition_by)

    def publish(self, *tables: Written, now: datetime | None = None) -> int:
        """Show all ``tables`` at once, as the next version."""
        version = 1 + (self._manifest().agg(F.max("version")).first()[0] or 0)
        columns = [", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in t.df.schema) for t in tables]
        rows = [
            (t.name, version, t.path, c, t.key, t.buckets, t.partition, now or datetime.now())
            for t, c in zip(tables, columns)
        ]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return version

    def _manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _MANIFEST)

    def current(self, name: str, max_age: timedelta | None = None, now: datetime | None = None) -> DataFrame | None:
        """The last published version of a table; None when there is none or it is older than ``max_age``."""
        row = self._manifest().where(F.col("name") == name).orderBy(F.desc("version")).first()
        if row is None or (max_age is not None and (now or datetime.now()) - row["stored_at"] >= max_age):
            return None
        if not row["buckets"]:
            return self.spark.read.schema(row["columns"]).parquet(row["path"])
        table = f"{name}_{os.path.basename(row['path'])}"
        if not self.spark.catalog.tableExists(table):  # another session wrote it
            partitioned = f"PARTITIONED BY (`{row['partition']}`)" if row["partition"] else ""
            self.spark.sql(
                f"CREATE TABLE `{table}` ({row['columns']}) USING parquet {partitioned} "
                f"CLUSTERED BY (`{row['key']}`) SORTED BY (`{row['key']}`) INTO {row['buckets']} BUCKETS LOCATION '{row['path']}'"
            )
            if row["partition"]:
                self.spark.catalog.recoverPartitions(table)
        return self.spark.table(table)

    def cached(self, name: str, build: Callable[[], DataFrame], max_age: timedelta, now: datetime | None = None) -> DataFrame:
        """The stored table if it is younger than ``max_age``, else ``build()`` stored as its next version."""
        found = self.current(name, max_age, now)
        if found is not None:
            return found
        table = self.write(build(), name)
        self.publish(table, now=now)
        return table.df


def upsert(old: DataFrame, new: DataFrame, key: str, order: Sequence | None = None) -> DataFrame:
    """Old rows replaced or completed by new ones. ``order`` picks the winner among new rows of one key."""
    batch = keep_first(new, [key], order) if order else new
    batch = batch.select(*old.columns)
    return old.join(batch.select(key), key, "left_anti").select(*old.columns).unionByName(batch)


def store_version(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write ``df`` as the next version of a table and hand back a scan of it.

    ``df`` may be made from the current version of the same table, ``Versions(spark, root).current(name)``.
    """
    versions = Versions(df.sparkSession, root)
    table = versions.write(df, name)
    versions.publish(table)
    return table.df


def write_outputs(df: DataFrame, path: str) -> DataFrame:
    """Append raw model outputs ``(listing_id, raw_output)`` and hand back all that is stored there."""
    kept = df.select(F.col("listing_id").cast("bigint").alias("listing_id"), F.col("raw_output").cast("string").alias("raw_output"))
    kept.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(kept.schema).parquet(path)


def write_snapshot(df: DataFrame, root: str, now: datetime | None = None) -> str:
    """Write under ``run_ts=<yyyyMMdd_HHmmss>`` so that each run keeps its own copy."""
    stamp = (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{root.rstrip('/')}/run_ts={stamp}"
    df.write.mode("overwrite").options(**_CSV).csv(path)
    return path


def check_row_count(expected: DataFrame, written: DataFrame) -> None:
    """Compare row counts of what was to be written and what is stored."""
    counts = (
        expected.agg(F.count(F.lit(1)).alias("expected"))
        .select("expected", written.agg(F.count(F.lit(1)).alias("n")).scalar().alias("written"))
        .first()
    )
    if counts["expected"] != counts["written"]:
        raise RuntimeError(f"Inserted listings mismatch: written={counts['written']} rows={counts['expected']}")


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Stop when nothing is left to work on."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def table_or_empty(spark: SparkSession, df: DataFrame, schema) -> DataFrame:
    """The frame, or a typed empty one when it has no rows."""
    return spark.createDataFrame([], schema) if df.isEmpty() else df
