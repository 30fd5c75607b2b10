"""Global ranks without a global sort or a one-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.session import scratch_path
from lotwise.sources.store import write_table

BLOCK_ROWS = 1_000_000
SPAN_BLOCKS = 4096


def with_global_rank(
    df: DataFrame, key: str, rank: str = "rank", block_width: int = BLOCK_ROWS, ties: Sequence[str] = ()
) -> DataFrame:
    """Add the 1-based rank of a BIGINT ``key`` over all rows; ``ties`` order rows of equal keys.

    Keys are cut into blocks of ``block_width`` consecutive values, so a block has at most that many
    distinct keys whatever the data. Rows are ranked inside their block; block sizes are summed up in order within
    spans of ``SPAN_BLOCKS`` blocks, and only the sums of spans in one task. Blocks depend on the key's value alone, so
    recomputed tasks give the same ranks.
    """
    blocks = df.withColumn("__block", F.floor(F.col(key) / F.lit(block_width)))
    sizes = blocks.groupBy("__block").agg(F.count(F.lit(1)).alias("__size"))
    # two levels: only the sums of many blocks each are put in order in one task
    sizes = sizes.withColumn("__span", F.floor(F.col("__block") / F.lit(SPAN_BLOCKS)))
    spans = sizes.groupBy("__span").agg(F.sum("__size").alias("__all"))
    earlier = Window.orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("__span", F.coalesce(F.sum("__all").over(earlier), F.lit(0)).alias("__start"))
    before = Window.partitionBy("__span").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.join(spans, "__span").select(
        "__block", (F.col("__start") + F.coalesce(F.sum("__size").over(before), F.lit(0))).alias("__offset")
    )
    inside = F.row_number().over(Window.partitionBy("__block").orderBy(key, *ties))
    return (
        blocks.join(offsets, "__block")
        .withColumn(rank, F.col("__offset") + inside.cast("bigint"))
        .drop("__block", "__offset")
    )


def assign_ids(
    df: DataFrame, base: int = 0, position: str = "row_pos", id_col: str = "id",
    block_width: int = BLOCK_ROWS, ties: Sequence[str] = (),
) -> DataFrame:
    """Give every row the id ``base + rank of its position`` (ids start at ``base + 1``)."""
    ranked = with_global_rank(df, position, id_col, block_width, ties)
    return ranked.withColumn(id_col, F.col(id_col) + F.lit(base).cast("bigint"))


#: rows that a range of sorted rows has about
ROWS_PER_RANGE = 1_000_000


def in_ranges(df: DataFrame, keys: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The rows in ranges of ``keys``, sorted, with the number ``__part`` of their range and their place ``__at`` in it.

    Both are written with the rows, so they stay what they are when a task is repeated. Ranges are cut where the rows
    are: neither a key that most rows share in part nor a value far from all others makes one much longer than
    ``rows_per_range`` (their bounds are sampled; rows that agree in all keys stay together).
    """
    spark = df.sparkSession
    kept = write_table(df, scratch_path(spark, "unordered"))
    ranges = 1 + kept.count() // rows_per_range
    placed = kept.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    placed = placed.withColumns({"__part": F.spark_partition_id(), "__at": place.bitwiseAND(F.lit((1 << 33) - 1))})
    return write_table(placed, scratch_path(spark, "ordered"))


def null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str], prefix: str) -> Column:
    """Equality of ``columns`` with those of ``right`` that carry ``prefix``; nulls are equal."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"{prefix}{c}"]) for c in columns])


def with_ordinal(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "ordinal", start: int = 1,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add each row's place among the rows with the same ``by``, in the order of ``order``, from ``start`` on.

    Keys may be texts, and one group may hold most of the rows: a group goes through a run of ranges, and a row's place
    is its place in its range plus what the ranges before it have of its group. Only such sums are put in order.
    """
    placed = in_ranges(df, [*by, *order], rows_per_range)
    runs = placed.groupBy("__part", *by).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(c).alias(f"__of_{c}") for c in ("__part", *by)], "__first",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
    )
    place = F.col("__before") + F.col("__at") - F.col("__first") + F.lit(start)
    joined = placed.join(runs, null_safe(placed, runs, ("__part", *by), "__of_"))
    return joined.withColumn(name, place.cast("bigint")).select(*df.columns, name)
