"""Exact medians that no single task has to hold a whole group for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.operators.ranking import ROWS_PER_RANGE, in_ranges, null_safe


def grouped_median(
    df: DataFrame, by: Sequence[str], value: str, name: str = "median", keep_empty: bool = False,
    values_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Exact median of ``value`` per group; nulls are ignored, a group without values is absent (null with ``keep_empty``).

    1. Equal values are counted before anything is shuffled, so a hot value is one row per task.
    2. The distinct values are sorted in ranges of (group, value) that are cut where the values are. A group, however
       large, goes through a run of ranges; sums per group and range tell which range holds its middle ranks.
    3. Only these ranges, one or two per group, are looked into. No task holds more than a range, about
       ``values_per_range`` distinct values, whatever the group's size and however far its outliers lie.
    """
    by = list(by)
    number = F.col(value).cast("double").alias("__v")
    rows = df if keep_empty else df.where(F.col(value).isNotNull())
    counts = rows.groupBy(*by, number).agg(F.count(value).alias("__n"))
    placed = in_ranges(counts, [*by, "__v"], values_per_range)
    sums = placed.groupBy("__part", *by).agg(F.sum("__n").alias("__size"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({
        "__before": F.coalesce(F.sum("__size").over(earlier), F.lit(0)), "__total": F.sum("__size").over(group)
    })
    low_rank, high_rank = F.floor((F.col("__total") + 1) / 2), F.floor((F.col("__total") + 2) / 2)
    chosen = sums.where(_covers(low_rank) | _covers(high_rank) | (F.col("__total") == 0)).select(
        *[F.col(c).alias(f"__g_{c}") for c in ("__part", *by)], "__before", "__total"
    )
    inside = Window.partitionBy("__part", *by).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    ordered = placed.join(chosen, null_safe(placed, chosen, ("__part", *by), "__g_")).withColumns({
        "__before": F.col("__before") + F.coalesce(F.sum("__n").over(inside), F.lit(0)), "__size": F.col("__n")
    })
    low, high = (F.max(F.when(_covers(rank), F.col("__v"))) for rank in (low_rank, high_rank))
    return ordered.groupBy(*by).agg(((low + high) / 2).alias(name))


def _covers(rank: Column) -> Column:
    return (F.col("__before") < rank) & (F.col("__before") + F.col("__size") >= rank)


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact medians of several columns in one pass, as rows ``(column, median)``."""
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
        ).alias("p")
    ).select("p.column", "p.v")
    return grouped_median(pairs, ["column"], "v", "median")
