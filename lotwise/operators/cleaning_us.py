"""Cleaning of flattened raw US listings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions import text as T
from lotwise.operators.columns import keep_existing
from lotwise.operators.dedup import drop_copies, keep_first
from lotwise.vocab import (
    MARKET_DEFAULTS, MISSING_WORDS, US_BOOLEAN, US_DEDUP_KEYS, US_KEEP, US_LOWER, US_NUMERIC,
    US_RENAMES, US_REQUIRED, US_TEXT, VIN_PATTERN,
)

ORDER = ("row_pos",)


def _vin(columns: Sequence[str]) -> Column:
    sources = [F.col(c) for c in ("vehicle_vin", "vin_raw") if c in columns]
    return T.valid_vin(F.coalesce(*sources), VIN_PATTERN) if sources else F.lit(None).cast("string")


def parse_us(df: DataFrame) -> DataFrame:
    """Typed columns from raw text, no row removed; absent columns stay absent."""
    df = df.withColumnsRenamed(US_RENAMES)
    typed: dict[str, Column] = {}
    if "created_at" in df.columns:
        typed["created_at"] = F.try_to_timestamp("created_at")
    typed.update({c: T.scrub_number(F.col(c)) for c in US_NUMERIC if c in df.columns})
    typed.update({c: T.word_to_boolean(F.col(c)) for c in US_BOOLEAN if c in df.columns})
    for c in US_TEXT:
        if c in df.columns:
            cleaned = T.clean_text(F.col(c), MISSING_WORDS)
            typed[c] = F.lower(cleaned) if c in US_LOWER else cleaned
    df = df.withColumns(typed)
    return df.withColumn("vin", _vin(df.columns)).drop("vehicle_vin", "vin_raw")


def valid_us(df: DataFrame) -> DataFrame:
    """Rows with the required fields inside the accepted ranges (all inclusive)."""
    conditions = [F.col(c).isNotNull() for c in US_REQUIRED if c in df.columns]
    conditions += [
        F.col("price_usd").between(500, 300000),
        F.col("mileage_mi").between(0, 400000),
        F.col("year").between(1990, 2026),
    ]
    for name, highest in (("owner_count", 15), ("accident_count", 20)):
        if name in df.columns:
            conditions.append(F.col(name).isNull() | F.col(name).between(0, highest))
    return df.where(reduce(lambda a, b: a & b, conditions))


def derive_us(df: DataFrame, as_of: str) -> DataFrame:
    """Ages and ratios as of a given UTC timestamp."""
    now = F.lit(as_of).cast("timestamp")
    columns = {
        "car_age": F.year(now) - F.col("year"),
        "price_per_mile": F.try_divide("price_usd", "mileage_mi"),
        "market": F.lit("US"),
        "source": F.lit(MARKET_DEFAULTS["US"]["source"]),
    }
    if "created_at" in df.columns:
        days = F.floor((F.unix_micros(now) - F.unix_micros("created_at")) / F.lit(86_400_000_000))
        # greatest() skips nulls, hence the guard
        columns["listing_age_days"] = F.when(
            F.col("created_at").isNotNull(), F.greatest(days, F.lit(0)).cast("bigint")
        )
    return df.withColumns(columns)


def dedup_us(df: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """First row per vin, price, mileage and year; rows without a vin compare equal on it."""
    keys = [c for c in US_DEDUP_KEYS if c in df.columns]
    return keep_first(df, keys, order) if len(keys) >= 2 else drop_copies(df, order[0])


def clean_us(df: DataFrame, as_of: str, order: Sequence[str] = ORDER, keep_order: bool = False) -> DataFrame:
    """Raw US text rows to the cleaned table in its fixed column order.

    Columns outside the fixed list go before the deduplication, so they are not shuffled.
    """
    derived = derive_us(valid_us(parse_us(df)), as_of)
    trimmed = keep_existing(derived, [*order, *US_KEEP])
    columns = [*order, *US_KEEP] if keep_order else US_KEEP
    return keep_existing(dedup_us(trimmed, order), columns)


def cleaning_report_us(df: DataFrame) -> DataFrame:
    """Row counts after each cleaning step, from a single aggregate."""
    parsed = parse_us(df)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in US_REQUIRED if c in parsed.columns])
    ranged = (
        complete
        & F.col("price_usd").between(500, 300000)
        & F.col("mileage_mi").between(0, 400000)
        & F.col("year").between(1990, 2026)
    )
    history = (
        ranged
        & (F.col("owner_count").isNull() | F.col("owner_count").between(0, 15))
        & (F.col("accident_count").isNull() | F.col("accident_count").between(0, 20))
    )
    return parsed.agg(
        F.count(F.lit(1)).alias("rows_raw"),
        F.count_if(complete).alias("rows_complete"),
        F.count_if(ranged).alias("rows_ranged"),
        F.count_if(history).alias("rows_valid"),
    )
