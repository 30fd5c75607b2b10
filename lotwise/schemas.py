"""Explicit schemas; nothing is inferred from text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as t

from lotwise.vocab import DE_RAW_COLUMNS, US_BOOLEAN, US_KEEP, US_NUMERIC, US_RENAMES


def text_schema(columns: Iterable[str]) -> t.StructType:
    return t.StructType([t.StructField(c, t.StringType()) for c in columns])


RAW_DE = text_schema(DE_RAW_COLUMNS)
RAW_US = text_schema(US_RENAMES)


def _cleaned_us_type(name: str) -> t.DataType:
    if name in US_BOOLEAN:
        return t.BooleanType()
    if name in US_NUMERIC or name in ("car_age", "price_per_mile"):
        return t.DoubleType()
    if name == "listing_age_days":
        return t.LongType()
    return t.TimestampType() if name == "created_at" else t.StringType()


CLEANED_US = t.StructType([t.StructField(c, _cleaned_us_type(c)) for c in US_KEEP])
CLEANED_DE = t.StructType(
    [
        t.StructField(c, t.DoubleType() if c in ("price_eur", "mileage_km", "power_ps", "owners", "car_age",
                                                 "price_per_km") else t.StringType())
        for c in (
            "title", "price_eur", "mileage_km", "power_ps", "transmission", "fuel", "owners", "location", "URL",
            "Ausstattung", "Beschreibung", "registration", "brand", "model", "car_age", "price_per_km", "market",
            "source",
        )
    ]
)
EMPTY_VIEW = t.StructType(
    [
        t.StructField(c, t.DoubleType() if c in ("price", "mileage") else t.StringType())
        for c in ("brand", "model", "title", "price", "mileage", "location", "url")
    ]
)
