"""Cleaned rows to the parent table and its market-specific children."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.text import strip
from lotwise.operators.columns import column_or_null, rename_if_free, require_columns
from lotwise.vocab import DE_IMPORT_COLUMNS, MARKET_DEFAULTS

PARENT_COLUMNS = (
    "id", "dataset_id", "brand", "model", "title", "price", "currency", "mileage", "mileage_unit", "year",
    "registration", "location", "url", "source", "market",
)
US_DETAIL_TYPES = {
    "vin": "string", "make": "string", "model": "string", "trim": "string", "year": "int",
    "price_usd": "double", "mileage_mi": "double", "carfax_url": "string", "vdp_url": "string",
    "primary_image_url": "string", "dealer_name": "string", "city": "string", "state": "string",
    "zip_code": "string", "is_used": "boolean", "is_cpo": "boolean", "is_online": "boolean",
    "is_wholesale": "boolean", "accident_count": "double", "has_accidents": "boolean",
    "owner_count": "double", "one_owner": "boolean", "personal_use": "boolean", "usage_type": "string",
    "body_style": "string", "drivetrain": "string", "engine": "string", "cylinders": "double",
    "doors": "double", "seats": "double", "fuel": "string", "transmission": "string",
    "exterior_color": "string", "interior_color": "string", "car_age": "double", "price_per_mile": "double",
    "listing_age_days": "bigint", "location": "string",
}


def prepare_de(df: DataFrame) -> DataFrame:
    """The cleaned DE table with its link column normalised and its columns checked."""
    df = rename_if_free(df, "URL", "url")
    require_columns(df, DE_IMPORT_COLUMNS)
    return df


def _literals(market: str, dataset_id: int, overrides: dict[str, str]) -> dict[str, Column]:
    values = {**MARKET_DEFAULTS[market], **overrides}
    return {
        "dataset_id": F.lit(dataset_id).cast("int"),
        "market": F.lit(values.get("market", market)),
        "source": F.lit(values["source"]),
        "currency": F.lit(values["currency"]),
        "mileage_unit": F.lit(values["mileage_unit"]),
    }


def listings_de(df: DataFrame, dataset_id: int, **overrides: str) -> DataFrame:
    """Parent rows of cleaned DE rows that already carry their ``id``."""
    columns = {
        "id": F.col("id"),
        **_literals("DE", dataset_id, overrides),
        "brand": strip(F.lower("brand")),
        "model": strip(F.lower("model")),
        "title": F.col("title"),
        "price": F.col("price_eur").cast("double"),
        "mileage": F.col("mileage_km").cast("double"),
        "year": F.lit(None).cast("int"),
        "registration": F.col("registration"),
        "location": F.col("location"),
        "url": F.col("url"),
    }
    return df.select(*[columns[c].alias(c) for c in PARENT_COLUMNS])


def details_de(df: DataFrame) -> DataFrame:
    """Child rows of the same frame; the id ties both together, not the position."""
    return df.select(
        F.col("id").alias("listing_id"),
        "transmission",
        "fuel",
        F.col("owners").cast("int").alias("owners"),
        F.col("power_ps").cast("double").alias("power_ps"),
        F.col("car_age").cast("double").alias("car_age"),
        F.col("price_per_km").cast("double").alias("price_per_km"),
        F.col("Ausstattung").alias("ausstattung"),
        F.col("Beschreibung").alias("beschreibung"),
    )


def listings_us(df: DataFrame, dataset_id: int, **overrides: str) -> DataFrame:
    """Parent rows of cleaned US rows: brand is the make, no title, link of the detail page."""
    columns = {
        "id": F.col("id"),
        **_literals("US", dataset_id, overrides),
        "brand": column_or_null(df, "make", "string"),
        "model": column_or_null(df, "model", "string"),
        "title": F.lit(None).cast("string"),
        "price": column_or_null(df, "price_usd", "double"),
        "mileage": column_or_null(df, "mileage_mi", "double"),
        "year": column_or_null(df, "year", "int"),
        "registration": F.lit(None).cast("string"),
        "location": column_or_null(df, "location", "string"),
        "url": column_or_null(df, "vdp_url", "string"),
    }
    return df.select(*[columns[c].alias(c) for c in PARENT_COLUMNS])


def details_us(df: DataFrame) -> DataFrame:
    """Child rows of the same frame. The cleaned table has no location, so it stays null."""
    return df.select(
        F.col("id").alias("listing_id"),
        *[column_or_null(df, name, kind).alias(name) for name, kind in US_DETAIL_TYPES.items()],
    )
