"""Cleaning of raw DE listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions import text as T
from lotwise.operators.dedup import drop_copies
from lotwise.vocab import DE_AGE_ANCHOR, DE_FUELS, DE_RENAMES, DE_TRANSMISSIONS, MARKET_DEFAULTS

POSITION = "row_pos"


def parse_de(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Typed columns from raw text, no row removed. ``reg_date`` is a helper column."""
    df = df.withColumnsRenamed(DE_RENAMES)
    df = df.withColumns(
        {
            "price_eur": T.german_amount(F.col("price_eur")),
            "mileage_km": T.german_distance(F.col("mileage_km")),
            "power_ps": T.horse_power(F.col("power_ps")),
            "owners": T.first_digits(F.col("owners")).try_cast("double"),
            "transmission": T.map_words(F.col("transmission"), DE_TRANSMISSIONS),
            "fuel": T.map_words(F.col("fuel"), DE_FUELS),
            "title": T.strip(F.col("title")),
            "reg_date": T.month_year(F.col("year"), lenient),
        }
    )
    return df.withColumns(
        {
            "registration": F.date_format("reg_date", "MM/yyyy"),
            "brand": T.title_word(F.col("title"), 0),
            "model": T.title_word(F.col("title"), 1),
        }
    ).drop("year")


def valid_de(df: DataFrame) -> DataFrame:
    """Rows with price, mileage and registration inside the accepted ranges."""
    year = F.year("reg_date")
    return df.dropna(subset=["price_eur", "mileage_km", "registration"]).where(
        (F.col("price_eur") > 500) & (F.col("price_eur") < 200000)
        & (F.col("mileage_km") >= 0) & (F.col("mileage_km") < 300000)
        & (year > 1990) & (year <= 2026)
    )


def derive_de(df: DataFrame, anchor: str = DE_AGE_ANCHOR) -> DataFrame:
    meta = MARKET_DEFAULTS["DE"]
    return df.withColumns(
        {
            "car_age": F.datediff(F.lit(anchor).cast("date"), F.col("reg_date")) / F.lit(365),
            "price_per_km": F.try_divide("price_eur", "mileage_km"),
            "market": F.lit("DE"),
            "source": F.lit(meta["source"]),
        }
    ).drop("reg_date")


def clean_de(df: DataFrame, anchor: str = DE_AGE_ANCHOR, lenient: bool = False) -> DataFrame:
    """Raw DE text rows to the cleaned table.

    Everything but the final deduplication is one narrow stage; invalid rows are gone before the
    shuffle. ``row_pos``, when present, is carried along and does not count in the comparison.
    """
    return drop_copies(derive_de(valid_de(parse_de(df, lenient)), anchor), POSITION)


def cleaning_report_de(df: DataFrame) -> DataFrame:
    """Row counts after each cleaning step, from a single aggregate."""
    parsed = parse_de(df)
    year = F.year("reg_date")
    complete = (
        F.col("price_eur").isNotNull() & F.col("mileage_km").isNotNull() & F.col("registration").isNotNull()
    )
    price = complete & (F.col("price_eur") > 500) & (F.col("price_eur") < 200000)
    mileage = price & (F.col("mileage_km") >= 0) & (F.col("mileage_km") < 300000)
    dated = mileage & (year > 1990) & (year <= 2026)
    return parsed.agg(
        F.count(F.lit(1)).alias("rows_raw"),
        F.count_if(complete).alias("rows_complete"),
        F.count_if(price).alias("rows_price"),
        F.count_if(mileage).alias("rows_mileage"),
        F.count_if(dated).alias("rows_valid"),
    )
