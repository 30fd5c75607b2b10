"""Scoring of whole tables of cars."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise import vocab as V
from lotwise.functions.text import strip
from lotwise.operators.training import PriceModel

Scorer = Callable[[DataFrame], DataFrame]


def subject_records(df: DataFrame, market: str) -> DataFrame:
    """Entered car data with derived flags. DE check boxes that were not set count as 0."""
    if market == "DE":
        boxes = [*V.CONDITION_TOGGLES, *V.EQUIPMENT_TOGGLES]
        return df.withColumns(
            {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0) for c in boxes}
        )
    usage = F.coalesce(F.lower("usage_type").contains("personal"), F.lit(False))
    derived = {
        "one_owner": (F.col("owner_count") == 1).cast("double"),
        "has_accidents": (F.col("accident_count") > 0).cast("double"),
        "is_used": F.lit(1.0), "is_cpo": F.lit(0.0), "is_online": F.lit(0.0), "is_wholesale": F.lit(0.0),
        "personal_use": usage.cast("double"),
    }
    return df.withColumns(derived)


def with_defaults(df: DataFrame, market: str) -> DataFrame:
    """Complete a short request (brand, model, age, mileage) with the market's default values."""
    filled = {
        c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v)
        for c, v in V.SCORE_DEFAULTS[market].items()
    }
    return df.withColumns({"brand": F.lower("brand"), "model": F.lower("model"), **filled})


def prepare(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], medians: Mapping[str, float] | None = None
) -> DataFrame:
    """Absent numbers are 0, missing ones the median of the training rows; categories are lower-cased and trimmed."""
    medians = medians or {}
    numbers = {
        c: F.coalesce(F.col(c).cast("double"), F.lit(float(medians.get(c) or 0.0))) if c in df.columns else F.lit(0.0)
        for c in numeric
    }
    texts = {c: strip(F.lower(c)) if c in df.columns else F.lit(None).cast("string") for c in categorical}
    return df.withColumns({**numbers, **texts})


def predict_prices(model: PriceModel, df: DataFrame) -> DataFrame:
    """Add ``features`` and ``prediction``."""
    scored = model.pipeline.transform(prepare(df, model.numeric, model.categorical, model.medians))
    return scored.drop(*[c for c in scored.columns if c.endswith(("__index", "__hot"))])


def scorer(model: PriceModel) -> Scorer:
    return lambda df: predict_prices(model, df).drop("features")


def unknown_categories(model: PriceModel | PipelineModel, df: DataFrame) -> DataFrame:
    """Rows per categorical column whose value the model, or its encoder, never saw; they score with zeros."""
    indexer = (model.pipeline if isinstance(model, PriceModel) else model).stages[0]
    sizes = {c: len(v) for c, v in zip(indexer.getInputCols(), indexer.labelsArray)}
    indexed = indexer.transform(prepare(df, [], list(sizes)))
    return indexed.agg(*[F.count_if(F.col(f"{c}__index") >= n).alias(c) for c, n in sizes.items()])


def depreciation(df: DataFrame, score: Scorer, key: str = "subject_id") -> DataFrame:
    """Price as new minus price at the given age and mileage: each row is scored twice, no row moves."""
    given = ("car_age", "mileage")
    rows = df.withColumns({f"__{c}": F.col(c).cast("double") for c in given})
    fresh = score(rows.withColumns({c: F.lit(0.0) for c in given})).withColumnRenamed("prediction", "price_new")
    used = score(fresh.withColumns({c: F.col(f"__{c}") for c in given})).withColumnRenamed("prediction", "price_used")
    return used.select(key, "price_new", "price_used", (F.col("price_new") - F.col("price_used")).alias("loss"))


def price_report(explained: DataFrame, market: str, key: str = "subject_id") -> DataFrame:
    """One JSON text per car: rounded price, currency, and all rounded contributions that ``explained`` lists."""
    entries = F.transform("contributions", lambda c: F.struct(c["feature"].alias("key"), F.round(c["contribution"], 2).alias("value")))
    impacts = F.map_from_entries(entries)
    return explained.select(
        key,
        F.to_json(
            F.struct(
                F.round("prediction", 2).alias("berechneter_preis"),
                F.lit(V.MARKET_DEFAULTS[market]["symbol"]).alias("waehrung"),
                impacts.alias("alle_preis_einflussfaktoren"),
            )
        ).alias("report"),
    )
