"""Prompts, responses and the features of equipment documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import vocab as V
from lotwise.functions.documents import is_json, leaf_pairs

DEFAULT_TEMPLATE = """Lies die folgende Fahrzeugbeschreibung und gib genau ein JSON-Objekt zurück.
Schlüssel zum Zustand: TÜV, Scheckheft, Bereifung, Garantie (Monate), Unfallfrei, Mängel.
Schlüssel zur Ausstattung: Distronic, Multibeam, Klimaautomatik, Burmester, AMG Line, Panorama.
Text:
{text}
"""


def prompt_candidates(
    listings: DataFrame, details: DataFrame, low: int | None = None, high: int | None = None
) -> DataFrame:
    """DE listings with a description, optionally within an id range (both ends included)."""
    if "market" in listings.columns:
        listings = listings.where(F.col("market") == "DE")
    rows = listings.select("id").join(
        details.select(F.col("listing_id").alias("id"), "beschreibung").where(F.col("beschreibung").isNotNull()), "id"
    )
    if low is not None:
        rows = rows.where(F.col("id") >= low)
    return rows if high is None else rows.where(F.col("id") <= high)


def build_prompts(df: DataFrame, template: str = DEFAULT_TEMPLATE, text: str = "beschreibung") -> DataFrame:
    """Put each description into the template's ``{text}`` place."""
    head, _, tail = template.partition("{text}")
    return df.withColumn("prompt", F.concat(F.lit(head), F.col(text), F.lit(tail)))


def cut_response(c: Column) -> Column:
    """The text from the first ``{`` to the last ``}``, null unless it is a JSON object."""
    cut = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.when(is_json(cut), cut)


def parse_responses(df: DataFrame, raw: str = "raw_output") -> DataFrame:
    """Model responses ``(listing_id, raw_output)`` to ``(listing_id, ai_features)``."""
    return df.select("listing_id", cut_response(F.col(raw)).alias("ai_features"))


def with_pairs(df: DataFrame, document: str = "ai_features") -> DataFrame:
    """Add the ordered leaf list; the only Python step of the feature job."""
    return df.withColumn("kv", leaf_pairs(F.col(document)))


def _has_any(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def _value_for(keys: Sequence[str]) -> Column:
    hits = F.filter("kv", lambda p: _has_any(p["key"], keys))
    return F.coalesce(F.get(hits, F.lit(0))["value"], F.lit(""))


def _flag(condition: Column) -> Column:
    # null pairs mean "no object": the feature is null, not zero
    return F.when(F.col("kv").isNotNull(), condition.cast("int"))


def condition_features() -> dict[str, Column]:
    tyres = _value_for(V.TYRE_KEYS)
    accident = _value_for(V.ACCIDENT_KEYS)
    defect = _value_for(V.DEFECT_KEYS)
    months = F.regexp_extract(_value_for(V.WARRANTY_KEYS), r"(\d+)", 1).try_cast("int")
    return {
        "tuv_neu": _flag(_has_any(_value_for(V.INSPECTION_KEYS), V.INSPECTION_WORDS)),
        "scheckheft_gepflegt": _flag(_has_any(_value_for(V.SERVICE_KEYS), V.SERVICE_WORDS)),
        "bereifung_8_fach": _flag(_has_any(tyres, V.EIGHT_TYRE_WORDS)),
        "bereifung_allwetter": _flag(
            _has_any(F.concat(tyres, _value_for(V.ALL_WEATHER_KEYS)), V.ALL_WEATHER_WORDS)
        ),
        "garantie_monate": F.when(F.col("kv").isNotNull(), F.coalesce(months, F.lit(0))),
        "unfallfrei": _flag(
            ~_has_any(accident, V.ACCIDENT_WORDS) & _has_any(accident, V.ACCIDENT_FREE_WORDS)
        ),
        "mangel_vorhanden": _flag(
            ~(defect.contains(V.NO_DEFECT_WORD) | defect.isin(*V.NO_DEFECT_VALUES))
        ),
    }


def equipment_features() -> dict[str, Column]:
    def present(words: Sequence[str]) -> Column:
        return F.exists(
            "kv",
            lambda p: (_has_any(p["key"], words) | _has_any(p["value"], words))
            & ~p["value"].isin(*V.NEGATIVE_VALUES),
        )

    return {name: _flag(present(words)) for name, words in V.EQUIPMENT_WORDS.items()}


def document_features(df: DataFrame, document: str = "ai_features") -> DataFrame:
    """``(listing_id, 15 features)``; documents that are no objects give no row."""
    features = {**condition_features(), **equipment_features()}
    return (
        with_pairs(df.select("listing_id", document), document)
        .where(F.col("kv").isNotNull())
        .select("listing_id", *[features[c].alias(c) for c in V.DOCUMENT_FEATURES])
    )
