"""Clean and load one market."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from lotwise.operators import loading
from lotwise.operators.cleaning_de import clean_de
from lotwise.operators.cleaning_us import clean_us
from lotwise.operators.ranking import assign_ids
from lotwise.sources.store import Versions, bucket_count, check_row_count, require_rows, write_table
from lotwise.vocab import DE_AGE_ANCHOR

MARKETS = ("DE", "US")


@dataclass(frozen=True)
class Store:
    """The stored tables of one market."""

    listings: DataFrame
    details: DataFrame


def _code(market: str) -> str:
    code = market.upper()
    if code not in MARKETS:
        raise ValueError(f"unknown market: {market}")
    return code


def clean(raw: DataFrame, market: str, as_of: str | None = None, order: tuple[str, ...] = ("row_pos",)) -> DataFrame:
    """Cleaned rows of either market with their input position."""
    if _code(market) == "DE":
        return clean_de(raw, as_of or DE_AGE_ANCHOR)
    if as_of is None:
        raise ValueError("US ages need the as_of time")
    return clean_us(raw, as_of, order, keep_order=True)


def load(
    cleaned: DataFrame, market: str, root: str, dataset_id: int, base: int = 0,
    order: Sequence[str] = ("row_pos",), **overrides: str
) -> Store:
    """Assign ids in the order of positions, write parent and child tables below ``root`` and check their counts.

    ``cleaned`` should be a written table: ids are assigned from its positions, and parent and child
    both read it. Both are bucketed by the listing's id, so joins of the two move no rows. They become visible
    together, when both are complete: a load that stops in between leaves the earlier one in place.
    """
    code = _code(market)
    versions = Versions(cleaned.sparkSession, root)
    rows = loading.prepare_de(cleaned) if code == "DE" else cleaned
    ties = [c for c in order[1:] if c in rows.columns]
    rows = write_table(assign_ids(rows, base, order[0], ties=ties), f"{root}/numbered_{code.lower()}")
    parent, child = (
        (loading.listings_de(rows, dataset_id, **overrides), loading.details_de(rows))
        if code == "DE"
        else (loading.listings_us(rows, dataset_id, **overrides), loading.details_us(rows))
    )
    buckets = bucket_count(rows.count())
    parents = versions.write(parent, f"listings_{code.lower()}", "id", buckets, "market")
    check_row_count(cleaned, parents.df)
    children = versions.write(child, f"listing_{code.lower()}", "listing_id", buckets)
    versions.publish(parents, children)
    return Store(parents.df, children.df)


def stored(spark: SparkSession, root: str, market: str) -> Store | None:
    """A market's tables as its last complete load left them."""
    code, versions = _code(market).lower(), Versions(spark, root)
    parents, children = versions.current(f"listings_{code}"), versions.current(f"listing_{code}")
    return Store(parents, children) if parents is not None and children is not None else None


def all_listings(spark: SparkSession, root: str) -> DataFrame:
    """Parents of all markets that are loaded; a filter on ``market`` reads that market's files only.

    Ids are unique within a market, or over all with a ``base`` per market that no other reaches.
    """
    found = [s.listings for s in (stored(spark, root, m) for m in MARKETS) if s is not None]
    return reduce(DataFrame.unionByName, found)


def store_features(features: DataFrame, root: str, buckets: int) -> DataFrame:
    """Listing features as the current version of ``listing_features``, bucketed like the parents they belong to."""
    versions = Versions(features.sparkSession, root)
    table = versions.write(features, "listing_features", "listing_id", buckets)
    versions.publish(table)
    return table.df


def run(
    raw: DataFrame, market: str, root: str, dataset_id: int, as_of: str | None = None,
    order: tuple[str, ...] = ("row_pos",), base: int = 0,
) -> Store:
    """Raw rows to stored tables: clean, write, number, load."""
    cleaned = write_table(clean(raw, market, as_of, order), f"{root}/cleaned_{_code(market).lower()}")
    require_rows(cleaned, "no listing is left after cleaning")
    return load(cleaned, market, root, dataset_id, base, order)
