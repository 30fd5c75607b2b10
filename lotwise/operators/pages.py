"""Listing pages to raw listing rows, and overview pages to links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import vocab as V
from lotwise.functions.html import page_parts
from lotwise.functions.text import canonical_link, strip
from lotwise.operators.dedup import keep_first


def parse_pages(pages: DataFrame) -> DataFrame:
    """Add the parsed ``page``; the only Python step of the page job. Pages without text give no row."""
    return pages.where(F.col("html").isNotNull()).withColumn("page", page_parts("html")).drop("html")


def _part(name: str) -> Column:
    return F.col("page").getField(name)


def _present(c: Column) -> Column:
    """Null for empty text and for the missing mark, so that coalesce moves on."""
    return F.when((c != "") & (c != V.NOT_AVAILABLE), c)


def _first_match(pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(_part("page_text"), pattern, group), F.lit(""))


def title() -> Column:
    og = strip(F.regexp_replace(_part("og_title"), r"(?U)\s*für\s*[\d.,]+\s*€.*", ""))
    element = F.coalesce(_part("listing_title"), _part("ad_title"), _part("h1"))
    head = strip(F.split(F.split(_part("head_title"), "für")[0], r"\|")[0])
    # an empty element title falls through to the head title, an empty head title stays
    return F.coalesce(_present(og), _present(element), head)


def price() -> Column:
    lowered = lambda s: F.lower(s)
    fitting = F.filter(
        _part("strings"),
        lambda s: s.rlike(f"(?U){V.PRICE_TEXT}")
        & ~F.exists(F.array(*map(F.lit, V.PRICE_STOP_WORDS)), lambda w: lowered(strip(s)).contains(w)),
    )
    in_text = F.regexp_extract(F.get(fitting, F.lit(0)), f"(?U){V.PRICE_TEXT}", 0)
    return F.coalesce(_present(_part("prime_price")), _present(in_text))


def mileage() -> Column:
    return _first_match(r"(?iU)[\d.]+\s*km")


def registration() -> Column:
    return F.coalesce(
        _first_match(r"(?iuU)(?:EZ|Erstzulassung)[\s:]*(?:0[1-9]|1[0-2])/\d{4}"),
        _first_match(r"(?U)\b(?:0[1-9]|1[0-2])/(?:19|20)\d{2}\b"),
    )


def power() -> Column:
    number = F.coalesce(_first_match(r"(?U)\((\d+)\s*PS\)", 1), _first_match(r"(?U)(\d+)\s*PS", 1))
    return F.concat(number, F.lit(" PS"))


def _word(word: str) -> Column:
    return _part("page_text").rlike(rf"(?iuU)\b{word}\b")


def transmission() -> Column:
    return F.when(_word("Automatik"), "Automatik").when(_word("Schaltgetriebe"), "Schaltgetriebe")


def fuel() -> Column:
    result = None
    for name in V.PAGE_FUELS:
        # names with brackets are looked up as plain text, they do not end at a word boundary
        hit = F.lower(_part("page_text")).contains(name.lower()) if "(" in name else _word(name)
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return result


def owners() -> Column:
    return _first_match(r"(?iuU)Fahrzeughalter[^0-9]{1,15}(\d+)", 1)


def location() -> Column:
    exact = r"(?U)DE-([0-9]{5})\s+([A-ZÄÖÜ][a-zA-ZäöüßÄÖÜ\-\s]+?)(?=\s*\||\s*$)"
    loose = r"(?U)\b([0-9]{5})\s+([A-ZÄÖÜ][a-zäöüß]+)\b"
    place = _first_match(loose, 2)
    return F.coalesce(
        F.concat(_first_match(exact, 1), F.lit(" "), strip(_first_match(exact, 2))),
        F.when(~place.isin(*V.NO_PLACE_WORDS), F.concat(_first_match(loose, 1), F.lit(" "), place)),
    )


def _section(start: str, stop: Sequence[str], skip: Sequence[str], shortest: int, glue: str) -> Column:
    """Distinct strings after a heading up to a stop word, in order."""
    strings = F.transform(_part("strings"), strip)
    tail = F.slice(strings, _part(start) + 1, F.greatest(F.size(strings) - _part(start), F.lit(0)))
    stops = F.transform(tail, lambda s: s.isin(*stop))
    end = F.array_position(stops, True)
    body = F.when(end > 0, F.slice(tail, F.lit(1), (end - 1).cast("int"))).otherwise(tail)
    kept = F.filter(body, lambda s: (F.length(s) > shortest) & ~s.isin(*skip))
    return F.when(
        _part(start).isNotNull(), F.nullif(F.array_join(F.array_distinct(kept), glue), F.lit(""))
    )


def equipment() -> Column:
    return _section("equipment_at", V.EQUIPMENT_STOP, V.EQUIPMENT_SKIP, 2, ", ")


def description() -> Column:
    return _section("description_at", V.DESCRIPTION_STOP, V.DESCRIPTION_SKIP, 1, " | ")


def extract_listings(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html)`` to raw DE listing rows; missing fields read ``N/A``."""
    fields = {
        "Titel": title(), "Preis": price(), "Kilometerstand": mileage(), "Erstzulassung": registration(),
        "PS": power(), "Getriebe": transmission(), "Kraftstoff": fuel(), "Fahrzeughalter": owners(),
        "Standort": location(), "URL": F.col("url"), "Ausstattung": equipment(), "Beschreibung": description(),
    }
    return parse_pages(pages).select(
        "page_id",
        *[F.coalesce(fields[c], F.lit(V.NOT_AVAILABLE)).alias(c) for c in V.DE_RAW_COLUMNS],
    )


def all_links(pages: DataFrame, pattern: str = V.LINK_PATTERN, host: str = V.LINK_HOST) -> DataFrame:
    """Every matching link with its canonical form and place, before deduplication."""
    hrefs = parse_pages(pages).select("page_id", F.posexplode(_part("links")).alias("pos", "href"))
    return hrefs.where(F.col("href").rlike(pattern)).withColumn("link", canonical_link(F.col("href"), host))


def distinct_links(
    pages: DataFrame, limit: int | None = None, pattern: str = V.LINK_PATTERN, host: str = V.LINK_HOST
) -> DataFrame:
    """Links in page order, each once; ``limit`` keeps the first ones only."""
    links = keep_first(all_links(pages, pattern, host), ["link"], ["page_id", "pos"])
    links = links.select("page_id", "pos", "link")
    return links if limit is None else links.orderBy("page_id", "pos").limit(limit)
