"""Text rules as Column -> Column functions.

All of them are built-in expressions, so they stay in whole-stage code generation. ANSI mode is on, hence
``try_cast`` and guarded parsing wherever the text may be anything.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.vocab import BLANKS, FALSE_WORDS, NUMBER, TRUE_WORDS, UNKNOWN_TEXT

NBSP = "\u00a0"


def strip(c: Column) -> Column:
    """Trim every Unicode blank; ``F.trim`` knows U+0020 only.

    Trimming by a character set walks the whole text, so text with plain characters at both ends is
    passed on as it is.
    """
    plain_ends = F.ascii(c).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126)
    return F.when(plain_ends, c).otherwise(F.btrim(c, F.lit(BLANKS)))


def collapse_blanks(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def remove(c: Column, *parts: str) -> Column:
    for part in parts:
        c = F.replace(c, F.lit(part), F.lit(""))
    return c


def look_up(c: Column, table: Mapping[str, object]) -> Column:
    """Value for a key of a short constant table, else null."""
    entries = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), c)


def null_if_in(c: Column, words: Iterable[str]) -> Column:
    return F.when(~c.isin(*words), c)


def to_number(c: Column) -> Column:
    """Double, or null for anything that is not a plain decimal number.

    The pattern keeps out what a cast would also take: ``12d``, ``nan``, ``infinity``.
    """
    return F.regexp_extract(c, NUMBER, 1).try_cast("double")


def german_amount(c: Column) -> Column:
    """``12.345,50 €`` -> 12345.5"""
    return to_number(F.replace(remove(c, NBSP, "€", "."), F.lit(","), F.lit(".")))


def german_distance(c: Column) -> Column:
    """``45.000 km`` -> 45000.0"""
    return to_number(remove(c, NBSP, "km", "."))


def horse_power(c: Column) -> Column:
    """``150 PS`` -> 150.0"""
    return to_number(remove(c, NBSP, "PS"))


def first_digits(c: Column) -> Column:
    """The first run of digits as text, null without one."""
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit(""))


def scrub_number(c: Column) -> Column:
    """Keep digits, point and minus, then read a number.

    Text made of these characters alone, the usual case, needs no pattern at all.
    """
    clean = F.translate(c, "0123456789.-", "") == ""
    return F.when(clean, c).otherwise(F.regexp_replace(c, r"[^0-9.\-]", "")).try_cast("double")


def word_to_boolean(c: Column) -> Column:
    table = {**dict.fromkeys(TRUE_WORDS, True), **dict.fromkeys(FALSE_WORDS, False)}
    return look_up(F.lower(strip(c)), table)


def month_year(c: Column, lenient: bool = False) -> Column:
    """First day of the month named by ``EZ 03/2020`` and the like, else null.

    ``lenient`` also takes a colon after the prefix word.
    """
    text = strip(remove(F.replace(c, F.lit(NBSP), F.lit(" ")), "Erstzulassung", "EZ"))
    if lenient:
        text = F.regexp_replace(text, r"(?U)^[:\s]+", "")
    month = F.regexp_extract(text, r"^((?:1[0-2]|0[1-9]|[1-9])/[0-9]{4})$", 1)
    return F.try_to_timestamp(month, F.lit("M/yyyy")).cast("date")


def title_word(title: Column, position: int) -> Column:
    """Lower-cased word of a title; null when there are not so many."""
    words = F.split(strip(title), r"(?U)\s+")
    return F.nullif(F.lower(F.get(words, F.lit(position))), F.lit(""))


def map_words(c: Column, table: Mapping[str, str]) -> Column:
    """Exact word translation; null for words outside the table."""
    return look_up(strip(c), table)


def clean_text(c: Column, missing: Iterable[str]) -> Column:
    return null_if_in(strip(c), missing)


def valid_vin(c: Column, pattern: str) -> Column:
    vin = strip(F.upper(c))
    return F.when(vin.rlike(pattern), vin)


def safe_text(c: Column) -> Column:
    """Lower-case category text. Emptiness is tested before trimming, so ``"  "`` becomes ``""``."""
    return F.when(c.isNull() | (c == ""), UNKNOWN_TEXT).otherwise(strip(F.lower(c)))


def safe_flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def display_name(c: Column) -> Column:
    """``mercedes-benz`` -> ``Mercedes-Benz``, ``nx`` -> ``NX``."""
    return F.array_join(
        F.transform(
            F.split(c, "-"),
            lambda p: F.when(p.rlike(r"^\p{L}{1,3}$"), F.upper(p)).otherwise(
                F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 2**31 - 1)))
            ),
        ),
        "-",
    )


def title_without_brand(title: Column, brand: Column) -> Column:
    """Title minus the brand as a whole word, blanks collapsed."""
    # \E inside the brand would end the quotation
    quoted = F.replace(brand, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    pattern = F.concat(F.lit(r"(?iU)\b\Q"), quoted, F.lit(r"\E\b"))
    return strip(collapse_blanks(F.regexp_replace(title, pattern, F.lit(""))))


def canonical_link(href: Column, host: str) -> Column:
    """Absolute link with its path and first query parameter only."""
    absolute = F.when(href.startswith("/"), F.concat(F.lit(host), href)).otherwise(href)
    return F.regexp_extract(absolute, r"^([^?]*(\?[^&?]*)?)", 1)


def rounded_number(c: Column) -> Column:
    """``12345.6`` -> ``12,346``"""
    return F.format_number(c, 0)
