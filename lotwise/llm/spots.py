"""Spot signatures: fingerprints from chains of content words that follow common words. DataFrame operations only.

A text is lower-cased and cut into words of letters and digits; common words other than anchors are left out. Every
anchor (a very common word) starts a signature: the anchor and the ``CHAIN`` content words after it, with anchors in
between skipped over. The signatures' hashes, sorted and distinct, are the fingerprint; two fingerprints are alike by
their Jaccard index. Text around the anchors that is not prose (tables, menus, numbers) leaves few or no signatures. A
text without any anchor chain has a chain at every word, and one that is too short even for that has its whole wording
as its one signature, so equal texts always have equal fingerprints and different ones rarely do.

``near_duplicates`` compares all documents: equal fingerprints are one, fingerprints are put into partitions by
length such that a pair that is alike enough is in one partition or in neighbouring ones, and within a partition only
those meet that share one of their first signatures.

Defined results: null text is empty text; empty texts and texts without letters or digits share one fingerprint and
are alike by 1; repeated rows and equal ids are ordered by the hash of their text; rows with null ids come last in
descending order; a single row is its own successor; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import stored, text_or_empty

CHAIN = 2
#: rows that share a block when documents are lined up by id
BLOCK_ROWS = 1500

# Very common words of English, German, French and Spanish that start a signature ...
ANCHORS = ("the", "a", "is", "was", "der", "die", "das", "ist", "le", "la", "les", "est", "el", "los", "una", "es")
# ... and further common words that no signature holds
OTHERS = (
    "of", "and", "to", "in", "that", "it", "for", "on", "with", "as", "be", "by", "at", "this", "are", "or", "an", "from",
    "und", "zu", "den", "von", "mit", "sich", "des", "auf", "nicht", "ein", "eine", "im", "dem",
    "de", "et", "un", "une", "que", "qui", "dans", "par", "pour", "pas", "sur", "au",
    "y", "en", "se", "del", "las", "con", "por", "lo", "no", "su",
)


def _any(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(words) + ")(?![^ ])"


def _words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.trim(F.regexp_replace(plain, rf"(?<![^ ]){_any(OTHERS)} ?", ""))


def _chains(words: Column, start: str) -> Column:
    link = rf"(?: {_any(ANCHORS)})*+ [^ ]++"
    return F.regexp_extract_all(words, F.lit(rf"(?<![^ ])(?=({start}(?:{link}){{{CHAIN}}}))"), F.lit(1))


def _once(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value worked out once, however often ``fn`` names it.

    Expressions around lambda functions are not looked through for common parts, so a text's words and chains would
    be made again wherever they are named.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def signatures(text: Column) -> Column:
    """The fingerprint of a text column: sorted distinct hashes as ``array<int>``."""

    def chains(words: Column) -> Column:
        first = lambda found: _once(F.when(F.size(found) > 0, found).otherwise(_chains(words, "[^ ]++")), every)
        every = lambda anywhere: F.when(F.size(anywhere) > 0, anywhere).otherwise(F.array(words))
        return _once(_chains(words, _any(ANCHORS)), first)

    found = _once(_words(text), chains)
    return F.array_sort(F.array_distinct(F.transform(found, lambda s: F.hash(s))))


def as_text(found: Column) -> Column:
    """Eight hexadecimal digits per signature."""
    unsigned = lambda x: F.pmod(x.cast("bigint"), F.lit(1 << 32))
    return F.array_join(F.transform(found, lambda x: F.lower(F.lpad(F.hex(unsigned(x)), 8, "0"))), "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard index of two fingerprints; 0 without comparing them where their lengths rule ``least`` out."""
    common = F.size(F.array_intersect(a, b)).cast("double")
    exact = common / (F.size(a) + F.size(b) - common)
    return F.when(F.least(F.size(a), F.size(b)) < F.lit(least) * F.greatest(F.size(a), F.size(b)), 0.0).otherwise(exact)


def with_successor(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, text, found, next_text, next_found)``: each text and fingerprint beside those of the next lower id.

    Documents are lined up inside blocks of neighbouring ids; the first row of the block below is added to each block
    as a guest, so every text is shuffled once.
    """
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    span = rows.agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n")).first()
    low = span["low"] or 0
    width = max(1, ((span["high"] or 0) - low + 1) * BLOCK_ROWS // max(1, span["n"]))
    rows = rows.withColumn("block", F.floor((F.col("key") - F.lit(low)) / F.lit(width)).cast("bigint"))
    place = F.struct("key", F.xxhash64("text").alias("tie"))
    heads = stored(rows.groupBy("block").agg(F.max_by(F.struct("key", "text"), place).alias("head")), "heads")
    above = Window.orderBy(F.col("block").asc_nulls_first())
    edge = heads.agg(F.min("block").alias("lowest"), F.count_if(F.col("block").isNull()).alias("loose")).first()
    last_block = F.lit(None).cast("bigint") if edge["loose"] else F.lit(edge["lowest"]).cast("bigint")
    hosts = heads.select("block", F.lead("block").over(above).alias("host"))  # the block just above
    host = hosts.join(heads, F.col("host").isNotNull() & hosts["block"].eqNullSafe(heads["block"]))
    guests = host.select(F.col("host").alias("block"), F.col("head.key").alias("key"), F.col("head.text").alias("text"))
    topmost = heads.orderBy(F.col("block").desc_nulls_last()).limit(1).select(
        last_block.alias("block"), F.col("head.key").alias("key"), F.col("head.text").alias("text")
    )
    lined = rows.withColumn("guest", F.lit(False)).unionByName(guests.unionByName(topmost).withColumn("guest", F.lit(True)))
    lined = lined.withColumn("found", signatures(F.col("text")))
    order = Window.partitionBy("block").orderBy("guest", F.col("key").desc_nulls_last(), F.xxhash64("text").desc())
    return lined.select(
        "key", "text", "found", "guest", F.lead("text").over(order).alias("next_text"), F.lead("found").over(order).alias("next_found")
    ).where("NOT guest").drop("guest")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, found)`` per row."""
    return docs.select(F.col(key).alias(key), signatures(text_or_empty(text)).alias("found"))


def near_duplicates(docs: DataFrame, least: float = 0.8, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Pairs of different fingerprints of at least ``least`` likeness, and the membership of every row.

    Pairs are ``(a, b, likeness)`` of fingerprint numbers, membership is ``(key, number)``.
    """
    rows = stored(
        fingerprints(docs, key, text).withColumn("number", F.xxhash64("found")), "fingerprints"
    )
    sets = rows.select("number", "found").dropDuplicates(["number"])
    band = F.floor(F.log(F.size("found").cast("double")) / F.lit(-math.log(least))).cast("int")
    length = F.size("found") - F.ceil(F.lit(least) * F.size("found") - 1e-9).cast("int") + 1
    spread = sets.select("number", "found", F.size("found").alias("n"), band.alias("band"), length.alias("length"))
    # rare signatures first
    common = spread.select(F.explode("found").alias("signature")).groupBy("signature").agg(F.count(F.lit(1)).alias("uses"))
    ranked = spread.select("number", "n", "band", "length", F.explode("found").alias("signature")).join(common, "signature")
    order = Window.partitionBy("number").orderBy("uses", "signature")
    first = ranked.withColumn("place", F.row_number().over(order)).where("place <= length AND uses > 1")
    own = first.select("number", "n", "signature", "band")
    shifted = own.unionByName(own.withColumn("band", F.col("band") + 1))
    x, y = own.alias("x"), shifted.alias("y")
    met = x.join(y, ["band", "signature"]).where(
        (F.col("x.number") != F.col("y.number")) & (F.col("y.n") <= F.col("x.n")) & (F.col("y.n") >= F.lit(least) * F.col("x.n"))
    )
    pairs = met.select(
        F.least("x.number", "y.number").alias("a"), F.greatest("x.number", "y.number").alias("b")
    ).distinct()
    side = lambda c: sets.select(F.col("number").alias(c), F.col("found").alias(f"found_{c}"))
    compared = pairs.join(side("a"), "a").join(side("b"), "b").withColumn(
        "likeness", likeness(F.col("found_a"), F.col("found_b"), least)
    )
    return compared.where(F.col("likeness") >= least).select("a", "b", "likeness"), rows.select(key, "number")
