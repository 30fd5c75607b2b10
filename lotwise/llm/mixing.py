"""Mixing sources to target weights, in DataFrame operations only.

``temperature_weights`` raises the token shares of sources to a power and looks for the power that meets a target: an
entropy of the weights, or a limit to how often the tokens of any source may be repeated. Each round divides the
interval into 64 parts with one aggregation over the table of sources.

``mix`` realises the weights. A source's documents are dealt into blocks by a hash; an epoch is a permutation of the
blocks and of the documents in each. A source is used in full as often as its budget allows; what remains of the
budget is filled along the next permutation, whole documents at a time. Only block sums of a source are put in order,
and documents inside a block, so no task holds a source.

Without a budget, the least one is taken that uses every source in full at least once, so no document is lost.

Defined results: rows without a source form a source of their own; null and empty texts have no tokens and follow
their source; a source without tokens takes no part in the weights and is used once; identical rows are used alike;
other columns are kept, but names made here must be free: a caller with unknown columns packs them into one, as the
pipeline does; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import stored

PARTS = 64
ROUNDS = 7
BLOCK_DOCUMENTS = 2048
SEED = 17


def word_count(text: Column) -> Column:
    """Tokens of a text: its words."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"\S+")).cast("bigint")


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def source_shares(docs: DataFrame, source: str = "source", tokens: str = "n_tokens") -> DataFrame:
    """``(__source, docs, tokens, share)`` per source."""
    sums = docs.groupBy(_source_key(F.col(source)).alias("__source")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(tokens).alias("tokens")
    )
    total = sums.agg(F.sum("tokens").alias("total"))
    return stored(
        sums.join(F.broadcast(total)).select("__source", "docs", "tokens", F.try_divide("tokens", "total").alias("share")),
        "sources",
    )


def _curve(shares: DataFrame, powers: list[float], budget: float | None) -> list[tuple[float, float, float]]:
    """For each power: itself, the entropy of the weights, and the most often that a source's tokens are used."""
    asked = F.explode(F.array(*[F.lit(p) for p in powers])).alias("power")
    rows = (
        shares.where("share > 0").select("share", asked)
        .select("power", F.log("share").alias("l"), F.pow("share", "power").alias("w"), "share")
        .groupBy("power").agg(
            F.sum("w").alias("s"), F.sum(F.col("w") * F.col("power") * F.col("l")).alias("d"),
            F.max(F.col("w") / F.col("share")).alias("most"), F.min(F.col("w") / F.col("share")).alias("least"),
        ).collect()
    )
    total = 0.0
    if budget is not None:
        total = float(shares.agg(F.sum("tokens")).first()[0] or 0)
    out = []
    for r in sorted(rows, key=lambda r: r["power"]):
        entropy = math.log(r["s"]) - r["d"] / r["s"]
        scale = 1 / r["least"] if budget is None else budget / (total * r["s"])
        out.append((r["power"], entropy, r["most"] * scale))
    return out


def fitting_power(
    shares: DataFrame, entropy: float | None = None, repeats: float | None = None, budget: float | None = None,
    low: float = 0.0, high: float = 1.0,
) -> float:
    """The least power in the interval with an entropy of at most ``entropy`` (nats) and at most ``repeats`` uses.

    Both fall as the power grows to 1. If even the greatest power misses a target, it is returned.
    """
    for _ in range(ROUNDS):
        powers = [low + (high - low) * i / PARTS for i in range(PARTS + 1)]
        curve = _curve(shares, powers, budget)
        fits = [
            (entropy is None or h <= entropy + 1e-12) and (repeats is None or most <= repeats * (1 + 1e-12))
            for _, h, most in curve
        ]
        first = next((i for i, ok in enumerate(fits) if ok), None)
        if first is None or not curve:
            return high
        if first == 0:
            return low
        low, high = curve[first - 1][0], curve[first][0]
    return high


def temperature_weights(
    shares: DataFrame, entropy: float | None = None, repeats: float | None = None, budget: float | None = None
) -> DataFrame:
    """Per source: ``weight``, the tokens of its ``budget``, full ``epochs`` and the tokens ``rest`` of a further one."""
    power = fitting_power(shares, entropy, repeats, budget)
    raised = shares.withColumn("raised", F.when(F.col("share") > 0, F.pow("share", F.lit(power))).otherwise(0.0))
    sums = raised.agg(F.sum("raised").alias("all"), F.max(F.when(F.col("share") > 0, F.col("tokens") / F.col("raised"))).alias("scale"))
    scaled = raised.join(F.broadcast(sums)).withColumn("weight", F.coalesce(F.try_divide("raised", "all"), F.lit(0.0)))
    tokens = F.lit(float(budget)) * F.col("weight") if budget is not None else F.col("raised") * F.col("scale")
    # a source that is to be used in full is not to miss its last document to rounding
    epochs = F.floor(F.try_divide(tokens, F.col("tokens")) + 1e-9).cast("bigint")
    used = scaled.select(
        "__source", "docs", "tokens", "share", "weight", F.lit(power).alias("power"),
        F.coalesce(tokens, F.lit(0.0)).alias("budget"),
        F.when(F.col("tokens") > 0, epochs).otherwise(F.lit(1)).cast("bigint").alias("epochs"),
    )
    rest = F.greatest(F.floor(F.col("budget") - F.col("epochs") * F.col("tokens") + 1e-6), F.lit(0)).cast("bigint")
    # written, so that Spark knows how small it is: as long as it is, documents meet it without moving to their source
    return stored(used.withColumn("rest", rest), "weights")


def _hash(*parts: Column | int) -> Column:
    return F.xxhash64(F.lit(SEED), *[F.lit(p) if isinstance(p, int) else p for p in parts])


def copies(
    docs: DataFrame, weights: DataFrame, source: str = "source", tokens: str = "n_tokens", identity: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``docs`` with ``block``, ``epochs`` (full uses) and ``copies`` (with the use in the last, partial epoch).

    Documents that agree in ``identity`` stand next to each other in every permutation.
    """
    own = _hash(*[F.col(c) for c in identity])
    dealt = docs.withColumn("__source", _source_key(F.col(source))).withColumn("__own", own)
    plan = weights.select("__source", F.ceil(F.col("docs") / BLOCK_DOCUMENTS).alias("__blocks"), "epochs", "rest")
    dealt = dealt.join(plan, "__source").withColumn("block", F.pmod(_hash(F.col("__own"), 1), F.col("__blocks")).cast("bigint"))
    last = _hash(F.col("epochs"), F.col("__source"), F.col("block"))
    sums = dealt.groupBy("__source", "block").agg(
        F.sum(tokens).alias("size"), F.first("epochs").alias("epochs"), F.first("rest").alias("left_over")
    )
    order = Window.partitionBy("__source").orderBy(last, "block").rowsBetween(Window.unboundedPreceding, -1)
    # blocks that the partial epoch reaches, with the tokens it still has for each
    reached = sums.withColumn("__room", F.col("left_over") - F.coalesce(F.sum("size").over(order), F.lit(0)))
    reached = reached.select("__source", "block", "__room").where("__room > 0")
    inside = Window.partitionBy("__source", "block").orderBy(_hash(F.col("epochs"), F.col("__own")), *identity)
    inside = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)  # identical rows are used alike
    placed = dealt.withColumn("__sum", F.sum(tokens).over(inside)).join(reached, ["__source", "block"], "left")
    extra = F.coalesce((F.col("__sum") <= F.col("__room")).cast("bigint"), F.lit(0))
    return placed.withColumn("copies", F.col("epochs") + extra).drop("__blocks", "__sum", "__room", "rest", "__own")


def uses(placed: DataFrame) -> DataFrame:
    """One row per use of a document: its ``epoch`` (from 0) beside the columns of ``copies``."""
    numbers = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("copies")), lambda i: i < F.col("copies"))
    return placed.withColumn("epoch", F.explode(numbers))


def permuted(used: DataFrame, identity: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add ``place``, the position of a use inside its block's permutation in that epoch, and ``block_order``, by which
    the blocks of all sources are to be read within an epoch."""
    order = Window.partitionBy("__source", "epoch", "block").orderBy(
        _hash(F.col("epoch"), _hash(*[F.col(c) for c in identity])), *identity
    )
    block_order = _hash(F.col("epoch"), F.col("__source"), F.col("block"))
    return used.withColumn("place", F.row_number().over(order).cast("bigint")).withColumn("block_order", block_order)
