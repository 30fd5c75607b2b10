"""Jaccard self-join of word shingle sets by grouped prefixes.

Two sets of a likeness of at least ``t`` share a shingle among the first ``n - ceil(t n) + 1`` of each, in any order
that is the same for all. The join goes from texts to fewer and fewer candidates:

1. texts with the same set are one *node*, nodes with the same prefix and size are one *group*;
2. prefixes of groups are matched by shingle. The order puts rare shingles first, by counters of bounded size that
   every text has added to, so what many texts share stands last and hardly ever takes part;
3. group pairs are filtered by size, by places, and by how much of the prefixes agrees, then expanded to nodes, and nodes are
   verified on their whole sets.

What is wanted are classes of texts connected by links, so pairs inside a class need no second proof. Matches are
followed twice: first along each shingle's list, where every group meets the one before it and the first one, which is
the least edited (a number of pairs linear in the list); then every remaining pair of a list whose ends are in
different classes. No list is cut, no candidate is left out: the second round is exact, the first only leaves it less
to do.

Defined results: null and empty texts, and texts without words, have no shingles and are linked with nothing; repeated
rows and repeated or null ids are kept and classed by their texts; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm import shingles
from lotwise.llm.common import stored, text_slices
from lotwise.llm.components import components

#: bits of a counter's number; 4 bytes each while counting, one byte each when sent to the tasks
COUNTER_BITS = 20
SLICE_BITS = 12
#: bits of the filter that keeps unneeded sets from being handed over; a matter of volume only
FILTER_BITS = 24
#: bytes of text that are hashed at once; the text that passes them is the last
TEXT_BYTES = 1 << 20


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from text_slices(batch, column, TEXT_BYTES)


def shingle_counters(texts: DataFrame, words: int) -> np.ndarray:
    """How often shingles fall on each of ``2**COUNTER_BITS`` counters, on a scale of four steps per doubling.

    Tasks count on their own; their counters are summed slice by slice as they stream in. The driver gets the sums,
    one byte per counter, whatever the size of the data.
    """
    slices, shift = 1 << (COUNTER_BITS - SLICE_BITS), np.uint64(64 - COUNTER_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in _chunks(batches, 0):
            found = shingles.rolled(batch.column(0).to_pylist(), words)
            total += np.bincount((found >> shift).astype(np.int64), minlength=len(total))
        rows = total.reshape(slices, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(slices, dtype=np.int32)), pa.array([r.tobytes() for r in rows], pa.binary())], ["slice", "counts"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(counts.as_buffer(), np.int64)
                sums[number] = sums[number] + values if number in sums else values.copy()
        scaled = [np.floor(4 * np.log2(v + 1.0)).astype(np.uint8).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(scaled, pa.binary())], ["slice", "scaled"])

    summed = (
        texts.mapInArrow(count, "slice int, counts binary").repartition("slice")
        .mapInArrow(add, "slice int, scaled binary").collect()
    )
    out = np.zeros((slices, 1 << SLICE_BITS), np.uint8)
    for row in summed:
        out[row["slice"]] = np.frombuffer(row["scaled"], np.uint8)
    return out.reshape(-1)


def _node(found: np.ndarray) -> int:
    """One 64-bit number for a set."""
    with np.errstate(over="ignore"):
        return int(np.array([shingles.mix(found).sum(dtype=np.uint64) + np.uint64(len(found))], np.uint64).view(np.int64)[0])


def prefixes(docs: DataFrame, words: int, percent: int, key: str, text: str) -> DataFrame:
    """``(key, node, n, prefix)``: the set's number, its size, its first shingles in the common order."""
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rarity = source.sparkSession.sparkContext.broadcast(shingle_counters(source.select("text"), words))
    shift = np.uint64(64 - COUNTER_BITS)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches, 1):
            nodes, sizes, kept = [], [], []
            for found in shingles.shingle_sets(batch.column(1).to_pylist(), words):
                n = len(found)
                nodes.append(_node(found) if n else None)
                sizes.append(n)
                length = n - -(-percent * n // 100) + 1 if n else 0
                common = rarity.value[(found >> shift).astype(np.int64)]
                # found is sorted, so equally rare ones stay in the order of their numbers
                kept.append(found[np.argsort(common, kind="stable")[:length]].view(np.int64))
            ends = np.cumsum([0] + [len(k) for k in kept]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.int64), *kept])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                ["key", "node", "n", "prefix"],
            )

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(first, f"key {kind}, node bigint, n bigint, prefix array<bigint>")


def whole_sets(docs: DataFrame, needed: DataFrame, words: int, text: str) -> DataFrame:
    """``(node, shingles)`` of the nodes in ``needed``, once each.

    Sets are made from the texts again instead of being stored. A bit filter of fixed size tells tasks which ones to
    hand over; it may let others pass, the join removes them.
    """
    slots = needed.select(F.pmod(F.xxhash64("node"), F.lit(1 << FILTER_BITS)).alias("slot"), "node")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[_slot(batch.column(0).to_numpy())] = True
        rows = np.packbits(bits).reshape(256, -1)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array([rows[i].tobytes() for i in used], pa.binary())], ["part", "bits"]
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, bits in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.frombuffer(bits.as_buffer(), np.uint8)
                sums[number] = sums[number] | found if number in sums else found.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["part", "bits"]
        )

    filled = np.zeros((256, (1 << FILTER_BITS) // 8 // 256), np.uint8)
    marked = slots.select("node").mapInArrow(mark, "part int, bits binary").repartition("part")
    for row in marked.mapInArrow(merge, "part int, bits binary").collect():
        filled[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    wanted = docs.sparkSession.sparkContext.broadcast(filled.reshape(-1))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()  # copies meet again after the shuffle; within a task one is enough
        for batch in _chunks(batches, 0):
            found = [s for s in shingles.shingle_sets(batch.column(0).to_pylist(), words) if len(s)]
            nodes = np.array([_node(s) for s in found], np.int64)
            place = _slot(nodes)
            hit = (wanted.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1
            keep = []
            for i in np.flatnonzero(hit).tolist():
                if int(nodes[i]) not in given:
                    given.add(int(nodes[i]))
                    keep.append(i)
            if keep:
                ends = np.cumsum([0] + [len(found[i]) for i in keep]).astype(np.int32)
                values = np.concatenate([found[i] for i in keep]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[keep]), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["node", "shingles"]
                )

    given = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(sets, "node bigint, shingles array<bigint>")
    return given.join(needed, "node", "left_semi").dropDuplicates(["node"])


def _slot(nodes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (shingles.mix(nodes.astype(np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _room(n_a: Column, place_a: Column, n_b: Column, place_b: Column, percent: int) -> Column:
    """Whether two sets can be alike if the first shingle they share has these places in their orders.

    From there on each set has ``n - place`` shingles left to share. Pairs that are alike pass at their first shared
    shingle; sets whose sizes differ too much never do.
    """
    return F.least(n_a - place_a, n_b - place_b) * (100 + percent) >= (n_a + n_b) * percent


def _filtered(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Group pairs ``(a, b)`` whose prefixes leave room for the likeness.

    The prefix that ends first in the common order has all its matches inside the other one; what it leaves over can
    match at most once each.
    """
    side = lambda x: groups.select(
        F.col("group").alias(x), F.col("n").alias(f"n_{x}"), F.col("prefix").alias(f"prefix_{x}"))
    rest = F.greatest(F.col("n_a") - F.size("prefix_a"), F.col("n_b") - F.size("prefix_b"))
    most = F.size(F.array_intersect("prefix_a", "prefix_b")) + rest
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .where(most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent).select("a", "b")
    )


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int, text: str) -> DataFrame:
    """Node pairs ``(a, b)`` whose whole sets reach the likeness."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stored(whole_sets(docs, needed, words, text), "sets")
    side = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return pairs.join(side("a"), "a").join(side("b"), "b").where(common * 100 >= union * percent).select("a", "b")


def linked_classes(
    docs: DataFrame, words: int, percent: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per text: ``(key, n_shingles, node, component)``.

    Texts of one ``node`` have the same set; texts of one ``component`` are connected by links of at least ``percent``
    of a hundred. Both are null for texts without shingles.
    """
    made = stored(prefixes(docs, words, percent, key, text), "prefixes")
    nodes = (
        made.where("node IS NOT NULL").select("node", "n", "prefix").dropDuplicates(["node"])
        .withColumn("group", F.xxhash64("n", "prefix"))
    )
    nodes = stored(nodes, "nodes")
    members = nodes.select("node", "group")
    groups = stored(nodes.groupBy("group").agg(
        F.min(F.struct("node", "n", "prefix")).alias("g"), F.count(F.lit(1)).alias("size")
    ).select("group", "g.node", "g.n", "g.prefix", "size"), "groups")
    lists = groups.select(F.posexplode("prefix").alias("place", "shingle"), "group", "n")
    # least edited texts first: the fewer rare shingles of its own a text has, the earlier a common one stands
    order = Window.partitionBy("shingle").orderBy("place", "n", "group")
    here = F.struct("group", "n", "place")
    met = lists.select(
        "shingle", "group", "n", "place", F.lag(here).over(order).alias("near"), F.first(here).over(order).alias("head")
    ).where("near IS NOT NULL")
    met = stored(met, "met")
    # every list that has more than one group, whole: its head and all that follow it
    longer = met.select("shingle", "group", "n", "place").unionByName(
        met.select("shingle", "head.group", "head.n", "head.place").distinct()
    )
    close = met.select(F.col("group").alias("a"), "n", "place", F.explode(F.array("near", "head")).alias("other"))
    close = close.where((F.col("a") != F.col("other.group")) & _room(
        F.col("n"), F.col("place"), F.col("other.n"), F.col("other.place"), percent))
    close = close.select(F.least("a", "other.group").alias("a"), F.greatest("a", "other.group").alias("b")).distinct()
    firsts = groups.select("group", "node")
    of = lambda pairs: (
        pairs.join(firsts.toDF("a", "node_a"), "a").join(firsts.toDF("b", "node_b"), "b")
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    # members of a group meet its first one
    inside = members.join(groups.where("size > 1").select("group", F.col("node").alias("a")), "group")
    inside = inside.where("node <> a").select("a", F.col("node").alias("b"))
    first_round = stored(of(_filtered(close, groups, percent)).unionByName(inside), "pairs")
    links = stored(_verified(first_round, docs, words, percent, text), "links")
    classes = stored(components(links), "classes")

    # second round: all that is left between different classes
    classed = members.join(classes, "node", "left").select(
        "node", "group", F.coalesce("component", "node").alias("class")
    )
    classed = stored(classed, "classed")
    spread = classed.groupBy("group").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    listed = longer.join(spread, "group")
    mixed = listed.groupBy("shingle").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l <> h").select("shingle")
    listed = listed.join(mixed, "shingle").select("shingle", "group", "n", "place", "low", "high")
    left, right = listed.alias("x"), listed.alias("y")
    between = left.join(
        right,
        (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.group") < F.col("y.group"))
        & _room(F.col("x.n"), F.col("x.place"), F.col("y.n"), F.col("y.place"), percent)
        & ~((F.col("x.low") == F.col("y.high")) & (F.col("x.high") == F.col("y.low")) & (F.col("x.low") == F.col("x.high"))),
    ).select(F.col("x.group").alias("a"), F.col("y.group").alias("b")).distinct()
    side = lambda x: classed.select(
        F.col("group").alias(x), F.col("node").alias(f"node_{x}"), F.col("class").alias(f"class_{x}"))
    expanded = _filtered(between, groups, percent).join(side("a"), "a").join(side("b"), "b")
    in_group = side("a").join(spread.where("low <> high").select(F.col("group").alias("a")), "a")
    in_group = in_group.join(side("b"), F.col("a") == F.col("b")).where("node_a < node_b")
    columns = [F.col("node_a").alias("a"), F.col("node_b").alias("b"), "class_a", "class_b"]
    rest = expanded.select(*columns).unionByName(in_group.select(*columns)).where("class_a <> class_b").select("a", "b")
    rest = stored(rest.join(first_round, ["a", "b"], "left_anti"), "pairs")
    if rest.isEmpty():
        final = classed.select("node", F.col("class").alias("component"))
    else:
        more = _verified(rest, docs, words, percent, text)
        class_of = classed.select("node", "class")
        joined = more.join(class_of.toDF("a", "class_a"), "a").join(class_of.toDF("b", "class_b"), "b")
        merged = components(joined.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))
        final = stored(classed.join(merged.withColumnRenamed("node", "class"), "class", "left").select(
            "node", F.coalesce("component", "class").alias("component")
        ), "final")
    return made.select("key", "n", "node").join(final, "node", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), "node", "component"
    )


def with_smallest_key(classes: DataFrame, key: str = "doc_id", out: str = "component_id") -> DataFrame:
    """Name every class by its smallest key; a text without a class is its own."""
    least = classes.where("component IS NOT NULL").groupBy("component").agg(F.min(key).alias("__least"))
    # written, so that both sides of the join are plain and Spark can split a class that holds many rows
    return classes.join(stored(least, "least"), "component", "left").select(
        key, "n_shingles", F.coalesce(F.col("__least"), F.col(key)).alias(out)
    )


def one_of_each(docs: DataFrame, words: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but one text of each class; all columns stay.

    The text with the smallest ``key`` stays (null first), among equal keys the one with the smallest hash; rows that
    agree in key and text are one. Texts without shingles are in no class and stay.
    """
    # 128 bits, so that two rows are one only if they agree; two plain columns, so that joining and keeping one share a shuffle
    ties = ["__tie_a", "__tie_b"]
    tied = docs.withColumns({ties[0]: F.xxhash64(F.col(key), F.col(text)), ties[1]: F.xxhash64(F.lit("tie"), F.col(text), F.col(key))})
    known = linked_classes(tied.select(F.struct(F.col(key).alias("k"), *ties).alias("key"), text), words, percent, "key", text)
    ranked = known.where("component IS NOT NULL").groupBy("component").agg(F.min("key").alias("kept"))
    kept = ranked.select("kept.*").unionByName(known.where("component IS NULL").select("key.*")).distinct()
    kept = stored(kept.select(*ties), "kept")
    return tied.join(kept, ties, "left_semi").dropDuplicates(ties).drop(*ties)
