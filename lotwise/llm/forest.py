"""Approximate nearest neighbours by a forest of hash prefixes.

Vectors are dealt into shards by a hash of their number. A shard has ``TREES`` trees; a tree is the sorted array of
long hash strings of its vectors, one bit per random direction. A query descends each tree to the entries that share
the longest prefix with its own string; then all trees ascend together, one bit at a time, and at each level the
entries that share that much with the query are added, until a share of the shard has been reached or the root. The
candidates are compared exactly, in double precision, and the best of all shards are kept per query.

How many candidates are needed for a given recall is a matter of the data: the less neighbours stand out, the more.
The default is set for vectors without any structure; it is a share of a shard and does not depend on the table's size.

Among vectors that are equal only rows of the ``neighbours + 1`` smallest numbers can be among the best (a query's own
number takes no part), and of each number ``neighbours`` rows at most. The others are left out before anything is
shuffled; results are the same, and a vector or a number that a third of the rows share is no load.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, neither as queries
nor as candidates; vectors of another length than the query's are not comparable and never found; rows with null
numbers are no queries but can be found; repeated rows are found as often as they stand there, never by their own
number; a number that has several vectors is a query with each of them, with ranks of its own; fewer candidates than asked for are all returned; ties go to the smaller number (null last); an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TREES = 24
BITS = 32
SHARE = 0.65
#: vectors of a shard on average, and queries that are answered in one go
SHARD_ROWS = 16_384
QUERY_ROWS = 2_048
SEED = 5


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector of finite components, not all zero, as ``array<double>``."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    ok = F.col(vector).isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)
    return vectors.where(F.coalesce(ok, F.lit(False))).withColumn(vector, doubles)


def directions(width: int, trees: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, width]).normal(size=(width, trees * bits))


def hash_strings(rows: np.ndarray, planes: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """One ``bits``-long string per row and tree, first bit highest, as numbers."""
    signs = (rows @ planes > 0).reshape(len(rows), trees, bits)
    return signs @ (np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64))


class Forest:
    """The sorted arrays of one shard."""

    def __init__(self, rows: np.ndarray, trees: int, bits: int, seed: int) -> None:
        self.rows, self.trees, self.bits = rows, trees, bits
        self.planes = directions(rows.shape[1], trees, bits, seed)
        strings = hash_strings(rows, self.planes, trees, bits)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=0)

    def ranges(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For queries' strings (query, tree): where in each tree the entries start and end that share 0 .. bits bits."""
        shape = (self.bits + 1, *strings.shape)
        low, high = np.empty(shape, np.int64), np.empty(shape, np.int64)
        for level in range(self.bits + 1):
            rest = np.uint64(self.bits - level)
            first = (strings >> rest) << rest
            last = first + ((np.uint64(1) << rest) - np.uint64(1))
            for t in range(self.trees):
                low[level, :, t] = np.searchsorted(self.sorted[:, t], first[:, t], "left")
                high[level, :, t] = np.searchsorted(self.sorted[:, t], last[:, t], "right")
        return low, high

    def candidates(self, queries: np.ndarray, wanted: int) -> Iterator[np.ndarray]:
        """For each query the entries met when all trees have ascended to the level that gives ``wanted`` of them."""
        low, high = self.ranges(hash_strings(queries, self.planes, self.trees, self.bits))
        met = np.zeros(len(self.rows), bool)
        for q in range(len(queries)):
            met[:] = False
            count = 0
            for level in range(self.bits, -1, -1):
                lows, highs = low[level, q], high[level, q]
                if count < wanted and (highs - lows).sum() > count:
                    for t in range(self.trees):
                        met[self.order[lows[t] : highs[t], t]] = True
                    count = int(np.count_nonzero(met))
                if count >= wanted:
                    break
            yield np.flatnonzero(met)


def _best(forest: Forest, numbers: np.ndarray, there: np.ndarray, ids: list, queries: np.ndarray, k: int, share: float):
    """``(query, vector, number, score)`` of the best candidates of this shard, the vector by its place in ``queries``."""
    lengths = np.sqrt((forest.rows * forest.rows).sum(axis=1))
    wanted = max(4 * k, int(np.ceil(share * len(forest.rows))))
    for place, (query, vector, found) in enumerate(zip(ids, queries, forest.candidates(queries, wanted))):
        found = found[~there[found] | (numbers[found] != query)]
        # row by row, so that equal vectors have equal scores
        scores = (forest.rows[found] * vector).sum(axis=1) / (lengths[found] * np.sqrt((vector * vector).sum()))
        first = np.lexsort((numbers[found], ~there[found], -scores))[:k]
        for i in first.tolist():
            yield query, place, int(numbers[found[i]]) if there[found[i]] else None, float(scores[i])


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    trees: int = TREES, bits: int = BITS, share: float = SHARE, seed: int = SEED,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for every row that ``is_query`` (a condition on
    ``key``) holds for, by the largest cosine."""
    rows = usable(vectors.select(F.col(key).cast("bigint").alias("key"), F.col(vector).alias("vector")), "vector")
    same = Window.partitionBy("vector", "key").orderBy("key")
    once = rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k)
    alike = Window.partitionBy("vector").orderBy(F.col("key").asc_nulls_last())
    kept = once.withColumn("place", F.dense_rank().over(alike)).where(F.col("place") <= k + 1).drop("place")
    total = kept.count()
    shards = max(1, -(-total // SHARD_ROWS))
    asked = rows.where(is_query & F.col("key").isNotNull()).dropDuplicates(["key", "vector"])
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    # a shard meets the queries block by block: both sides are dealt to (shard, block)
    shard = F.pmod(F.xxhash64("key", "vector"), F.lit(shards))
    stored_side = kept.select("key", "vector", shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    block = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(blocks)).cast("int")
    query_side = asked.select(
        "key", "vector", F.xxhash64("vector").alias("mark"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"), block.alias("block")
    )

    def matrix(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]:
        """Numbers, whether they are there, vectors, and marks of queries, for each length of vectors."""
        table = table.combine_chunks()
        column = table.column("vector")
        lengths = np.array([len(v) for v in column.to_pylist()])
        for width in np.unique(lengths).tolist():
            some = table.filter(pa.array(lengths == width))
            values = np.array(some.column("vector").to_pylist(), float).reshape(-1, width)
            keys = some.column("key")
            marks = some.column("mark").to_numpy() if "mark" in some.column_names else None
            yield keys.fill_null(0).to_numpy(), keys.is_valid().to_numpy(), values, marks

    def answer(entries: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if len(entries) and len(queries):
            asked_by_width = {q[2].shape[1]: q for q in matrix(queries)}
            for numbers, there, values, _ in matrix(entries):
                if values.shape[1] in asked_by_width:
                    ids, _, wanted, marks = asked_by_width[values.shape[1]]
                    order = np.lexsort((numbers,))
                    forest = Forest(values[order], trees, bits, seed)
                    best = _best(forest, numbers[order], there[order], ids.tolist(), wanted, k, share)
                    found += [(q, int(marks[place]), n, score) for q, place, n, score in best]
        kinds = (("query_id", pa.int64()), ("mark", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))
        return pa.table({name: pa.array([f[i] for f in found], kind) for i, (name, kind) in enumerate(kinds)})

    by = ["shard", "block"]
    met = stored_side.groupBy(by).cogroup(query_side.groupBy(by)).applyInArrow(
        answer, "query_id bigint, mark bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
