"""Vector codes: product quantisation whose nearest entries are found by geometric near-neighbour access trees.

Vectors become integers, are cut into ``PARTS`` equal consecutive parts, and each part position has a codebook of its
own. A *tree* over a codebook holds split points; for every split point and every child it stores the least and the
greatest distance from the split point to the child's entries. A query's distance to a split point bounds its distance
to each child from below, and children that are strictly farther than the best entry so far are left out as a whole.
Distances for these bounds are rounded away from a decision, the decision itself is made on integers: equally near
entries are all looked at and the lowest index wins, so codes are the same as by comparing with every entry.

On Spark: integers are stored once; in each round every task adds up the parts it assigned to each entry and a grouping
adds the tasks' sums. The driver holds the codebooks (``PARTS`` x entries x width integers) and nothing that grows with
the rows. Rows are never dealt by vector or by key, so copies and hot values make no task larger.

Defined results: rows with null vectors or vectors with null or non-finite components take no part; so do vectors with
another length than the most frequent one that is a multiple of ``PARTS`` (of equally frequent ones, the shortest), and
vectors with a component too large for squared distances to be summed in 64 bits (46,340 at 64 components). Null keys
stand behind all others where the first rows are chosen, equal keys in the order of their vectors; rows, repeated or
not, each get a row; with fewer rows than entries a codebook has that many entries; other columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: split points of a node, and the most entries a leaf has
DEGREE = 4
#: sums by label up to this many rows are sent to every task; more of them are joined by shuffle
LABELS_TO_ALL = 100_000
#: vectors assigned at a time
AT_ONCE = 4096
#: one part in 2**50, far above the error of a square root in double precision
_SLACK = 2.0**-50


def _squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    away = rows - point
    return np.einsum("ij,ij->i", away, away)


class _Node:
    """Split points with the ranges of their distances to each child, or the entries of a leaf."""

    def __init__(self, points: np.ndarray, members: np.ndarray, degree: int) -> None:
        self.members, self.children = members, []
        if len(members) <= degree:
            return
        # split points far from each other: each is the entry farthest from those before it
        chosen = [0]
        nearest = _squared(points[members], points[members[0]])
        while len(chosen) < degree:
            nearest[chosen] = -1
            chosen.append(int(np.argmax(nearest)))
            nearest = np.minimum(nearest, _squared(points[members], points[members[chosen[-1]]]))
        self.members = members[chosen]
        rest = np.delete(members, chosen)
        away = np.array([_squared(points[rest], points[s]) for s in self.members])
        owner = np.argmin(away, axis=0)
        self.low, self.high = np.zeros((2, degree, degree))
        for child in range(degree):
            own = np.append(rest[owner == child], self.members[child])
            for split in range(degree):
                far = np.sqrt(_squared(points[own], points[self.members[split]]).astype(float))
                self.low[split, child], self.high[split, child] = far.min() * (1 - _SLACK), far.max() * (1 + _SLACK)
            self.children.append(_Node(points, rest[owner == child], degree))


class Gnat:
    """A tree over integer points. ``compared`` counts the distances computed so far."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE) -> None:
        self.points, self.compared = np.asarray(points, np.int64), 0
        self.root = _Node(self.points, np.arange(len(self.points)), degree)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index (the lowest of equally near ones) and squared distance of each query's nearest point."""
        index = np.full(len(queries), len(self.points))
        best = np.full(len(queries), np.iinfo(np.int64).max)
        self._visit(self.root, queries, np.arange(len(queries)), index, best)
        return index, best

    def _compare(self, point: int, queries: np.ndarray, rows: np.ndarray, index: np.ndarray, best: np.ndarray) -> np.ndarray:
        found = _squared(queries[rows], self.points[point])
        self.compared += len(rows)
        better = (found < best[rows]) | ((found == best[rows]) & (point < index[rows]))
        index[rows[better]], best[rows[better]] = point, found[better]
        return found

    def _visit(self, node: _Node, queries: np.ndarray, rows: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
        if not len(rows) or not len(node.members):
            return
        # per child, the least distance that any of its entries can have
        bound = np.zeros((len(node.members), len(rows)))
        for place, point in enumerate(node.members):
            open_ = self._open(bound[place], best[rows]) if node.children else np.arange(len(rows))
            found = np.sqrt(self._compare(point, queries, rows[open_], index, best).astype(float))
            if node.children:
                over = found * (1 - _SLACK) - node.high[place][:, None]
                under = node.low[place][:, None] - found * (1 + _SLACK)
                bound[:, open_] = np.maximum(bound[:, open_], np.maximum(over, under))
        for place, child in enumerate(node.children):
            self._visit(child, queries, rows[self._open(bound[place], best[rows])], index, best)

    @staticmethod
    def _open(bound: np.ndarray, best: np.ndarray) -> np.ndarray:
        return np.flatnonzero(bound <= np.sqrt(best.astype(float)) * (1 + _SLACK))


def whole_vectors(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``(key, label, ints)`` of the rows that take part, components as integers."""
    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    inside = rows.where("vector IS NOT NULL AND size(vector) > 0").where(F.size("vector") % PARTS == 0)
    sound = inside.where(F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False))))
    first = sound.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    n = first["n"] if first else PARTS
    # n squares of differences of two such integers stay below 2**63; floor needs one more below
    most = (math.isqrt(2**63 // n) // 2 - 1) / SCALE
    fitting = sound.where(F.size("vector") == n).where(F.forall("vector", lambda x: F.abs(x) <= F.lit(most)))
    return fitting.select("key", "label", F.transform("vector", lambda x: F.floor(x * SCALE).cast("int")).alias("ints"))


def _parts(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Start and integers, by row, part and place, of some vectors at a time."""
    for start in range(0, batch.num_rows, AT_ONCE):
        values = batch.column(column).slice(start, AT_ONCE).flatten().to_numpy(zero_copy_only=False)
        yield start, values.astype(np.int64).reshape(-1, PARTS, width)


def fit_codebooks(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks by part, entry and place of ``vectors(key, ints)``, a stored table."""
    seeds = vectors.orderBy(F.asc_nulls_last("key"), "ints").limit(entries).select("ints").collect()
    if not seeds:
        return np.zeros((PARTS, 0, 0), np.int64)
    width = len(seeds[0]["ints"]) // PARTS
    books = np.array([r["ints"] for r in seeds], np.int64).reshape(-1, PARTS, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for row in _assigned_sums(vectors, books).collect():
            # whole numbers of any size, rounded down
            books[row["part"], row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return books


def _assigned_sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``(part, entry, place, total, n)`` of the entries that have parts nearest to them."""
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books]
        total, n = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, rows in _parts(batch, 0, width):
                for part, tree in enumerate(trees):
                    nearest, _ = tree.nearest(rows[:, part])
                    np.add.at(total[part], nearest, rows[:, part])
                    n[part] += np.bincount(nearest, minlength=entries)
        at = np.argwhere(np.repeat((n > 0)[:, :, None], width, axis=2))
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(at[:, i].astype(np.int32)) for i in range(3)), pa.array(total[tuple(at.T)]), pa.array(n[at[:, 0], at[:, 1]])],
            ["part", "entry", "place", "total", "n"],
        )

    sums = vectors.select("ints").mapInArrow(add, "part int, entry int, place int, total bigint, n bigint")
    return sums.groupBy("part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(28,0)")).alias("total"), F.sum("n").alias("n")
    )


def assign(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``(key, label, code, error)`` of every row: two hex digits per part, squared distances summed over parts."""
    width = books.shape[2]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books]
        for batch in batches:
            for start, rows in _parts(batch, 2, width):
                found = [tree.nearest(rows[:, part]) for part, tree in enumerate(trees)]
                digits = np.stack([f[0] for f in found], axis=1).astype(np.uint8).tobytes().hex()
                codes = [digits[i : i + 2 * PARTS] for i in range(0, len(digits), 2 * PARTS)]
                some = batch.slice(start, AT_ONCE)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(codes, pa.string()), pa.array(sum(f[1] for f in found))],
                    ["key", "label", "code", "error"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = f"key {kinds['key']}, label {kinds['label']}, code string, error bigint"
    return vectors.select("key", "label", "ints").mapInArrow(code, schema)


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """``(key, code, error, label_error, codebooks_sha256)`` of every vector that takes part."""
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    vectors = stored(whole_vectors(df, key, vector, label), "vectors")
    books = fit_codebooks(vectors, entries, rounds)
    coded = stored(assign(vectors, books), "codes")
    by_label = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    if by_label.count() <= LABELS_TO_ALL:
        by_label = F.broadcast(by_label)
    same = coded["label"].eqNullSafe(by_label["label"])
    return coded.join(by_label, same).select(
        F.col("key").alias(key), "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
