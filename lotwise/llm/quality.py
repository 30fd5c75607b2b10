"""Quality scores: ridge regression on random Fourier features of document statistics, then isotonic calibration.

1. ``document_statistics``: a fixed number of shares and means per text, free of language and vocabulary.
2. Random cosine features of the standardised statistics approximate a Gaussian kernel; the statistics themselves and
   a constant are kept beside them.
3. Every task adds up the normal equations of its labelled rows, per fold; sums are added per matrix row. The driver
   gets matrices whose size depends on the number of features alone, and solves them.
4. Every labelled row is scored by the model of the other folds; labels are averaged on a fine grid of these scores and
   made monotone (pooling neighbours). Calibration is linear between the pooled points.

Defined results: null text is empty text, empty texts get the score that their statistics earn; labels other than 0 and
1, null labels and null ids teach nothing; a document labelled more than once counts as often; without any labelled
row, or with one class only, every score is 1 (there is nothing to hold against any document). An empty table gives
an empty table. All rows, long texts included, are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import residue, stored

FEATURES = 160
FOLDS = 3
RIDGE = 1.0
SEED = 11
#: grid of scores for calibration: steps per unit, on scores from -1 to 2
GRID = 1000
ACCEPTED = 0.7

_CLASSES = np.full(256, 7, np.int64)
_CLASSES[[*range(97, 123)]] = 0
_CLASSES[[*range(65, 91)]] = 1
_CLASSES[[*range(48, 58)]] = 2
_CLASSES[[9, 11, 12, 13, 32]] = 3
_CLASSES[10] = 4
_CLASSES[[44, 46]] = 5
_CLASSES[[33, 34, 39, 40, 41, 45, 58, 59, 63]] = 6
_CLASSES[128:] = 8
_PUNCTUATION = np.array([b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ",."])

STATISTICS = (
    "log_bytes", "lower", "upper", "digits", "blanks", "line_ends", "commas_stops", "quotes", "symbols", "beyond_ascii",
    "commonest_mark", "second_mark", "log_words", "word_length", "distinct_words", "commonest_word", "repeats_next",
    "marked_ends", "upper_words", "long_words", "distinct_lines", "line_length", "one_mark_words", "distinct_pairs",
)


def statistics_of(text: str) -> list[float]:
    """The statistics of one text, zeros where nothing can be counted."""
    data = np.frombuffer(text.encode(), np.uint8)
    n = max(1, len(data))
    counts = np.bincount(data, minlength=256)
    shares = np.bincount(_CLASSES, counts, 9) / n
    marks = np.sort(counts[_PUNCTUATION])[::-1] / n
    words = text.split()
    w = max(1, len(words))
    seen: dict[str, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    pairs = set(zip(words, words[1:]))
    lines = [line for line in text.split("\n") if line.strip()]
    letters = shares[0] + shares[1]
    return [
        float(np.log1p(len(data))), shares[0], shares[1] / max(letters, 1e-9), *shares[2:9], marks[0], marks[1],
        float(np.log1p(len(words))), min(40.0, len(data) / w), len(seen) / w if words else 0.0,
        max(seen.values(), default=0) / w, sum(a == b for a, b in zip(words, words[1:])) / w,
        sum(not word[-1].isalnum() for word in words) / w, sum(word.isupper() for word in words) / w,
        sum(len(word) > 20 for word in words) / w, len(set(lines)) / max(1, len(lines)) if lines else 0.0,
        float(np.log1p(len(words) / max(1, len(lines)))), sum(len(word) == 1 and not word.isalnum() for word in words) / w,
        len(pairs) / max(1, len(words) - 1) if pairs else 0.0,
    ]


def document_statistics(text: Column) -> Column:
    """The statistics of a text column as ``array<double>``."""

    def batch(texts: pa.Array) -> pa.Array:
        return pa.array([statistics_of(t or "") for t in texts.to_pylist()], pa.list_(pa.float64()))

    return F.arrow_udf(batch, "array<double>")(text.cast("string"))


@dataclass(frozen=True)
class Features:
    """Standardisation and random cosines; all that scoring needs besides weights."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @staticmethod
    def draw(mean: np.ndarray, scale: np.ndarray, features: int, seed: int) -> "Features":
        random = np.random.default_rng(seed)
        width = np.sqrt(len(mean))  # distance between two standardised rows, to scale
        return Features(
            mean, np.where(scale > 1e-9, scale, 1.0), random.normal(0, 1 / width, (len(mean), features)),
            random.uniform(0, 2 * np.pi, features),
        )

    def of(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -8, 8)
        return np.hstack([np.ones((len(z), 1)), z / np.sqrt(z.shape[1]), np.cos(z @ self.directions + self.phases)])


@dataclass(frozen=True)
class QualityModel:
    features: Features | None
    weights: np.ndarray | None
    points: np.ndarray | None
    levels: np.ndarray | None

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.ones(len(rows))
        return np.interp(self.features.of(rows) @ self.weights, self.points, self.levels)


def isotonic(points: np.ndarray, sizes: np.ndarray, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool neighbours until means rise; points come in order. Returns centres and levels of the pools."""
    pools: list[list[float]] = []
    for p, s, m in zip(points, sizes, means):
        pools.append([p * s, s, m * s])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    array = np.array(pools)
    return array[:, 0] / array[:, 1], array[:, 2] / array[:, 1]


def _matrix(rows: pa.Array, width: int) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if len(rows) else np.zeros((0, width))


def fit_quality(
    labelled: DataFrame, features: int = FEATURES, folds: int = FOLDS, ridge: float = RIDGE, seed: int = SEED
) -> QualityModel:
    """Fit on all rows of ``labelled(stats, label, fold)``; labels 0 and 1, folds 0 .. folds - 1."""
    width = len(STATISTICS)
    sums = labelled.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("ones"),
        *[F.avg(F.get("stats", F.lit(i))).alias(f"m{i}") for i in range(width)],
        *[F.stddev_pop(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(width)],
    ).first()
    if sums["ones"] in (0, sums["n"]):
        return QualityModel(None, None, None, None)
    mean, scale = (np.array([sums[f"{k}{i}"] for i in range(width)]) for k in "ms")
    drawn = Features.draw(mean, scale, features, seed)
    size = 1 + width + features

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, size, size + 1))
        for batch in batches:
            x = drawn.of(_matrix(batch.column(0), width))
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            fold = batch.column(2).to_numpy(zero_copy_only=False)
            for k in range(folds):
                some = x[fold == k]
                total[k] += some.T @ np.column_stack([some, y[fold == k]])
        for k in range(folds):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, k, np.int32)), pa.array(np.arange(size, dtype=np.int32)),
                 pa.array([row.tobytes() for row in total[k]], pa.binary())], ["fold", "place", "sums"]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                values = np.frombuffer(row.as_buffer())
                found[k, i] = found[k, i] + values if (k, i) in found else values.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in found], pa.int32()), pa.array([i for _, i in found], pa.int32()),
             pa.array([v.tobytes() for v in found.values()], pa.binary())], ["fold", "place", "sums"]
        )

    schema = "fold int, place int, sums binary"
    summed = labelled.select("stats", "label", "fold").mapInArrow(equations, schema).repartition("fold", "place")
    parts = np.zeros((folds, size, size + 1))
    for row in summed.mapInArrow(add, schema).collect():
        parts[row["fold"], row["place"]] = np.frombuffer(row["sums"])
    whole = parts.sum(axis=0)
    held = np.diag([0.0] + [ridge] * (size - 1))  # the constant is free

    def solve(equation: np.ndarray) -> np.ndarray:
        return np.linalg.lstsq(equation[:, :size] + held, equation[:, size], rcond=None)[0]

    others = np.array([solve(whole - part) for part in parts])

    def outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = drawn.of(_matrix(batch.column(0), width))
            fold = batch.column(2).to_numpy(zero_copy_only=False)
            scores = np.clip(np.einsum("ij,ij->i", x, others[fold]), -1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.rint(scores * GRID).astype(np.int32)), batch.column(1).cast(pa.int32())], ["step", "label"]
            )

    steps = labelled.select("stats", "label", "fold").mapInArrow(outside, "step int, label int")
    rows = steps.groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean")).collect()
    rows.sort(key=lambda r: r["step"])
    points, levels = isotonic(*(np.array([r[c] for r in rows], float) for c in ("step", "n", "mean")))
    return QualityModel(drawn, solve(whole), points / GRID, levels)


def _taught(
    docs: DataFrame, labels: DataFrame, held_out: Column, key: str, text: str, label: str
) -> tuple[DataFrame, QualityModel]:
    """Statistics of every text, written once, and the model that the labelled ones outside ``held_out`` give."""
    stats = stored(docs.select(F.col(key).alias("key"), document_statistics(F.col(text)).alias("stats")), "statistics")
    taught = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("label IN (0, 1)")
    taught = taught.where(~F.coalesce(held_out, F.lit(False)) & F.col("key").isNotNull())
    fold = residue(F.concat(F.lit("fold "), F.col("key").cast("string")), FOLDS)
    return stats, fit_quality(stored(stats.join(taught, "key").select("stats", "label", fold.alias("fold")), "labelled"))


def quality_scores(
    docs: DataFrame, labels: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """``(key, held_out, score, predicted)`` of every text.

    ``held_out`` is a condition on a column named ``key``; rows for which it holds teach nothing.
    """
    stats, model = _taught(docs, labels, held_out, key, text, label)

    def batch(rows: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(rows, len(STATISTICS))))

    score = F.arrow_udf(batch, "double").asNondeterministic()
    return stats.select("key", score("stats").alias("score")).select(
        F.col("key").alias(key), F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= ACCEPTED).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame, labels: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns.

    Statistics are made again from each row's text, which moves no text between tasks.
    """
    _, model = _taught(docs, labels, held_out, key, text, label)

    def batch(texts: pa.Array) -> pa.Array:
        rows = np.array([statistics_of(t or "") for t in texts.to_pylist()]).reshape(-1, len(STATISTICS))
        return pa.array(model.score(rows) >= ACCEPTED)

    return docs.where(F.arrow_udf(batch, "boolean")(F.col(text).cast("string")))
