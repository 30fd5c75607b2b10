"""Toxicity of texts whose words may be disguised: a noisy channel restores them, a classifier scores what is restored.

*Restoring.* Disguised words are observed through a channel that writes letters as look-alikes (``1d10t``), puts
separators between them (``i d i o t``) and repeats them (``idiooot``). Each stretch that can have come through it is a
lattice: every run of one character may stand for one or two of a letter, for a letter it looks like, or for itself,
and a separator may be one or nothing. Viterbi's algorithm finds the way through the lattice that the channel and a
character language model together find likeliest. Plain words have one way only and stay as they are.

*Language model.* Trigrams of letter classes, counted over the words of all texts and interpolated with shorter ones.
Their number depends on the alphabet, not on the data.

*Classifier.* Features of a restored text are its distinct words and the first four, five and six letters of longer
ones. Texts with and without the label are counted per feature, the ``FEATURES`` features that tell most (by the
log-likelihood ratio) are kept, and a logistic regression over them is fitted by Spark ML. About ``TAUGHT`` labelled
texts teach at most, chosen by a hash of their key; with fewer, all do. That bound also holds for the table of labels
that is sent to every task, so texts are never shuffled.

Defined results: null and empty texts have no features and get the score of a text without any; texts of any length are
read whole; rows are independent of each other, repeated ones have the same score; labels other than 0 and 1 and labels
of null keys teach nothing, a key with several labels counts as toxic if one of them is 1; if only one kind of label is
there, or none, all scores are that kind's (0 without labels); other columns are ignored; an empty table gives an empty
table.
"""

from __future__ import annotations

import math
import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import residue, stored, text_slices

#: labelled texts that teach, about and at most
TAUGHT = 200_000
#: features of the classifier, and the least number of texts one must stand in
FEATURES, LEAST_TEXTS = 4096, 4
PREFIXES = (4, 5, 6)
TOXIC = 0.5
#: runs whose features a worker remembers
REMEMBERED = 300_000
SLICE_CHARS = 2_000_000
#: features counted by a task before it hands them on
COUNTED_AT_ONCE = 300_000

# What characters may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s",
}
SEPARATORS = " ._-*~"

#: log probabilities of the channel
_ALIKE, _KEPT_INSIDE, _KEPT_AT_END, _DROPPED_COPY, _KEPT_RUN, _PARTED = (
    math.log(p) for p in (0.1, 0.002, 0.5, 0.02, 0.01, 0.05)
)

_TRAILING = "".join(c for c in LOOKS_LIKE if not c.isalnum())
_MARKS = "".join(re.escape(c) for c in LOOKS_LIKE if not c.isalnum())
_ONE = rf"[\w{_MARKS}]"
_SPACED = re.compile(rf"(?<![^\W_]){_ONE}(?:[{re.escape(SEPARATORS)}]{{1,2}}{_ONE}){{2,}}(?![^\W_])")
# with underscores between stretches: one class is found much faster than two
_RUN = re.compile(rf"{_ONE}+")
_WORD = re.compile(r"[^\W\d_]+")
_THRICE = re.compile(r"([^\W\d_])\1\1")
_FOREIGN = "".join(c for c in LOOKS_LIKE if ord(c) > 0x3FF)
_DISGUISED = re.compile(rf"[0-9{_MARKS}{_FOREIGN}]")
_INVISIBLE = re.compile("[­​-‏⁠﻿]")

#: classes of characters: 0 a boundary, a to z, letters of Latin-1, any other letter
_FIRST_LATIN, _LAST_LATIN = 0xDF, 0xFF
_OTHER = 27 + _LAST_LATIN - _FIRST_LATIN + 1
CLASSES = _OTHER + 1


def letter_class(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    if not c.isalpha():
        return 0
    return 27 + ord(c) - _FIRST_LATIN if _FIRST_LATIN <= ord(c) <= _LAST_LATIN else _OTHER


def _class_table() -> np.ndarray:
    return np.array([letter_class(chr(i)) for i in range(0x3000)] + [_OTHER], np.int64)


def trigram_counts(text: str, table: np.ndarray) -> np.ndarray:
    """Numbers of the trigrams of a text's words, a boundary standing before, between and after them."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    c = np.concatenate([[0, 0], table[np.minimum(points, len(table) - 1)], [0]])
    inside = np.where(c[1:-1] == 0, 0, c[:-2])
    found = (inside * CLASSES + c[1:-1]) * CLASSES + c[2:]
    return found[found > 0]


class LetterModel:
    """Log probabilities of a letter class after two others."""

    def __init__(self, counts: np.ndarray, held: float = 5.0) -> None:
        three = counts.reshape(CLASSES, CLASSES, CLASSES).astype(float)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + CLASSES)
        p2 = (two + held * p1) / (two.sum(axis=1, keepdims=True) + held)
        p3 = (three + held * p2) / (three.sum(axis=2, keepdims=True) + held)
        self.log = array("f", np.log(p3).ravel().astype(np.float32).tobytes())


def letter_model(df: DataFrame, text: str = "text") -> LetterModel:
    """Counts of all texts of ``df``; the driver gets at most ``CLASSES`` ** 3 sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _class_table(), np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for some in text_slices(batch, 0, SLICE_CHARS):
                found = trigram_counts(" ".join(t for t in some.column(0).to_pylist() if t), table)
                total += np.bincount(found, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["trigram", "n"])

    rows = df.select(F.col(text).cast("string")).mapInArrow(count, "trigram int, n bigint")
    counts = np.zeros(CLASSES**3, np.int64)
    for row in rows.groupBy("trigram").agg(F.sum("n").alias("n")).collect():
        counts[row["trigram"]] = row["n"]
    return LetterModel(counts)


def lattice(stretch: str, separated: bool) -> list[list[tuple[str, float]]]:
    """What each run of one character may stand for, with the log probability of the channel."""
    runs = [(c, len(list(same))) for c, same in groupby(stretch)]
    last = max((i for i, (c, _) in enumerate(runs) if c.isalpha()), default=0)
    out = []
    for i, (c, n) in enumerate(runs):
        if separated and c in SEPARATORS and 0 < i < len(runs) - 1 and c not in LOOKS_LIKE:
            out.append([("", 0.0), (" ", _PARTED if n == 1 else 0.0)])
            continue
        ways = [(a * k, _ALIKE * min(n, 2)) for a in LOOKS_LIKE.get(c, "") for k in ((1,) if n == 1 else (1, 2))]
        if c.isalpha():
            ways += [(c, 0.0)] if n == 1 else [(c * 2, 0.0), (c, 0.0 if n > 2 else _DROPPED_COPY)]
            if n > 2:
                ways.append((c * n, _KEPT_RUN))
        else:
            ways.append((c * n, _KEPT_AT_END if i > last else _KEPT_INSIDE))
            if separated and c in SEPARATORS:
                ways += [("", 0.0), (" ", _PARTED)]
        out.append(ways)
    return out


def decode(ways: list[list[tuple[str, float]]], model: LetterModel) -> str:
    """The likeliest way through a lattice; of equally likely ones the first in alphabetical order of states."""
    log = model.log
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in ways:
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (p, q), (score, path) in sorted(states.items()):
            for out, cost in options:
                s, a, b = score + cost, p, q
                for c in out:
                    k = letter_class(c)
                    if k or b:
                        s += log[(a * CLASSES + b) * CLASSES + k]
                    a, b = (b, k) if k else (0, 0)
                known = after.get((a, b))
                if known is None or s > known[0]:
                    after[a, b] = (s, (path, out))
        states = after
    # the end of the stretch is a boundary
    ends = ((s + (log[(p * CLASSES + q) * CLASSES] if q else 0.0), (p, q), path) for (p, q), (s, path) in sorted(states.items()))
    path = max(ends, key=lambda e: e[0])[2]
    parts = []
    while path:
        path, out = path
        parts.append(out)
    return "".join(reversed(parts))


class _Remembered(dict):
    """Values of the latest keys. Keys that are met again move on when the older half goes."""

    def __init__(self, make: Callable[[str], object]) -> None:
        super().__init__()
        self.make, self.earlier = make, {}

    def __missing__(self, key: str) -> object:
        value = self.earlier.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= REMEMBERED // 2:
            self.earlier = dict(self)
            self.clear()
        self[key] = value
        return value


class Restorer:
    """Restores disguised words. Stretches are independent of each other once separated letters are joined."""

    def __init__(self, model: LetterModel) -> None:
        self.model = model
        self.runs = _Remembered(self.run)

    def run(self, s: str) -> str:
        """A run of letters, digits, marks and underscores, each stretch between underscores restored."""
        return "_".join(map(self._stretch, s.split("_"))) if "_" in s else self._stretch(s)

    def _stretch(self, s: str) -> str:
        if s.isascii() and s.isalpha():
            return decode(lattice(s, separated=False), self.model) if _THRICE.search(s) else s
        # marks after the last letter or digit are punctuation
        core = s.rstrip(_TRAILING)
        if not ((_DISGUISED.search(core) or _THRICE.search(core)) and any(c.isalpha() for c in core)):
            return s
        return decode(lattice(core, separated=False), self.model) + s[len(core):]

    def _separated(self, m: re.Match) -> str:
        s = m.group()
        return decode(lattice(s, separated=True), self.model) if any(c.isalpha() for c in s) else s

    def joined(self, text: str) -> str:
        """The lower-cased text in compatibility form, separated letters joined."""
        if not text.isascii():
            text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
        return _SPACED.sub(self._separated, text.lower())

    def restore(self, text: str) -> str:
        return _RUN.sub(lambda m: self.runs[m.group()], self.joined(text))


def _word_features(word: str) -> tuple[str, ...]:
    return (word, *(word[:n] + "-" for n in PREFIXES if len(word) > n))


def features_of(words: str) -> set[str]:
    """Words and beginnings (marked by ``-``) of restored words."""
    return {f for word in _WORD.findall(words) for f in _word_features(word)}


class Reader:
    """Features of whole texts, as far as they are among ``known`` (all without it)."""

    def __init__(self, model: LetterModel, known: set[str] | None = None) -> None:
        self.restorer, self.known = Restorer(model), known
        self.features = _Remembered(self._of)

    def _of(self, run: str) -> tuple[str, ...]:
        words = self.restorer.run(run)
        found = _word_features(words) if words.isalpha() else features_of(words)
        return tuple(found) if self.known is None else tuple(f for f in found if f in self.known)

    def __call__(self, text: str | None) -> set[str]:
        """The same as the features of the restored text, each distinct run restored once."""
        if not text:
            return set()
        runs = set(_RUN.findall(self.restorer.joined(text)))
        return set(chain.from_iterable(map(self.features.__getitem__, runs)))


def restored(text: Column, model: LetterModel) -> Column:
    """The restored form of a text column; null stays null."""

    def batch(texts: pa.Array) -> pa.Array:
        own = Restorer(model)
        return pa.array([None if t is None else own.restore(t) for t in texts.to_pylist()], pa.string())

    return F.arrow_udf(batch, "string")(text.cast("string"))


@dataclass(frozen=True)
class ToxicityModel:
    letters: LetterModel
    bias: float
    weights: dict[str, float]

    def score(self, found: set[str]) -> float:
        # a sum that does not depend on the order of a set
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.bias + math.fsum(self.weights[f] for f in found)))))


def feature_counts(taught: DataFrame, letters: LetterModel) -> DataFrame:
    """``(feature, toxic, clean)``: in how many texts of ``taught(text, label)`` a feature stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(letters)
        counts = Counter(), Counter()
        for batch in batches:
            for some in text_slices(batch, 0, SLICE_CHARS):
                for text, label in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    counts[label].update(reader(text))
                    if sum(map(len, counts)) >= COUNTED_AT_ONCE:
                        yield _counted(*counts)
                        counts = Counter(), Counter()
        yield _counted(*counts)

    rows = taught.select("text", "label").mapInArrow(count, "feature string, clean bigint, toxic bigint")
    return rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _counted(clean: Counter[str], toxic: Counter[str]) -> pa.RecordBatch:
    names = list(clean.keys() | toxic.keys())
    columns = [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in (clean, toxic))]
    return pa.RecordBatch.from_arrays(columns, ["feature", "clean", "toxic"])


def telling_features(counts: DataFrame, toxic: int, clean: int, features: int = FEATURES) -> list[str]:
    """The features whose log-likelihood ratio is greatest, in the order of their names."""
    n = toxic + clean

    def part(seen: Column, all_of_kind: int) -> Column:
        expected = (F.col("toxic") + F.col("clean")) * F.lit(all_of_kind / n)
        inside = F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
        outside = F.lit(all_of_kind) - seen
        return inside + F.when(outside > 0, outside * F.log(outside / (F.lit(all_of_kind) - expected))).otherwise(0.0)

    ratio = part(F.col("toxic"), toxic) + part(F.col("clean"), clean)
    best = counts.where(F.col("toxic") + F.col("clean") >= LEAST_TEXTS).orderBy(F.round(ratio, 9).desc(), "feature").limit(features)
    return sorted(r["feature"] for r in best.select("feature").collect())


def taught_rows(docs: DataFrame, labels: DataFrame, held_out: Column, most: int = TAUGHT) -> DataFrame:
    """``(text, label)`` of ``docs(key, text)`` that teach, by ``labels(key, label)``."""
    kept = labels.where("label IN (0, 1) AND key IS NOT NULL").where(~F.coalesce(held_out, F.lit(False)))
    kept = stored(kept.groupBy("key").agg(F.max("label").alias("label")), "labels")
    n = kept.count()
    if n > most:
        share = F.concat(F.lit("taught "), F.col("key").cast("string"))
        kept = kept.where(residue(share, 1 << 20) < int(most / n * (1 << 20)))
    # bounded by ``most``, whatever the number of labels
    return docs.join(F.broadcast(kept), "key").select("text", "label")


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, held_out: Column, features: int = FEATURES, most: int = TAUGHT
) -> ToxicityModel:
    """Fit on ``docs(key, text)`` and ``labels(key, label)``; rows for which ``held_out`` holds teach nothing."""
    letters = letter_model(docs)
    taught = taught_rows(docs, labels, held_out, most)
    counts = stored(feature_counts(taught, letters), "features")
    known = taught.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    toxic, clean = known["toxic"], known["n"] - known["toxic"]
    names = telling_features(counts, toxic, clean, features) if toxic and clean else []
    if not names:
        share = (toxic + 1e-9) / (known["n"] + 2e-9) if known["n"] else 1e-9
        return ToxicityModel(letters, math.log(share / (1 - share)), {})
    kept = set(names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(letters, kept)
        for batch in batches:
            for some in text_slices(batch, 0, SLICE_CHARS):
                found = [sorted(reader(t)) for t in some.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), some.column(1)], ["found", "label"])

    rows = stored(taught.select("text", "label").mapInArrow(read, "found array<string>, label int"), "taught")
    vectors = CountVectorizerModel.from_vocabulary(names, inputCol="found", outputCol="features")
    vectors.setBinary(True)
    fitted = LogisticRegression(maxIter=60, regParam=1e-4, standardization=False).fit(vectors.transform(rows).select("features", "label"))
    return ToxicityModel(letters, float(fitted.intercept), dict(zip(names, map(float, fitted.coefficients.toArray()))))


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", label: str = "toxic",
    features: int = FEATURES, most: int = TAUGHT,
) -> DataFrame:
    """``(key, held_out, score, predicted)`` of every text; ``held_out`` is a condition on a column named ``key``."""
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    marks = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    model = fit_toxicity(source, marks, held_out, features, most)
    kind = source.schema["key"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.letters, set(model.weights))
        for batch in batches:
            for some in text_slices(batch, 1, SLICE_CHARS):
                scores = [model.score(reader(t)) for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(scores, pa.float64())], ["key", "score"])

    return source.mapInArrow(score, f"key {kind}, score double").select(
        F.col("key").alias(key), F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )
