"""Alignment of two tokenizers over the same bytes.

Tokens of both sides cover the same bytes without gaps, so each token start lies in exactly one token of the other side:
``merge_asof`` finds it, keyed by document, once in each direction. The union of both directions holds every pair of
tokens that overlap (an overlap begins where one of the two begins); places where both sides end cut a document
into groups.

On Spark: one pass encodes every text once and stores, per document, its distinct pairs of ids and how often each is
linked. Documents of a task are put into chunks of some megabytes of text, and each chunk adds up in how many of its
documents a pair stands, so what is shuffled by pair are sums by chunk, not tokens. Sums over the corpus go back to the
chunks they came from and meet the documents there. A pair has at most one row per chunk, a chunk is bounded by its
text, and nothing passes through the driver.

Defined results: texts that are null, empty, or whose tokens do not give back the blank and the text byte by byte on
either side have no tokens: zeros and an empty digest; strings of special tokens are plain text; texts of any length are
encoded whole (a text longer than a chunk is a chunk of its own); rows are independent of each other and each counts as
a document, repeated or not; keys may be null or repeated; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lotwise.llm.common import stored, text_slices

#: characters of the texts that make a chunk, and of those that are encoded at a time
CHUNK_CHARS = 8_000_000
SLICE_CHARS = 200_000


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and all others as characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Side:
    """Ids of texts, and the bytes of each id."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)

    def ids(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class ByteSide(_Side):
    """A byte-level vocabulary of the tokenizers library; a blank stands before each text.

    Where the file says that texts are cut by the usual pattern and that an earlier merge is a smaller id, merging by
    smallest id gives the same ids several times as fast; otherwise the library encodes itself.
    """

    def __init__(self, blob: bytes, pattern: str) -> None:
        spec = json.loads(blob)
        vocab, table = spec["model"]["vocab"], byte_of_character()
        special = {t["content"] for t in spec["added_tokens"]}
        names = {i: name for name, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        plain = {name: bytes(table[c] for c in name) for name in names.values() if name not in special and set(name) <= table.keys()}
        super().__init__([plain.get(names.get(i, ""), names.get(i, "").encode()) for i in range(max(names) + 1)])
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        cut = spec["pre_tokenizer"] or {}
        usual = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        self.ranked = self.tokenizer = None
        if usual and not spec["normalizer"] and all(x < y for x, y in zip(merged, merged[1:])):
            ranks = {plain[n]: i for n, i in vocab.items() if n in plain}
            self.ranked = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        else:
            self.tokenizer = Tokenizer.from_str(blob.decode())
            self.tokenizer.encode_special_tokens = True
            self.tokenizer.no_padding()
            self.tokenizer.no_truncation()

    def ids(self, texts: list[str]) -> list[list[int]]:
        # one text at a time: threads of its own are not for a task that has one core
        if self.ranked:
            return [self.ranked.encode_ordinary(" " + t) for t in texts]
        return [self.tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts]


class PieceSide(_Side):
    """A sentencepiece model, which puts a blank before each text itself."""

    def __init__(self, blob: bytes) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        size = self.model.get_piece_size()
        super().__init__([
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(self.model.id_to_piece(list(range(size))))
        ])

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


class Aligned:
    """Tokens of some documents, one after the other, with their links and groups."""

    def __init__(self, a_ids: list[list[int]], b_ids: list[list[int]], a: _Side, b: _Side) -> None:
        self.n_a, self.n_b = np.array([len(x) for x in a_ids], np.int64), np.array([len(x) for x in b_ids], np.int64)
        self.a, self.b = _flat(a_ids), _flat(b_ids)
        places = np.arange(len(a_ids))
        self.a_doc, self.b_doc = np.repeat(places, self.n_a), np.repeat(places, self.n_b)
        self.a_end, self.b_end = np.cumsum(a.sizes[self.a]), np.cumsum(b.sizes[self.b])
        # documents stand one behind the other, so starts rise over all of them
        left = pd.DataFrame({"start": self.a_end - a.sizes[self.a], "doc": self.a_doc, "a": np.arange(len(self.a))})
        right = pd.DataFrame({"start": self.b_end - b.sizes[self.b], "doc": self.b_doc, "b": np.arange(len(self.b))})
        from_a = pd.merge_asof(left, right, on="start", by="doc")
        from_b = pd.merge_asof(right, left, on="start", by="doc")
        # tokens that start together find each other in both directions
        later = from_b["start"].to_numpy() != left["start"].to_numpy()[from_b["a"].to_numpy()]
        self.links_a = np.concatenate([from_a["a"].to_numpy(), from_b["a"].to_numpy()[later]])
        self.links_b = np.concatenate([from_a["b"].to_numpy(), from_b["b"].to_numpy()[later]])
        cuts = np.intersect1d(self.a_end, self.b_end, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(cuts, self.a_end), np.searchsorted(cuts, self.b_end)
        self.a_last, self.b_last = np.isin(self.a_end, cuts, assume_unique=True), np.isin(self.b_end, cuts, assume_unique=True)
        self.n_groups = np.bincount(self.a_doc[self.a_last], minlength=len(a_ids))
        self.n_links = np.bincount(self.a_doc[self.links_a], minlength=len(a_ids))

    def group_texts(self) -> Iterator[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        of_a = np.concatenate([[0], np.cumsum(np.bincount(self.a_group))])
        of_b = np.concatenate([[0], np.cumsum(np.bincount(self.b_group))])
        line = np.empty(len(self.a) + len(self.b), object)
        line[np.arange(len(self.a)) + of_b[self.a_group]] = _written(self.a, self.a_last, b"|")
        line[np.arange(len(self.b)) + of_a[self.b_group + 1]] = _written(self.b, self.b_last, b";")
        line = line.tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        for start, end in zip([0, *ends], ends):
            yield b"".join(line[start:end])[:-1]

    def pairs(self, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair of ids as one number and number of links of each distinct pair of a document."""
        pair = self.a[self.links_a] * b_size + self.b[self.links_b]
        order = np.lexsort((pair, self.a_doc[self.links_a]))
        doc, pair = self.a_doc[self.links_a][order], pair[order]
        first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])])) if len(pair) else order
        return doc[first], pair[first], np.diff(np.append(first, len(pair)))


def _flat(rows: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(rows), np.int64, sum(map(len, rows)))


def _written(ids: np.ndarray, last: np.ndarray, mark: bytes) -> np.ndarray:
    distinct, place = np.unique(ids, return_inverse=True)
    texts = [str(i).encode() for i in distinct.tolist()]
    table = np.array([t + b"," for t in texts] + [t + mark for t in texts] + [b""], object)
    return table[place + last * len(distinct)]


class Pair:
    """Two vocabularies, and the pattern by which byte-level ones usually cut texts. Their files are read once on the driver and travel with the functions; their size is that of
    vocabularies and does not depend on the data."""

    def __init__(self, byte_path: str, piece_path: str, pattern: str) -> None:
        self.blobs, self.pattern = tuple(open(path, "rb").read() for path in (byte_path, piece_path)), pattern

    def sides(self) -> tuple[ByteSide, PieceSide]:
        return _sides(*self.blobs, self.pattern)

    def aligned(self, texts: list[str | None]) -> Aligned:
        a, b = self.sides()
        sound = [t or "" for t in texts]
        given = [i for i, t in enumerate(sound) if t]
        a_ids: list[list[int]] = [[] for _ in sound]
        b_ids: list[list[int]] = [[] for _ in sound]
        some = [sound[i] for i in given]
        for i, text, left, right in zip(given, some, a.ids(some), b.ids(some)):
            data = b" " + text.encode()
            if a.bytes_of(left) == data and b.bytes_of(right) == data:
                a_ids[i], b_ids[i] = left, right
        return Aligned(a_ids, b_ids, a, b)


@lru_cache(maxsize=2)
def _sides(byte_blob: bytes, piece_blob: bytes, pattern: str) -> tuple[ByteSide, PieceSide]:
    """One pair per worker process and vocabularies."""
    return ByteSide(byte_blob, pattern), PieceSide(piece_blob)


def token_groups(text: Column, pair: Pair) -> Column:
    """The groups of a text column as ``array<struct<a: array<int>, b: array<int>>>``."""

    def groups(texts: pa.Array) -> pa.Array:
        out = []
        for batch in text_slices(pa.RecordBatch.from_arrays([texts], ["text"]), 0, SLICE_CHARS):
            for line in pair.aligned(batch.column(0).to_pylist()).group_texts():
                sides = [group.split("|") for group in line.decode().split(";")] if line else []
                out.append([{"a": [int(i) for i in a.split(",")], "b": [int(i) for i in b.split(",")]} for a, b in sides])
        return pa.array(out, pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])))

    return F.arrow_udf(groups, "array<struct<a: array<int>, b: array<int>>>")(text.cast("string"))


_LINKED = (
    "chunk bigint, key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "places array<int>, times array<int>, pairs array<bigint>"
)


def linked(df: DataFrame, pair: Pair, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text, and one per chunk with its pairs and the number of its texts each stands in.

    ``places`` of a text are places in the pairs of its chunk, ``times`` how often each is linked.
    """
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b_size = len(pair.sides()[1].sizes)
        chunk = TaskContext.get().partitionId() << 32
        waiting: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
        chars = 0
        for batch in batches:
            for some in text_slices(batch, 1, SLICE_CHARS):
                texts = some.column(1).to_pylist()
                waiting.append(_documents(some.column(0), pair.aligned(texts), b_size))
                chars += sum(len(t) for t in texts if t)
                if chars >= CHUNK_CHARS:
                    yield from _chunk(chunk, waiting)
                    chunk, chars, waiting = chunk + 1, 0, []
        if waiting:
            yield from _chunk(chunk, waiting)

    return source.mapInArrow(run, _LINKED.format(kind=kind))


def _documents(keys: pa.Array, found: Aligned, b_size: int) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    doc, pairs, times = found.pairs(b_size)
    ends = np.searchsorted(doc, np.arange(len(keys) + 1)).astype(np.int32)
    digests = [hashlib.sha256(line).hexdigest() if line else "" for line in found.group_texts()]
    rows = pa.RecordBatch.from_arrays(
        [keys, *map(pa.array, (found.n_a, found.n_b, found.n_groups, found.n_links)), pa.array(digests, pa.string()),
         pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32)))],
        ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "times"],
    )
    return rows, pairs, ends


def _chunk(chunk: int, parts: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    schema = ["chunk", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times", "pairs"]
    distinct, place, docs = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True, return_counts=True)
    start = 0
    for rows, pairs, ends in parts:
        places = pa.ListArray.from_arrays(pa.array(ends), pa.array(place[start : start + len(pairs)].astype(np.int32)))
        start += len(pairs)
        n = rows.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, chunk)), *rows.columns[:6], places, rows.column("times"), pa.nulls(n, pa.list_(pa.int64()))], schema
        )
    if len(distinct):
        kind = parts[0][0].schema.field("key").type
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk]), pa.nulls(1, kind), *(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.string()),
             pa.nulls(1, pa.list_(pa.int32())), pa.array([docs.astype(np.int32)], pa.list_(pa.int32())),
             pa.array([distinct], pa.list_(pa.int64()))], schema,
        )


def pair_counts(rows: DataFrame, b_size: int) -> DataFrame:
    """``(pair, n, best)`` of stored ``linked`` rows: in how many texts a pair stands, and whether no other pair with
    the same id on the first side stands in more."""
    counted = _chunk_pairs(rows).groupBy("pair").agg(F.sum("docs").alias("n"))
    counted = stored(counted.select((F.col("pair") / b_size).cast("bigint").alias("a"), "pair", "n"), "pairs")
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    return counted.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _chunk_pairs(rows: DataFrame) -> DataFrame:
    every = rows.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "one"))
    return every.select("chunk", "place", F.col("one.pairs").alias("pair"), F.col("one.times").alias("docs"))


def alignment(df: DataFrame, pair: Pair, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every text."""
    rows = stored(linked(df, pair, key, text), "linked")
    totals = stored(pair_counts(rows, len(pair.sides()[1].sizes)), "pair_counts")
    back = _chunk_pairs(rows).join(totals, "pair").select(F.col("chunk").alias("home"), "place", "n", "best")
    texts = rows.where("pairs IS NULL").drop("pairs")
    kind = rows.schema["key"].dataType.simpleString()
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        place = right.column("place").to_numpy()
        count[place], best[place] = right.column("n").to_numpy(), right.column("best").to_numpy()
        left = left.combine_chunks()
        places, times = (left.column(c).combine_chunks() for c in ("places", "times"))
        ends = np.concatenate([[0], np.cumsum(places.value_lengths().to_numpy())])
        places, times = places.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        sums = [np.concatenate([[0], np.cumsum(v[places] * times)]) for v in (best, count)]
        return pa.Table.from_arrays(
            [*(left.column(c) for c in names[:5]), *(pa.array(np.diff(s[ends])) for s in sums), left.column("groups_sha256")], names
        )

    out = texts.groupBy("chunk").cogroup(back.groupBy("home")).applyInArrow(
        score, f"key {kind}, " + ", ".join(f"{n} bigint" for n in names[1:7]) + ", groups_sha256 string"
    )
    return out.withColumnRenamed("key", key)
