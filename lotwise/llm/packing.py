"""Token ids as files of fixed-width bits.

A file is a sequence of segments; each segment is followed by one line end. A segment (little-endian) holds

* the head: ``TOKPACK1``, bytes of the whole segment, bits per id, ids per block, number of documents, number of ids,
  partition number, place of the segment in its partition, ids before it in its partition (8 bytes each);
* documents: ids (8 bytes each, 0 where null), whether the id is there (1 byte each, padded to 8), ends of their token
  ids (8 bytes each);
* blocks: the byte offset of each block of ids in the payload (8 bytes each);
* the payload: every id in the least number of bits that the vocabulary needs, in 64-bit words. A block of 4096 ids
  starts on a new word, so any id is found from its block's offset, and blocks are unpacked in a few array steps.

Files are written and read by Spark, on any file system it knows: a lost task is run again and its half-written files
never count. Documents are dealt out by ranges of (doc_id, hash of text), null ids first, so that neither one large
range nor many rows with one id meet in one task; a file holds a bounded number of segments, a segment at least
``SEGMENT_IDS`` ids unless it is the last, and whole documents only.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import stored
from lotwise.session import scratch_path

MAGIC = b"TOKPACK1"
HEAD = 9  # 8-byte fields
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 19
SEGMENTS_PER_FILE = 16
#: words a worker remembers the ids of, about 200 bytes each; the first ones stay
REMEMBERED = 600_000


def width_of(vocabulary: int) -> int:
    """Least number of bits for ids 0 .. vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> np.ndarray:
    """Ids as 64-bit words, 64 ids in ``width`` words; the last group is filled with zeros."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    groups = -(-len(ids) // 64)
    if width == 16:  # a quarter of a word each: numbers of two bytes, one after the other
        halves = np.zeros(groups * 64, "<u2")
        halves[: len(ids)] = ids
        return halves.view("<u8")
    full = np.zeros((groups, 64), "<u8")
    full.reshape(-1)[: len(ids)] = ids
    words = np.zeros((groups, width), "<u8")
    for j in range(64):
        word, shift = divmod(j * width, 64)
        words[:, word] |= full[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= full[:, j] >> np.uint64(64 - shift)
    return words.reshape(-1)


def unpack(words: np.ndarray, width: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed words."""
    if width == 16:
        return words.view("<u2")[:count].astype("<u4")
    words = words.reshape(-1, width)
    out = np.empty((len(words), 64), "<u8")
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        column = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            column = column | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = column & mask
    return out.reshape(-1)[:count].astype("<u4")


def build_segment(
    doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, width: int, part: int, place: int, before: int
) -> bytes:
    payload = pack(ids, width).view(np.uint8).tobytes()
    blocks = np.arange(-(-len(ids) // BLOCK_IDS), dtype="<u8") * (BLOCK_IDS // 64 * width * 8)
    there = np.zeros(-(-len(doc_ids) // 8) * 8, np.uint8)
    there[: len(doc_ids)] = [d is not None for d in doc_ids]
    body = (
        np.array([d or 0 for d in doc_ids], "<i8").tobytes() + there.tobytes() + np.cumsum(counts).astype("<u8").tobytes()
        + blocks.tobytes() + payload
    )
    head = np.array([8 * HEAD + len(body), width, BLOCK_IDS, len(doc_ids), len(ids), part, place, before], "<u8")
    return MAGIC + head.tobytes() + body


class Segment:
    """One segment in memory: all of it, or any block or document of it, without touching the rest."""

    def __init__(self, data: bytes | memoryview) -> None:
        data = memoryview(data)
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a segment of packed ids")
        head = np.frombuffer(data, "<u8", HEAD - 1, 8)
        self.size, self.width, self.block_ids, n_docs, self.n_ids, self.part, self.place, self.before = map(int, head)
        at = 8 * HEAD
        self.doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        at += 8 * n_docs
        self.there = np.frombuffer(data, np.uint8, n_docs, at).astype(bool)
        at += -(-n_docs // 8) * 8
        self.ends = np.frombuffer(data, "<u8", n_docs, at).astype(np.int64)
        at += 8 * n_docs
        self.blocks = np.frombuffer(data, "<u8", -(-self.n_ids // self.block_ids), at).astype(np.int64)
        self.payload = data[at + 8 * len(self.blocks) : self.size]

    def block(self, number: int) -> np.ndarray:
        """The ids of one block."""
        count = min(self.block_ids, self.n_ids - number * self.block_ids)
        words = np.frombuffer(self.payload, "<u8", -(-count // 64) * self.width, int(self.blocks[number]))
        return unpack(words, self.width, count)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` up to ``end``, from the blocks that hold them."""
        first, last = start // self.block_ids, -(-end // self.block_ids)
        if last - first > 8:  # one run of words: blocks follow each other without gaps
            words = np.frombuffer(self.payload, "<u8", -1, int(self.blocks[first]))
            found = unpack(words[: -(-(end - first * self.block_ids) // 64) * self.width], self.width, end - first * self.block_ids)
        else:
            found = np.concatenate([np.zeros(0, "<u4"), *(self.block(b) for b in range(first, last))])
        return found[start - first * self.block_ids : end - first * self.block_ids]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.ends[number - 1]) if number else 0, int(self.ends[number]))


def segments(content: bytes) -> Iterator[Segment]:
    """The segments of one file."""
    at, data = 0, memoryview(content)
    while at < len(data):
        found = Segment(data[at:])
        yield found
        at += found.size + 1


#: marks at a word's end that are a token run of their own behind a letter or digit
MARKS = ".,;:!?"
#: words that are encoded in one text
JOINED = 200
_LETTERS = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff]+")
_WORD_END = "</w>"
_CUTTING = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _cores(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words in small letters without the marks at their end, and how many marks each has lost.

    That changes no id where what is left ends in a letter or digit: a tokenizer of this kind lower-cases, and takes
    letters, digits and other characters apart. All other words, and those that may hold a special string, stay whole.
    """
    words = words.cast(pa.string())
    cores = pc.ascii_rtrim(pc.ascii_lower(words), MARKS)
    sizes, left = (pc.binary_length(c).to_numpy().astype(np.int64) for c in (words, cores))
    _, offsets, data = cores.buffers()
    data = np.frombuffer(data or b"", np.uint8)
    ends = np.frombuffer(offsets, np.int32)[cores.offset : cores.offset + len(cores) + 1][1:].astype(np.int64)
    last, before = (np.where(left >= n, data[np.maximum(ends - n, 0)], 0) if len(data) else np.zeros(len(left)) for n in (1, 2))
    plain = ((last >= 97) & (last <= 122)) | ((last >= 48) & (last <= 57))
    accented = (before == 0xC3) & (last >= 0x80) & (last <= 0xBF) & (last != 0x97) & (last != 0xB7)
    apart = (plain | accented) & ~pc.match_substring(words, "<").to_numpy(zero_copy_only=False)
    return pc.if_else(pa.array(apart), cores, words), np.where(apart, sizes - left, 0)


class WordTokenizer:
    """Ids of whole texts by a tokenizer that drops white space.

    Such a tokenizer treats what stands between ASCII white space separately, so ids of a word are computed once and
    remembered. ``words_apart=False`` hands over whole texts instead, for any other tokenizer.
    """

    def __init__(self, blob: bytes, words_apart: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        self.tokenizer, self.words_apart = Tokenizer.from_str(blob.decode()), words_apart
        self.remembered: dict[str, bytes] = {}
        self.cut = self._takes_letters_apart(json.loads(blob))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(_WORD_END)]] = True

    @staticmethod
    def _takes_letters_apart(settings: dict) -> bool:
        """Whether the file lower-cases, cuts by the usual pattern and marks ends of words."""
        steps = (settings.get("normalizer") or {}).get("normalizers", [])
        cutters = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [])
        return (
            [n["type"] for n in steps] == ["NFC", "Replace", "Lowercase"]
            and [c["type"] for c in cutters] == ["Split", "ByteLevel"] and not cutters[1]["use_regex"]
            and cutters[0]["pattern"].get("Regex") == _CUTTING and cutters[0]["behavior"] == "Removed" and cutters[0]["invert"]
            and settings["model"]["type"] == "BPE" and settings["model"]["end_of_word_suffix"] == _WORD_END
            and not settings["model"]["dropout"]
        )

    def _one_by_one(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        for start in range(0, len(words), 10_000):
            some = words[start : start + 10_000]
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            yield from ((w, array("I", e.ids).tobytes()) for w, e in zip(some, found))

    def _joined(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words of letters alone: each has exactly one token that ends a word, its last, so many go in one text."""
        for start in range(0, len(words), 50 * JOINED):
            some = words[start : start + 50 * JOINED]
            texts = [" ".join(some[i : i + JOINED]) for i in range(0, len(some), JOINED)]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = array("I", chain.from_iterable(e.ids for e in found))
            stops = ((np.flatnonzero(self.ends[np.frombuffer(ids, np.uint32)]) + 1) * 4).tolist()
            if len(stops) != len(some):
                yield from self._one_by_one(some)
                continue
            raw = ids.tobytes()
            yield from ((w, raw[a:b]) for w, a, b in zip(some, [0, *stops], stops))

    def _ids_of(self, words: list[str]) -> list[bytes]:
        remembered = self.remembered
        out = list(map(remembered.get, words))
        empty = [i for i, found in enumerate(out) if found is None]
        missing = dict.fromkeys(words[i] for i in empty)
        letters = [w for w in missing if _LETTERS.fullmatch(w)] if self.cut else []
        missing.update(self._joined(letters))
        missing.update(self._one_by_one([w for w, ids in missing.items() if ids is None]))
        for i in empty:
            out[i] = missing[words[i]]
        remembered.update(islice(missing.items(), max(0, REMEMBERED - len(remembered))))
        return out

    def _ids_of_words(self, words: pa.Array) -> list[bytes]:
        if not self.cut:
            return self._ids_of(words.to_pylist())
        cores, marks = _cores(words)
        parts, marked = self._ids_of(cores.to_pylist()), np.flatnonzero(marks)
        tails = [w[-n:] for w, n in zip(words.take(pa.array(marked)).to_pylist(), marks[marked].tolist())]
        for i, tail in zip(marked.tolist(), self._ids_of(tails)):
            parts[i] += tail
        return parts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids per text, and all ids one after the other."""
        texts = pc.fill_null(texts, "")
        if not self.words_apart:
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            return np.array([len(e) for e in found], np.int64), np.array([i for e in found for i in e.ids], "<u4")
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        parts = self._ids_of_words(coded.dictionary)
        sizes = np.array([len(p) // 4 for p in parts], np.int64)
        starts, values = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(parts), "<u4")
        codes = coded.indices.to_numpy()
        each = sizes[codes]
        ends = np.cumsum(each)
        places = np.repeat(starts[codes] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
        word_ends = np.concatenate([[0], ends])[np.cumsum(pc.list_value_length(lists).to_numpy())]
        return np.diff(word_ends, prepend=0), values[places]


_TOKENIZERS: dict[tuple[int, bool], WordTokenizer] = {}


def _tokenizer(blob: bytes, words_apart: bool) -> WordTokenizer:
    key = (zlib.crc32(blob), words_apart)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = WordTokenizer(blob, words_apart)
    return _TOKENIZERS[key]


def write_packed(
    docs: DataFrame, tokenizer_path: str, path: str | None = None, end_id: int | None = 1, doc_id: str = "doc_id",
    text: str = "text", words_apart: bool = True, vocabulary: int | None = None,
) -> str:
    """Encode every text, add ``end_id``, and write packed files in ascending order of ``doc_id``; returns the path.

    Null text is empty text, which is the end id alone; repeated ids and null ids are kept as rows of their own; an
    empty table writes no segment. The tokenizer file is read once on the driver: its size does not grow with data.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "packed")
    with open(tokenizer_path, "rb") as f:
        blob = f.read()
    if vocabulary is None:
        from tokenizers import Tokenizer

        vocabulary = Tokenizer.from_str(blob.decode()).get_vocab_size(with_added_tokens=True)
    width = width_of(max(vocabulary, (end_id or 0) + 1))
    batch_rows = 2000

    def to_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        own = _tokenizer(blob, words_apart)
        waiting: list[tuple[list, np.ndarray, np.ndarray]] = []
        place = before = held = 0

        def row() -> pa.RecordBatch:
            names = [d for docs_, _, _ in waiting for d in docs_]
            counts, ids = (np.concatenate([w[i] for w in waiting]) for i in (1, 2))
            segment = build_segment(names, counts, ids, width, part, place, before)
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.binary())], ["segment"])

        for whole in batches:
            for start in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(start, batch_rows)
                counts, ids = own.encode(batch.column(1))
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(counts), end_id)
                    counts = counts + 1
                cut = 0
                ends = np.cumsum(counts)
                for stop in (np.flatnonzero(np.diff((held + ends) // SEGMENT_IDS, prepend=held // SEGMENT_IDS)) + 1).tolist():
                    first = int(ends[cut - 1]) if cut else 0
                    waiting.append((batch.column(0)[cut:stop].to_pylist(), counts[cut:stop], ids[first : int(ends[stop - 1])]))
                    yield row()
                    place, before = place + 1, before + sum(len(w[2]) for w in waiting)
                    waiting, cut = [], stop
                rest = int(ends[cut - 1]) if cut else 0
                if cut < batch.num_rows:
                    waiting.append((batch.column(0)[cut:].to_pylist(), counts[cut:], ids[rest:]))
                held = sum(len(w[2]) for w in waiting)
        if waiting:
            yield row()

    ordered = (
        docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )
    (
        ordered.select("doc_id", "text").mapInArrow(to_segments, "segment binary")
        .select(F.col("segment").cast("string").alias("value"))  # bytes as they are
        .write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(path)
    )
    return path


def read_packed(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents from packed files: ``doc_id, n_tokens, ids_crc32, start`` and, if asked for, ``ids``.

    ``start`` counts the ids of all documents before this one in the order of the files. Only one row per partition
    of the writing job is summed up in order for it.
    """
    fields = "part bigint, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    fields += ", ids array<int>" if with_ids else ""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for s in segments(content.as_buffer()):
                    ids, ends = s.ids(0, s.n_ids), s.ends
                    starts = np.concatenate([[0], ends[:-1]])
                    data = memoryview(ids.view(np.uint8))
                    sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                    columns = [
                        pa.array(np.full(len(ends), s.part)), pa.array(s.doc_ids, mask=~s.there),
                        pa.array(starts + s.before), pa.array(ends - starts), pa.array(sums, pa.int64()),
                    ]
                    names = ["part", "doc_id", "inside", "n_tokens", "ids_crc32"]
                    if with_ids:
                        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                        columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = stored(files.mapInArrow(documents, fields), "unpacked")
    sizes = found.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    return found.join(offsets, "part").select(
        "doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []),
    )
