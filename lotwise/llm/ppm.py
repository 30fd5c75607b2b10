"""Language-model scores by partial matching of byte contexts.

The model is a trie of byte contexts up to ``ORDER`` with the bytes that followed them in the training texts. A byte's
probability comes from the longest known context: counts are discounted by one half, what the discount frees is the
escape to the next shorter context, and there the bytes already offered by the longer context are excluded. Below the
empty context all remaining bytes are equally likely. A text is its words, A-Z lower-cased, with one blank between
them and one end byte, so probabilities of all texts sum to one.

The log probability of a byte depends on itself and the ``ORDER`` bytes before it alone, a *gram*. So

1. texts are put into chunks by ranges of (id, hash of text), cut by bytes; every chunk counts its distinct grams and words;
2. counts are summed over chunks; grams that end in the same two context bytes form one branch of the trie and meet in
   one task (shorter contexts have at most 65,536 counts, which every task gets), where each gram gets its log
   probability;
3. each chunk gets the values of its own grams and of its words, meets its texts, and scores them.

Nothing passes through the driver but those short-context counts and a few sums. Words that stand in one chunk only are
not sent anywhere: the chunk counts them itself. Counts and values travel as packed numbers, one row per chunk and
branch or range of words.

Defined results: null and empty texts have no words and consist of the end; rows with null ids count as training rows,
stand before all others and keep a null id (values are rounded to four-byte floats, a text's sum is not); repeated rows count and are scored as often as they stand there; with
no training text at all every byte is equally likely; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import stored, text_slices
from lotwise.llm.shingles import mix, word_numbers

ORDER = 5  # at most 5: what a branch does not share of a gram is packed into four bytes
START, END = 0xFF, 0xFE  # bytes that no UTF-8 text has
SYMBOLS = 255  # all bytes and the end, without the start
#: bytes of text that a chunk has on average, and at most about twice as many or those of one text
CHUNK_BYTES = 40_000_000
#: bytes that a row counts besides its text
ROW_BYTES = 64
#: parts of a chunk whose bytes are summed apart, so that chunks are cut between them
MARKS = 16
#: bytes of text that are turned into arrays at once
PIECE_BYTES = 2_000_000
#: bytes of text that are scored at once; a byte takes some 80 bytes of memory while it is looked up
SCORED_BYTES = 500_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def normal_bytes(text: str | None) -> bytes:
    return b" ".join((text or "").encode().translate(_LOWER).split())


def grams_of(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of normalised texts one after the other, and how many each text has."""
    pad = bytes([START]) * order
    data = np.frombuffer(b"".join(pad + t + bytes([END]) for t in texts), np.uint8).astype(np.int64)
    codes = np.zeros(max(0, len(data) - order), np.int64)
    for i in range(order + 1):
        codes = (codes << 8) | data[i : i + len(codes)]
    return codes[(codes & 0xFF) != START], np.array([len(t) + 1 for t in texts], np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _place(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, -1 where it is not there."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _found(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, all of them there; they are looked up in order, which memory caches serve better."""
    order = np.argsort(keys)
    out = np.empty(len(keys), np.int64)
    out[order] = np.searchsorted(sorted_keys, keys[order])
    return out


class Level:
    """All contexts of one length: their bytes' counts, totals, and what a context excludes from the next shorter one."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.codes, self.counts = codes, counts
        first = np.flatnonzero(np.concatenate([[True], (codes[1:] >> 8) != (codes[:-1] >> 8)])) if len(codes) else np.zeros(0, int)
        self.contexts = codes[first] >> 8
        self.first = first
        self.totals = np.add.reduceat(counts, first) if len(first) else counts
        self.kinds = np.diff(np.append(first, len(codes)))
        self.excluded = np.zeros(len(first), np.int64)

    def exclude_from(self, shorter: "Level", length: int) -> None:
        own = _place(shorter.codes, self.codes & ((1 << 8 * length) - 1))
        if len(self.first):
            self.excluded = np.add.reduceat(np.where(own >= 0, shorter.counts[own], 0), self.first)


class Trie:
    """Levels of contexts from the empty one up to ``order``; ``low`` are counts of (context byte, byte) codes of all
    texts, ``codes`` and ``counts`` the grams of this branch."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray], order: int) -> None:
        seen = counts > 0
        codes, counts = codes[seen], counts[seen]
        self.order, self.levels = order, []
        for k in range(order + 1):
            if k < 2:
                keys, sums = _summed(low[0] & ((1 << 8 * (k + 1)) - 1), low[1])
            else:
                keys, sums = _summed(codes & ((1 << 8 * (k + 1)) - 1), counts)
            self.levels.append(Level(keys, sums))
        for k in range(1, order + 1):
            self.levels[k].exclude_from(self.levels[k - 1], k)

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's last byte after the others."""
        out = np.zeros(len(grams))
        open_, child = np.arange(len(grams)), np.full(len(grams), -1)
        for k in range(self.order, -1, -1):
            level, codes = self.levels[k], grams[open_] & ((1 << 8 * (k + 1)) - 1)
            context = _place(level.contexts, codes >> 8)
            known = context >= 0
            total = np.where(known, level.totals[context], 0) if len(level.totals) else np.zeros(len(codes), np.int64)
            kinds = np.where(known, level.kinds[context], 0) if len(level.kinds) else np.zeros(len(codes), np.int64)
            below = child[open_]
            escaped = below >= 0
            if k < self.order and escaped.any():
                longer = self.levels[k + 1]
                total = total - np.where(escaped, longer.excluded[below], 0)
                kinds = kinds - np.where(escaped, longer.kinds[below], 0)
            own = _place(level.codes, codes)
            hit = own >= 0
            if hit.any():
                out[open_[hit]] += np.log10((2 * level.counts[own[hit]] - 1) / (2 * total[hit]))
            escape = known & ~hit & (kinds > 0)
            out[open_[escape]] += np.log10(kinds[escape] / (2 * total[escape]))
            child[open_[known]] = context[known]
            child[open_[~known]] = -1
            open_ = open_[~hit]
        if len(open_):
            out[open_] -= np.log10(SYMBOLS - len(self.levels[0].codes))
        return out


def _pieces(texts: list[str | None], most: int | None = None) -> Iterator[list[bytes]]:
    most = most or PIECE_BYTES
    piece, size = [], 0
    for t in texts:
        piece.append(normal_bytes(t))
        size += len(piece[-1])
        if size >= most:
            yield piece
            piece, size = [], 0
    if piece:
        yield piece


def _words_of(piece: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of normalised texts, and how many each text has."""
    starts, numbers = word_numbers(b" ".join(piece))
    ends = np.cumsum([len(t) + 1 for t in piece])
    return mix(numbers).view(np.int64), np.diff(np.searchsorted(starts, ends), prepend=0)


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Runs of numbers, from each cut to the next, as binary values."""
    offsets = (np.append(cuts, len(values)) * values.itemsize).astype(np.int32)
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _numbers(column: pa.ChunkedArray | pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Packed numbers of a binary column one after the other, and how many each row has; copied once at most."""
    values, sizes = [np.zeros(0, kind)], [np.zeros(0, np.int64)]
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        _, offsets, data = part.buffers()
        if len(part):
            at = np.frombuffer(offsets, np.int32)[part.offset : part.offset + len(part) + 1].astype(np.int64)
            if data is not None:
                values.append(np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind))
            sizes.append(np.diff(at) // np.dtype(kind).itemsize)
    return (values[1] if len(values) == 2 else np.concatenate(values)), np.concatenate(sizes)


def _cuts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _split_grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two context bytes that name a gram's branch, and the rest of it."""
    return (codes >> 8) & 0xFFFF, ((codes >> 24) << 8 | codes & 0xFF).astype(np.uint32)


def _join_grams(branch: np.ndarray | int, rest: np.ndarray) -> np.ndarray:
    rest = rest.astype(np.int64)
    return (rest >> 8) << 24 | branch << 8 | rest & 0xFF


class _Tally:
    """Sums per key that stay small while parts are added."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, times: np.ndarray) -> None:
        # keys of texts that are not learned from are listed with a count of 0
        learns = times > 0
        self.waiting.append(_summed(keys, times) if times.max(initial=0) > 1 else _summed(keys[learns]))
        if not learns.all():
            others = np.unique(keys[~learns])
            self.waiting.append((others, np.zeros(len(others), np.int64)))
        self.held += sum(len(w[0]) for w in self.waiting[-2:])
        if self.held > 500_000 + len(self.keys):
            self.settle()

    def settle(self) -> None:
        parts = [(self.keys, self.counts), *self.waiting]
        self.keys, self.counts = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        self.waiting, self.held = [], 0


def _marks(sizes: DataFrame, mark_bytes: int, heavy_bytes: int) -> DataFrame:
    """Runs of about ``mark_bytes`` in the order of (key, hash): the first pair and the bytes of each.

    Repeated rows that are heavy together have a run of their own, with the bytes of one of them.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        first = None
        for batch in batches:
            found: list[tuple] = []
            for key, h, size, n in zip(*[c.to_pylist() for c in batch.columns]):
                heavy = n > 1 and size > heavy_bytes
                if first is not None and (heavy or held >= mark_bytes):
                    found.append((*first, held, False))
                    first, held = None, 0
                if heavy:
                    found.append((key, h, size // n, True))
                else:
                    first, held = first or (key, h), held + size
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [()] * 4, types(batch))], names)
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*first, held, False), types(batch))], names)

    def types(batch: pa.RecordBatch) -> list[pa.DataType]:
        return [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.bool_()]

    names = ["key", "h", "bytes", "heavy"]
    kind = sizes.schema["key"].dataType.simpleString()
    ordered = sizes.repartitionByRange("key", "h").sortWithinPartitions("key", "h")
    return ordered.mapInArrow(runs, f"key {kind}, h bigint, bytes bigint, heavy boolean")


def _chunked(docs: DataFrame, key: str, text: str, held_out: Column) -> tuple[DataFrame, int]:
    """``(key, text, held_out, copies, chunk)`` and the number of chunks: ranges of (key, hash of text) with about
    ``CHUNK_BYTES`` of text.

    Rows that agree in both and have more than that together are one row with a number of ``copies``. Only runs of
    bytes, some for each chunk, reach the driver.
    """
    rows = docs.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.xxhash64(F.col(text).cast("string")).alias("h"),
    )
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + ROW_BYTES
    sizes = stored(rows.groupBy("key", "h").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n")), "sizes")
    marks = _marks(sizes, CHUNK_BYTES // MARKS, CHUNK_BYTES).collect()
    marks.sort(key=lambda r: (r["key"] is not None, r["key"] if r["key"] is not None else 0, r["h"]))
    total = sum(r["bytes"] for r in marks)
    most = -(-total // max(1, -(-total // CHUNK_BYTES)))
    bounds, held = [], 0
    for r in marks:
        if held and held + r["bytes"] // 2 >= most:
            bounds.append(r)
            held = 0
        held += r["bytes"]
    kind = rows.schema["key"].dataType

    def pairs(found: list) -> Column:
        return F.array(*[F.struct(F.lit(r["key"]).cast(kind).alias("key"), F.lit(r["h"]).cast("bigint").alias("h")) for r in found])

    if bounds:  # the number of bounds that are not above a row's pair, by halving
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
        cuts, start = pairs(bounds), F.struct(F.lit(0).alias("at"), F.struct("key", "h").alias("own"))
        chunk = F.aggregate(
            steps, start,
            lambda a, s: F.struct(
                F.when(F.get(cuts, a["at"] + s - 1) <= a["own"], a["at"] + s).otherwise(a["at"]).alias("at"), a["own"].alias("own")
            ),
            lambda a: a["at"],
        ).cast("bigint")
    else:
        chunk = F.lit(0).cast("bigint")
    columns = ["key", "text", "held_out", "copies", "chunk"]
    rows = rows.withColumn("chunk", chunk).withColumn("copies", F.lit(1).cast("bigint"))
    if heavy := [r for r in marks if r["heavy"]]:
        many = F.exists(pairs(heavy), lambda p: p.eqNullSafe(F.struct("key", "h")))
        once = rows.where(many).groupBy("key", "text", "held_out", "chunk").agg(F.sum("copies").alias("copies"))
        rows = rows.where(~many).select(columns).unionByName(once)
    return rows.select(columns), len(bounds) + 1


def _repeated(df: DataFrame) -> DataFrame:
    """Each row as often as ``copies`` says, without long arrays."""
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / 10_000)))
    some = F.least(F.lit(10_000), F.col("copies") - 10_000 * F.col("__part"))
    return df.withColumn("__part", part).withColumn("__one", F.explode(F.sequence(F.lit(1).cast("bigint"), some))).drop("__part", "__one", "copies")


PACKED = "kind int, chunk bigint, part bigint, items binary, n binary"


def _tallies(rows: DataFrame, order: int, word_bits: int) -> DataFrame:
    """Counts in training texts per chunk, packed: grams by branch (kind 0), words by range (1), short contexts (2)."""

    def packed(kind: int, chunk: int, part: np.ndarray, items: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        cuts = _cuts(part)
        if counts.max(initial=0) >> 32:
            raise OverflowError("a count of one chunk needs more than 32 bits")
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(cuts), kind, np.int32)), pa.array(np.full(len(cuts), chunk, np.int64)),
             pa.array(part[cuts].astype(np.int64)), _binary(items, cuts), _binary(counts.astype(np.uint32), cuts)],
            ["kind", "chunk", "part", "items", "n"])

    def out(chunk: int, found: tuple[_Tally, _Tally]) -> Iterator[pa.RecordBatch]:
        grams, words = found
        grams.settle()
        words.settle()
        branch, rest = _split_grams(grams.keys)
        place = np.argsort(branch << 32 | rest)
        yield packed(0, chunk, branch[place], rest[place], grams.counts[place])
        low, sums = _summed(grams.keys & 0xFFFF, grams.counts)
        yield packed(2, chunk, low >> 8, low.astype(np.uint32), sums)
        ranges = (words.keys.view(np.uint64) >> np.uint64(64 - word_bits)).astype(np.int64)
        yield packed(1, chunk, ranges, words.keys, words.counts)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, tuple[_Tally, _Tally]] = {}
        for batch in batches:
            numbers = batch.column(2).to_numpy(zero_copy_only=False)
            times = np.where(batch.column(1).to_numpy(zero_copy_only=False), 0, batch.column(3).to_numpy())
            for chunk in np.unique(numbers).tolist():
                rows = np.flatnonzero(numbers == chunk)
                found, at = open_.setdefault(chunk, (_Tally(), _Tally())), 0
                for piece in _pieces(batch.column(0).take(pa.array(rows)).to_pylist()):
                    own = times[rows[at : at + len(piece)]]
                    at += len(piece)
                    for t, (keys, sizes) in zip(found, (grams_of(piece, order), _words_of(piece))):
                        t.add(keys, np.repeat(own, sizes))
            # chunks come in order where ids do; earlier ones are handed on
            while len(open_) > 2:
                chunk = next(iter(open_))
                yield from out(chunk, open_.pop(chunk))
        for chunk, found in open_.items():
            yield from out(chunk, found)

    return rows.select("text", "held_out", "chunk", "copies").mapInArrow(tally, PACKED)


def short_contexts(tallies: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (context byte, byte) and their counts, at most 65,536."""

    def add(table: pa.Table) -> pa.Table:
        items, counts = (_numbers(table.column(c), "<u4")[0].astype(np.int64) for c in ("items", "n"))
        codes, sums = _summed(items, counts)
        return pa.table({"code": pa.array(codes), "n": pa.array(sums)})

    rows = tallies.where("kind = 2").groupBy("part").applyInArrow(add, "code bigint, n bigint").where("n > 0").collect()
    rows.sort(key=lambda r: r["code"])
    return tuple(np.array([r[c] for r in rows], np.int64) for c in ("code", "n"))


def gram_values(tallies: DataFrame, low: tuple[np.ndarray, np.ndarray], order: int) -> DataFrame:
    """The packed grams of every chunk with their log10 probabilities in place of the counts."""

    def branch(table: pa.Table) -> pa.Table:
        rest, sizes = _numbers(table.column("items"), "<u4")
        counts, _ = _numbers(table.column("n"), "<u4")
        codes, place = np.unique(_join_grams(table.column("part")[0].as_py(), rest), return_inverse=True)
        sums = np.bincount(place, counts, len(codes)).astype(np.int64)
        values = Trie(codes, sums, low, order).log10(codes).astype("<f4")[place]
        return pa.table({"kind": table.column("kind"), "chunk": table.column("chunk"), "part": table.column("part"),
                         "items": table.column("items"), "n": _binary(values, np.cumsum(sizes) - sizes)})

    return tallies.where("kind = 0").groupBy("part").applyInArrow(branch, PACKED)


def shared_words(tallies: DataFrame) -> DataFrame:
    """The packed words of every chunk that other chunks have too, with their counts over all chunks.

    The first row of each range of words also has the sums of the range: ``tokens`` and distinct ``words``.
    """

    def count(table: pa.Table) -> pa.Table:
        items, sizes = _numbers(table.column("items"), "<i8")
        counts, _ = _numbers(table.column("n"), "<u4")
        row = np.repeat(np.arange(len(sizes)), sizes)
        chunk = table.column("chunk").to_numpy()[row]
        words, place = np.unique(items, return_inverse=True)
        sums = np.bincount(place, counts, len(words))
        order = np.argsort(place, kind="stable")
        first = _cuts(place[order])
        ranges = chunk[order]
        several = np.minimum.reduceat(ranges, first) < np.maximum.reduceat(ranges, first) if len(first) else np.zeros(0, bool)
        kept = several[place]
        left = np.bincount(row[kept], minlength=len(sizes))
        head = np.arange(len(sizes)) == 0
        cuts = np.cumsum(left) - left
        return pa.table({
            "kind": table.column("kind"), "chunk": table.column("chunk"), "part": table.column("part"),
            "items": _binary(items[kept], cuts), "n": _binary(sums[place][kept].astype("<f8"), cuts),
            "tokens": pa.array(np.where(head, int(sums.sum()), 0)), "words": pa.array(np.where(head, int((sums > 0).sum()), 0)),
        })

    schema = f"{PACKED}, tokens bigint, words bigint"
    return tallies.where("kind = 1").groupBy("part").applyInArrow(count, schema)


def text_scores(
    docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", order: int = ORDER
) -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)``; ``held_out`` is a condition on ``docs``.

    The base is that of single tokens, with a tenth added to every count and one token for all unknown ones.
    """
    rows, chunks = _chunked(docs, key, text, held_out)
    tallies = stored(_tallies(rows, order, max(8, (2 * chunks).bit_length())), "tallies")
    words = stored(shared_words(tallies), "words")
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "words")]).first()
    ends = rows.where(~F.col("held_out")).agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    total = sums["tokens"] + ends
    distinct = sums["words"] + (1 if ends else 0)
    end_value = float(np.log10(ends + 0.1))
    known = gram_values(tallies, short_contexts(tallies), order).unionByName(words.drop("tokens", "words"))

    def score(texts: pa.Table, facts: pa.Table) -> pa.Table:
        kind, part = (facts.column(c).to_numpy() for c in ("kind", "part"))
        # a row's grams are in order already, so rows in the order of branches are all of them in order, but for
        # branches to which several tasks gave rows
        rows_, order_ = np.flatnonzero(kind == 0), np.argsort(part[kind == 0], kind="stable")
        grams, own_branch = facts.take(pa.array(rows_[order_])).select(["items", "n"]), part[rows_[order_]]
        rest, sizes = _numbers(grams.column("items"), "<u4")
        gram_logs = _numbers(grams.column("n"), "<f4")[0]
        gram_keys = np.repeat(own_branch.astype(np.int64) << 32, sizes)
        gram_keys |= rest
        del rest, grams, rows_, order_
        if (own_branch[1:] == own_branch[:-1]).any():
            place = np.argsort(gram_keys, kind="stable")
            gram_keys = gram_keys[place]
            gram_logs = gram_logs[place]
            del place
        shared = facts.filter(pa.array(kind == 1)).select(["items", "n"])
        keys, counts = _numbers(shared.column("items"), "<i8")[0], _numbers(shared.column("n"), "<f8")[0]
        place = np.argsort(keys)
        word_keys, word_counts = keys[place], counts[place]
        del keys, counts, place, shared, facts
        times = np.where(texts.column("held_out").to_numpy(), 0, texts.column("copies").to_numpy())
        only = texts.select(["text"])

        def pieces(most: int) -> Iterator[list[bytes]]:
            for batch in only.to_batches():
                for some in text_slices(batch, 0, most):
                    yield from _pieces(some.column(0).to_pylist(), most)

        local, at = _Tally(), 0
        for piece in pieces(PIECE_BYTES):  # words of this chunk alone are counted here
            keys, sizes = _words_of(piece)
            local.add(keys, np.repeat(times[at : at + len(piece)], sizes))
            at += len(piece)
        local.settle()
        elsewhere = _place(word_keys, local.keys)
        c = local.counts.astype(float)
        if len(word_keys):
            c = np.where(elsewhere >= 0, word_counts[elsewhere], c)
        logs = np.log10(c + 0.1)
        out: list[list[np.ndarray]] = [[], [], [], []]
        for piece in pieces(SCORED_BYTES):
            codes, lengths = grams_of(piece, order)
            branch, rest = _split_grams(codes)
            logs_ = gram_logs[_found(gram_keys, branch << 32 | rest)].astype(float)
            sums_ = np.add.reduceat(logs_, np.cumsum(lengths) - lengths)
            keys, sizes = _words_of(piece)
            place = _found(local.keys, keys)
            running = np.concatenate([[0.0], np.cumsum(logs[place])])
            seen = np.concatenate([[0], np.cumsum(c[place] > 0)])
            stop = np.cumsum(sizes)
            for values, v in zip(out, (sums_, running[stop] - running[stop - sizes], seen[stop] - seen[stop - sizes], sizes)):
                values.append(v)
        scores, bases, seen_words, sizes = (np.concatenate(v) for v in out)
        return pa.table({
            "key": texts.column("key"), "held_out": texts.column("held_out"), "copies": texts.column("copies"),
            "n_tokens": pa.array(sizes.astype(np.int64) + 1),
            "n_known": pa.array(seen_words.astype(np.int64) + (1 if ends else 0)),
            "base": pa.array(bases + end_value), "score": pa.array(scores),
        })

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, held_out boolean, copies bigint, n_tokens bigint, n_known bigint, base double, score double"
    scored = _repeated(rows.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(score, schema))
    floor = float(np.log10(total + 0.1 * (distinct + 1)))
    return scored.select(
        F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(floor)).alias("base_score"), "score",
    )
