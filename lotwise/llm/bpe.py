"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token with which its encoding can end. ``PrefixTable`` stores
that token per prefix: a token that ends here is the right one when the pair with the last token of the prefix
before it would also come out of the merge rules. Encoding is one walk back through the table. A table can be
extended (appends are exact, nothing before them changes) and edited (only prefixes after the edit are redone, until
they agree with the old ones again).

``encode`` and ``decode`` apply this to DataFrame columns. Null texts count as empty and give an empty list; texts of
any length are encoded whole; rows, repeated or not, are independent of each other and all other columns stay.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import text_slices

#: pieces of text whose ids a worker remembers; a matter of memory and speed only
REMEMBERED = 300_000
#: places for the verdicts on pairs of tokens, a power of two; eight bytes each
PAIR_PLACES = 1 << 20
#: bytes of text that are encoded at a time
SLICE_BYTES = 4_000_000


def read_ranks(blob: bytes) -> dict[bytes, int]:
    """Ranks from a file of lines ``base64 rank``."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in blob.splitlines() if line.strip())}


class Merges:
    """The merge rules of a vocabulary: ranks of byte strings, lowest rank first, leftmost first among equals."""

    def __init__(self, ranks: dict[bytes, int], known: bytes | None = None) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        # one verdict a place: a pair of ids shifted by one, the last bit says whether they fit
        self.pairs = array("q", [-1]) * PAIR_PLACES
        self.bits = max(self.tokens).bit_length()
        # tokens that merging their own bytes does not give can stand for a whole piece only
        self.made_of: list[tuple[int, int] | None] = [None] * (1 + max(self.tokens))
        if known is None:
            self.unreachable = frozenset(rank for token, rank in ranks.items() if self.merge(token) != [rank])
        else:
            parts = np.frombuffer(known, "<i4").reshape(-1, 2).tolist()
            self.unreachable = frozenset(t for t in self.tokens if parts[t][0] < 0)
            self.made_of = [tuple(p) if p[0] >= 0 else None for p in parts]
        # merges of reachable tokens by the pair that is merged
        reachable = [t for t in self.tokens if t not in self.unreachable]
        self.joined = {a << self.bits | b: t for t in reachable for a, b in [self.parts_of(t)] if a != t}
        self.finder = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if rank not in self.unreachable:
                self.finder.add_word(token.decode("latin-1"), (rank, len(token)))
        self.finder.make_automaton()

    def merge(self, piece: bytes, below: int | None = None) -> list[int]:
        """The definition: merge the pair of lowest rank until there is none (of a rank ``below`` a given one)."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranked = ((self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            best = min(((r, i) for r, i in ranked if r is not None), default=None)
            if best is None or (below is not None and best[0] >= below):
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.ranks[p] for p in parts]

    def packed(self) -> bytes:
        """What is known of all tokens, for ``known`` of another instance."""
        return np.array([p or (-1, -1) for p in self.made_of], "<i4").tobytes()

    def parts_of(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge is ``token``; a single byte is both itself."""
        known = self.made_of[token]
        if known is None:
            data = self.tokens[token]
            known = (token, token) if len(data) == 1 else tuple(self.merge(data, below=token))
            self.made_of[token] = known
        return known

    def stand_apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives the two tokens again.

        Their own merges are taken back, latest first; what touches across the border meanwhile must not have a merge
        that would have come earlier than the one taken back.
        """
        limit = len(self.made_of)
        while True:
            joint = self.joined.get(left << self.bits | right)
            if joint is not None and joint < limit:
                return False
            if left > right:
                limit, left = left, self.parts_of(left)[1]
                if left == limit:
                    limit, right = right + 1, self.parts_of(right)[0]
                    if right + 1 == limit:
                        return True
            else:
                limit, right = right + 1, self.parts_of(right)[0]
                if right + 1 == limit:
                    limit, left = left, self.parts_of(left)[1]
                    if left == limit:
                        return True

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand next to each other in an encoding."""
        pair = left << self.bits | right
        place = pair * 0x9E3779B1 >> 7 & PAIR_PLACES - 1
        known = self.pairs[place]
        if known >> 1 != pair:
            known = pair << 1 | self.stand_apart(left, right)
            self.pairs[place] = known
        return known & 1 == 1

    def encode_piece(self, piece: bytes) -> list[int]:
        """The walk of ``PrefixTable`` over one piece that is not extended or edited."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        pairs, bits, mask, apart = self.pairs, self.bits, PAIR_PLACES - 1, self.stand_apart
        last, filled = [-1], 1
        for at, (token, width) in self.finder.iter(piece.decode("latin-1")):
            if at + 1 < filled:
                continue
            start = at + 1 - width
            if start:
                pair = last[start] << bits | token
                place = pair * 0x9E3779B1 >> 7 & mask
                known = pairs[place]
                if known >> 1 != pair:
                    pairs[place] = known = pair << 1 | apart(last[start], token)
                if not known & 1:
                    continue
            last.append(token)
            filled += 1
        out, at = [], len(piece)
        while at:
            out.append(last[at])
            at -= len(self.tokens[last[at]])
        return out[::-1]


class PrefixTable:
    """The last token of the encoding of every prefix of one byte string."""

    def __init__(self, merges: Merges, data: bytes = b"") -> None:
        self.merges, self.data, self.last = merges, b"", [-1]
        self.append(data)

    def _extend(self, end: int, stop_at: list[int] | None = None, from_position: int = 0) -> int:
        """Fill the table up to ``end``. With ``stop_at`` (old last tokens, aligned to the end of the data), stop once
        as many positions as the longest token agree; returns the length filled."""
        merges, last = self.merges, self.last
        begin = max(0, len(last) - 1 - merges.longest)
        found = merges.finder.iter(self.data[begin:end].decode("latin-1"))
        agree = 0
        for at, (token, width) in found:
            stop = begin + at + 1
            if stop < len(last):
                continue
            start = stop - width
            if start == 0 or merges.fits(last[start], token):
                last.append(token)
                if stop_at is not None and stop > from_position:
                    old = len(stop_at) - 1 - (len(self.data) - stop)
                    agree = agree + 1 if old > 0 and stop_at[old] == token else 0
                    if agree >= merges.longest:
                        return stop
        return len(last) - 1

    def append(self, more: bytes) -> None:
        self.data += more
        self._extend(len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:end]``; returns how many prefixes were computed again."""
        old = self.last
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[: start + 1]
        filled = self._extend(len(self.data), old, start + len(new) + self.merges.longest)
        if filled < len(self.data):
            self.last.extend(old[len(old) - (len(self.data) - filled) :])
        return filled - start

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at > 0:
            token = self.last[at]
            out.append(token)
            at -= len(self.merges.tokens[token])
        return out[::-1]


class TextEncoding:
    """The encoding of one text that is appended to or edited; pieces away from the change are kept."""

    def __init__(self, encoder: "Encoder", text: str = "") -> None:
        self.encoder, self.text = encoder, text
        self.starts = [m.start() for m in encoder.pattern.finditer(text)]
        self.pieces = [list(encoder.piece_ids(m.group())) for m in encoder.pattern.finditer(text)]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Split again from the piece before the change (patterns look one character ahead) until the cuts agree."""
        shift = len(new) - (end - start)
        keep = next((i for i in range(len(self.starts) - 1, -1, -1) if self.starts[i] < start - 1), 0)
        keep = max(0, keep - 1)
        text = self.text[:start] + new + self.text[end:]
        later = {s + shift: i for i, s in enumerate(self.starts) if s >= end}
        starts, pieces = self.starts[:keep], self.pieces[:keep]
        begin = self.starts[keep] if keep < len(self.starts) else 0
        for m in self.encoder.pattern.finditer(text, begin):
            if m.start() >= start + len(new) and m.start() in later:
                i = later[m.start()]
                starts += [s + shift for s in self.starts[i:]]
                pieces += self.pieces[i:]
                break
            starts.append(m.start())
            pieces.append(list(self.encoder.piece_ids(m.group())))
        self.text, self.starts, self.pieces = text, starts, pieces

    def ids(self) -> list[int]:
        return [i for piece in self.pieces for i in piece]


class _Remembered(dict):
    """Ids of pieces as bytes of 32 bits each. Half of them at least are the latest ones; pieces that are met again
    move to the new half, the others go when it is full."""

    def __init__(self, merges: Merges) -> None:
        super().__init__()
        self.merges, self.earlier = merges, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.earlier.get(piece)
        if ids is None:
            ids = array("i", self.merges.encode_piece(piece.encode())).tobytes()
        if len(self) >= REMEMBERED // 2:
            self.earlier = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """A vocabulary and the pattern that cuts texts into pieces."""

    def __init__(self, blob: bytes, pattern: str, known: bytes | None = None) -> None:
        self.merges = Merges(read_ranks(blob), known)
        self.pattern = regex.compile(pattern)
        self.remembered = _Remembered(self.merges)

    def piece_ids(self, piece: str) -> np.ndarray:
        return np.frombuffer(self.remembered[piece], "<i4")

    def encode_bytes(self, text: str) -> bytes:
        """All ids of a text as little-endian 32-bit bytes."""
        return b"".join(map(self.remembered.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<i4").tolist()

    def id_lists(self, texts: pa.Array) -> pa.Array:
        """Ids of every text; null gives an empty list."""
        parts = [self.encode_bytes(t) if t else b"" for t in texts.to_pylist()]
        ends = np.cumsum([0] + [len(p) // 4 for p in parts])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.merges.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(blob: bytes, pattern: str, known: bytes | None = None) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(blob, pattern, known)


@lru_cache(maxsize=2)
def token_table(blob: bytes) -> dict[int, bytes]:
    """Bytes of each id; all that decoding needs."""
    return {rank: token for token, rank in read_ranks(blob).items()}


class Codec:
    """Column functions for one vocabulary file.

    The file is read once on the driver and travels with the function: its size is that of a vocabulary and does not
    depend on the data.
    """

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            blob = f.read()
        known = encoder(blob, pattern).merges.packed()

        def encode_batch(texts: pa.Array) -> pa.Array:
            own, batch = self.encoder(), pa.RecordBatch.from_arrays([texts], ["text"])
            parts = [own.id_lists(some.column(0)) for some in text_slices(batch, 0, SLICE_BYTES)]
            return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

        def decode_batch(ids: pa.Array) -> pa.Array:
            return decoded_lists(token_table(blob), ids)

        self.blob, self.pattern, self.known = blob, pattern, known
        # each is run once per row, also when several columns are derived from its result
        self._encode = F.arrow_udf(encode_batch, "array<int>").asNondeterministic()
        self._decode = F.arrow_udf(decode_batch, "binary").asNondeterministic()

    def __getstate__(self) -> dict:
        return {n: getattr(self, n) for n in ("blob", "pattern", "known")}

    def encoder(self) -> Encoder:
        return encoder(self.blob, self.pattern, self.known)

    def encode(self, text: Column) -> Column:
        """Ids of a text column; null gives an empty list."""
        return self._encode(text.cast("string"))

    def decode(self, ids: Column) -> Column:
        """Bytes of an id column; null gives empty bytes. Ids outside the vocabulary are an error."""
        return self._decode(ids)


def _lists(ids: pa.Array) -> Iterator[list[int]]:
    values, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    valid = ids.is_valid().to_numpy(zero_copy_only=False)
    for start, end, ok in zip(ends[:-1], ends[1:], valid):
        yield values[start:end].tolist() if ok else []


def decoded_lists(tokens: dict[int, bytes], ids: pa.Array) -> pa.Array:
    """Bytes of every list of ids."""
    return pa.array([b"".join(map(tokens.__getitem__, row)) for row in _lists(ids)], pa.binary())


def encode(
    df: DataFrame, codec: Codec, text: str = "text", out: str = "ids", decoded: str | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """Add the ids of ``text`` as ``array<int>`` column ``out`` and, with ``decoded``, the bytes these ids stand for.

    Both come from one pass over some megabytes of text at a time, however many rows or bytes a batch has. Columns of
    these names are replaced; of the others, those in ``keep`` stay (all without it).
    """
    new = [out, *([decoded] if decoded else [])]
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("__encoded"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec.encoder()
        for batch in batches:
            for some in text_slices(batch, len(kept), SLICE_BYTES):
                ids = own.id_lists(some.column(len(kept)))
                more = [decoded_lists(own.merges.tokens, ids)] if decoded else []
                yield pa.RecordBatch.from_arrays([*some.columns[: len(kept)], ids, *more], [*kept, *new])

    schema = [*kinds, f"`{out}` array<int>", *([f"`{decoded}` binary"] if decoded else [])]
    # replaced columns keep their places
    shown = [c for c in (df.columns if keep is None else keep) if c in (*kept, *new)]
    shown += [c for c in new if c not in shown]
    return source.mapInArrow(run, ", ".join(schema)).select(*[F.col(f"`{c}`") for c in shown])


def decode(df: DataFrame, codec: Codec, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes of ``ids`` as binary column ``out``."""
    return df.withColumn(out, codec.decode(F.col(ids)))
