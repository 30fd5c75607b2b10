"""Sets of word shingles as 64-bit numbers, computed with array operations over the bytes of many texts at once.

Words are runs of bytes other than ASCII white space, A-Z lower-cased. A word's number is a polynomial over a random
value per byte, taken from running sums; a shingle's number mixes those of its words in order. With fewer words than a
shingle has, the whole sequence is one shingle; without words the set is empty.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: bytes that are hashed in one go; a longer word makes a longer piece
PIECE = 1 << 20

_BYTES = np.arange(256)
_DELIMITER = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))[_LOWER]


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size + 1, _BASE, np.uint64), np.full(size + 1, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _words_of_piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and number of each word."""
    gap = np.concatenate([[True], _DELIMITER[data], [True]])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    size = PIECE
    while size < len(data):
        size *= 2
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_numbers(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and number of every word of a byte string of any length."""
    whole = np.frombuffer(data, np.uint8)
    starts, numbers, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(whole):
        end = min(len(whole), at + PIECE)
        while end < len(whole):
            found = np.flatnonzero(_DELIMITER[whole[end - 1 : end + PIECE]])
            if len(found):
                end += int(found[0])
                break
            end = min(len(whole), end + PIECE)
        s, n = _words_of_piece(whole[at:end])
        starts.append(s + at)
        numbers.append(n)
        at = end
    return np.concatenate(starts), np.concatenate(numbers)


def _rolled(numbers: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(max(0, len(numbers) - words + 1), np.uint64)
    for i in range(words):
        out += mix(numbers[i : i + len(out)] + np.uint64(i + 1)) * np.uint64((2 * i + 3) * 0x9FB21C651E98DF25 & _MASK)
    return mix(out)


def _few(numbers: np.ndarray) -> np.ndarray:
    """The one shingle of a text with fewer words than a shingle has."""
    with np.errstate(over="ignore"):
        out = np.array([len(numbers)], np.uint64)
        for n in numbers:
            out = mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + n)
    return out


def _split(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Numbers of all words, of all shingles, and the range of words of each text."""
    parts = [t.encode() if t else b"" for t in texts]
    starts, numbers = word_numbers(b" ".join(parts))
    bounds = np.searchsorted(starts, np.cumsum([0] + [len(p) + 1 for p in parts])).tolist()
    return numbers, _rolled(numbers, words), list(zip(bounds[:-1], bounds[1:]))


def _of_text(numbers: np.ndarray, rolled: np.ndarray, first: int, last: int, words: int) -> np.ndarray:
    if last - first >= words:
        return rolled[first : last - words + 1]
    return _few(numbers[first:last]) if last > first else np.zeros(0, np.uint64)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle numbers of every text."""
    numbers, rolled, ranges = _split(texts, words)
    return [np.unique(_of_text(numbers, rolled, a, b, words)) for a, b in ranges]


def rolled(texts: list[str | None], words: int) -> np.ndarray:
    """The shingle numbers of all texts one after the other, repeated ones included."""
    numbers, found, ranges = _split(texts, words)
    return np.concatenate([np.zeros(0, np.uint64), *(_of_text(numbers, found, a, b, words) for a, b in ranges)])
