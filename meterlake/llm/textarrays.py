"""Words and word shingles of whole texts as numpy arrays.

A word is a run of bytes other than space and ``\\x09-\\x0D``, with ``A-Z`` lower-cased
and every other character left as it is. Words and shingles are identified by 64-bit
hashes; two different ones share a hash with probability 2**-64. A batch of texts is
handled in slices of bounded size, one text at the least.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_U = np.uint64
_BYTE_VALUE = np.random.default_rng(20240607).integers(1, 2**64, 256, dtype=np.uint64, endpoint=False)
_BYTE_VALUE[ord("A"):ord("Z") + 1] = _BYTE_VALUE[ord("a"):ord("z") + 1]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Blanks and all other ASCII characters but digits and letters.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _U(_MULTIPLIER), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def utf8(texts: pa.Array) -> pa.Array:
    """A string column without nulls and with 64-bit offsets."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return texts.cast(pa.large_string()).fill_null("")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than texts) and all bytes of a column from :func:`utf8`."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets, data


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold at most ``limit`` bytes, or one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte and text number of every word in ``data``; no word spans two texts.
    ``blank`` says which bytes part words."""
    space = blank[data]
    inside = ~space
    begins = inside.copy()
    begins[1:] &= space[:-1]
    ends = inside.copy()
    ends[:-1] &= space[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, the same wherever the word stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = stops - starts
    place = np.arange(len(data), dtype=np.int64)
    last = np.zeros(len(data), dtype=np.int64)
    last[starts] = starts
    place -= np.maximum.accumulate(last)
    place = np.minimum(place, length.max() - 1)
    values = _BYTE_VALUE[data] * _powers(int(length.max()))[place]
    sums = np.cumsum(values, dtype=np.uint64)
    before = np.where(starts > 0, sums[starts - 1], _U(0))
    return mix((sums[stops - 1] - before) + length.astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def words(texts: pa.Array, limit: int = SLICE_BYTES, blank: np.ndarray = _IS_SPACE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each slice of texts: first and end text, hash of each word, and for each text its first word
    (one more entry than texts)."""
    offsets, data = buffers(texts)
    for first, last in slices(offsets, limit):
        own = offsets[first:last + 1] - offsets[first]
        part = data[offsets[first]:offsets[last]]
        starts, stops, text = word_bounds(part, own, blank)
        hashes = word_hashes(part, starts, stops)
        yield first, last, hashes, np.searchsorted(text, np.arange(last - first + 1))


def shingles(hashes: np.ndarray, at: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every ``width``-word shingle. A text with fewer words has its whole
    sequence as one shingle; a text without words has none."""
    n = len(hashes)
    count = np.diff(at)
    text = np.repeat(np.arange(len(count)), count)
    out = np.zeros(n, dtype=np.uint64)
    left = np.repeat(at[1:], count) - np.arange(n)
    for k in range(width):
        inside = left > k
        step = np.zeros(n, dtype=np.uint64)
        step[:max(n - k, 0)] = hashes[k:]
        out = np.where(inside, mix(out * _U(_MULTIPLIER) + step + _U(k + 1)), out)
    whole = np.arange(n) == np.repeat(at[:-1], count)
    keep = (left >= width) | (whole & (left < width))
    return out[keep], text[keep]


def distinct(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and texts sorted by text and value, each pair once."""
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], text[new]


def shingle_sets(texts: pa.Array, width: int = 5, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each slice of texts: first and end text, the distinct shingle hashes of each text in
    ascending order, and each text's first entry (one more than texts)."""
    for first, last, hashes, at in words(texts, limit):
        value, text = distinct(*shingles(hashes, at, width))
        yield first, last, value, np.searchsorted(text, np.arange(last - first + 1))


def word_hash(word: bytes) -> int:
    """The hash of one word, without numpy; for tests and small lists."""
    total = 0
    for i, b in enumerate(word):
        total += int(_BYTE_VALUE[b]) * pow(_MULTIPLIER, i, 1 << 64)
    total = (total + len(word) * 0xD6E8FEB86659FD93) & _MASK
    return int(mix(np.array([total], dtype=np.uint64))[0])
