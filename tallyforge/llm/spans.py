"""Words and lines of many texts at once, as byte spans with 64-bit hashes, in numpy.

Words are runs of bytes other than space and 0x09-0x0D; as these bytes are ASCII, the spans never cut a
UTF-8 character. A hash is the value at K of the span's bytes as a polynomial modulo 2**64, mixed; equal
spans have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that part words made of letters, and of letters and digits; all of a character outside ASCII count as letters.
NOT_LETTERS = np.ones(256, bool)
NOT_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
NOT_LETTERS_OR_DIGITS = NOT_LETTERS.copy()
NOT_LETTERS_OR_DIGITS[48:58] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CHUNK = 1 << 18
_K = 0x9E3779B97F4A7C15 | 1
_K_INVERSE = pow(_K, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit words in which every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def join_hashes(*parts: np.ndarray) -> np.ndarray:
    """Hash of a sequence of hashes; order counts."""
    out = parts[0].astype(np.uint64, copy=True)
    for x in parts[1:]:
        out = mix(out * np.uint64(_K) + x)
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the offsets of its texts in them. Null is the empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts with about ``most`` bytes each; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the index of each word's text; ``apart`` marks the bytes that part words."""
    inside = ~apart[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = np.unique(offsets[:-1][offsets[:-1] < len(data)])
    first[cuts] = inside[cuts]
    cuts = cuts[cuts > 0] - 1
    last[cuts] = inside[cuts]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines between newlines, and the index of each line's text. Every text has a line at least."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    owner = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = offsets[owner + 1].copy()
    same = owner[1:] == owner[:-1]
    ends[:-1][same] = starts[1:][same] - 1
    return starts, ends, owner


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        _powers[base] = np.cumprod(out, dtype=np.uint64)
    return _powers[base][:n]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; spans come in ascending order. Memory stays bounded by a chunk or the longest span."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + _CHUNK, "right")))
        n = int(ends[j - 1] - low)
        size = max(_CHUNK, n) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[low : low + n].astype(np.uint64) + np.uint64(1)) * _power(_K, size)[:n], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * _power(_K_INVERSE, size)[a]
        if size > 4 * _CHUNK:
            _powers.clear()
        i = j
    return mix(out)


def per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of whole numbers by text."""
    return np.bincount(owner, weights=values, minlength=n).astype(np.int64)


def taken(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the spans one after the other, and the offsets of each."""
    size = ends - starts
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    return data[np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])], offsets


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as a string column."""
    part, offsets = taken(data, starts, ends)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(part))
