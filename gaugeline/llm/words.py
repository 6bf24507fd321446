"""Words of Arrow text columns as 64-bit hashes, without a Python step per word.

A word is a run of bytes other than space and 0x09-0x0D. UTF-8 keeps these bytes for themselves, so bytes
can be looked at instead of characters. The hash of a word is a polynomial of its bytes modulo 2^64 (each byte
stands for a fixed 64-bit number), taken from prefix sums, then mixed. Such polynomials collide on long strings of a
certain making (Thue-Morse sequences from about a thousand bytes on), so words of more than 64 bytes, which are rare, take the hash of a
library that is not of this kind.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 1 << 20
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers, the same everywhere."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_P) + np.uint64(seed)) | np.uint64(1)


_VALUE = constants(256, 7)
_LOWER = _VALUE.copy()
_LOWER[65:91] = _VALUE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LONG = 64
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        for i, base in enumerate((_P, _P_INV)):
            step = np.full(n, base, np.uint64)
            step[0] = 1
            _POWERS[i] = np.cumprod(step)
    return _POWERS[0], _POWERS[1]


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray = _VALUE) -> np.ndarray:
    """Hashes of byte ranges, equal for equal bytes."""
    power, inverse = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.empty(len(data) + 1, np.uint64)
        total[0] = 0
        np.cumsum(value[data] * power[: len(data)], out=total[1:])
        return mix((total[end] - total[start]) * inverse[start])


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hashes of words; long ones, for which a polynomial is not safe, by xxh3."""
    out = range_hashes(data, start, end, _LOWER if lower else _VALUE)
    for i in np.flatnonzero(end - start > _LONG):
        word = data[start[i]: end[i]].tobytes()
        out[i] = xxhash.xxh3_64_intdigest(word.lower() if lower else word)
    return out


def gather(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs values[start : start + count] one after the other."""
    ends = np.cumsum(count)
    return values[np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]


@dataclass
class Words:
    """Words of some texts in order: text number, byte range within `data`, hash; `first[i]` is text i's first word."""

    data: np.ndarray
    offsets: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def of(self, i: int) -> slice:
        return slice(self.first[i], self.first[i + 1])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = bytes_of(column)
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none, none, none, none.astype(np.uint64), np.zeros(len(offsets), np.int64))
    inside = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], after[-1] = True, True
    before[1:] = ~inside[:-1] | cut[1:-1]
    after[:-1] = ~inside[1:] | cut[1:-1]
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    hashed = word_hashes(data, start, end, lower)
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, text, start, end, hashed, first)


def windows(hashed: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` hashes; runs over the edge of a text are the caller's to leave out."""
    n = len(hashed) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = hashed[:n].copy()
        for k in range(1, size):
            out = out * np.uint64(_P) + hashed[k: k + n]
        return mix(out)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text; a longer text comes alone. Bounds the work arrays."""
    _, offsets = bytes_of(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
