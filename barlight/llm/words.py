"""Vectorised words, hashes and n-grams over Arrow string columns.

A chunk of texts is handled as one byte buffer, so that no Python object is
made for a word. Hashes are 64 bits wide and equal in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RADIX = np.uint64(0x9E3779B97F4A7C15 | 3)
_INVERSE = np.uint64(pow(int(_RADIX), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

#: Byte tables. Space is what separates words of `[^\x20\x09-\x0D]+`; mark also takes ASCII punctuation.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
MARK = np.zeros(256, bool)
MARK[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[name][:n]


def rolling(codes: np.ndarray) -> np.ndarray:
    """Prefix sums from which span_hash() takes the hash of any span."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _power("radix", _RADIX, len(codes)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end), its length included."""
    h = (prefix[end] - prefix[start]) * _power("inverse", _INVERSE, len(prefix))[start]
    return mix(h ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def byte_codes(data: np.ndarray) -> np.ndarray:
    return _CODE[data]


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offset of each; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


class Words:
    """Words of a chunk: hash, first and end byte, and for each text the number of its first word."""

    def __init__(self, texts: pa.Array, apart: np.ndarray = SPACE, lower: bool = True):
        data, self.at = buffer(texts)
        self.data = LOWER[data] if lower else data
        inside = ~apart[self.data]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.at] = True
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        here = np.zeros(len(data) + 1, bool)
        here[:-1] = inside
        self.start = np.flatnonzero(here & (~before | edge))
        self.end = np.flatnonzero(before & (~here | edge))
        self.first = np.searchsorted(self.start, self.at)
        self.count = np.diff(self.first)
        self._hash = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = span_hash(rolling(byte_codes(self.data)), self.start, self.end)
        return self._hash

    @property
    def text(self) -> np.ndarray:
        """Number of the text that each word stands in."""
        return np.repeat(np.arange(len(self.count)), self.count)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n hashes from each place on; the last n-1 places have none."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out, done, power, width = None, 0, hashes, 1
    while True:
        if n & width:
            part = power[done : len(hashes) - n + 1 + done]
            out = part.copy() if out is None else mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + part)
            done += width
        if done == n:
            return mix(out + np.uint64(n))
        power = mix(power[:-width] * np.uint64(0x9E3779B185EBCA87) + power[width:])
        width *= 2


def within(first: np.ndarray, n: int) -> np.ndarray:
    """Places from which n words on stay in one text; first: each text's first word, and the end."""
    ok = np.zeros(int(first[-1]), bool)
    count = np.diff(first)
    long = count >= n
    step = np.zeros(int(first[-1]) + 1, np.int32)
    np.add.at(step, first[:-1][long], 1)
    np.add.at(step, first[1:][long] - n + 1, -1)
    ok[:] = np.cumsum(step[:-1]) > 0
    return ok


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of text, so that memory doesn't depend on Arrow's batches."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = buffer(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i]+1, ... count[i] times, one after the other."""
    if not len(count):
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(ends[-1]) + np.repeat(first - (ends - count), count)


def planes(x: np.ndarray, n: int) -> bytes:
    """The n low bytes of the numbers, byte by byte, so that what sorted numbers share compresses."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def unplanes(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(data) // n, 8), np.uint8)
    out[:, :n] = np.frombuffer(data, np.uint8).reshape(n, -1).T
    return out.reshape(-1).view("<u8")
