"""Vectorised passes over batches of texts held as one byte array.

Everything here is numpy over the UTF-8 bytes of many documents laid end to end; a document's
bytes are ``data[offsets[i]:offsets[i + 1]]``. Hashes are polynomial modulo 2**64 over a fixed
random byte table, so equal bytes hash equally in any process.
"""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15 | 1)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (in place on a copy)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1) * _ODD)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (base odd)."""
    have = _TABLES.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        with np.errstate(over="ignore"):
            up = np.full(size, base, np.uint64)
            up[0] = 1
            down = np.full(size, inverse, np.uint64)
            down[0] = 1
            have = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
        _TABLES[base] = have
    return have[0][:n], have[1][:n]


class RangeHash:
    """Hashes of arbitrary ranges of a byte array in O(1) each."""

    BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

    def __init__(self, data: np.ndarray, which: int = 0):
        n = len(data)
        up, self.down = powers(self.BASES[which], n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(byte_table(which)[data] * up[:n], dtype=np.uint64, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, k: int) -> np.ndarray:
        """The hash of every k-gram, by start."""
        m = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:m]) * self.down[:m]) if m > 0 else np.empty(0, np.uint64)


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string or binary array, without copies; nulls are empty."""
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, body = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray, most: int):
    """Cuts texts laid end to end into runs of about ``most`` bytes; a longer text is a run of
    its own. Yields (first text, end text, bytes, offsets)."""
    begin, n = 0, len(offsets) - 1
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
        end = min(n, max(end, begin + 1))
        yield begin, end, data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
        begin = end


def sliding_min(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive keys, by doubling."""
    span, now = 1, keys
    while span * 2 <= w:
        now = np.minimum(now[:-span], now[span:])
        span *= 2
    if span < w:
        rest = w - span
        now = np.minimum(now[: len(now) - rest], now[rest:])
    return now


def minimizer_runs(data: np.ndarray, offsets: np.ndarray, length: int, k: int):
    """Anchors of all ``length``-byte windows that lie inside one document.

    A window's anchor is its k-gram of least hash (the leftmost of equal ones), so equal windows
    have equal anchors at equal offsets. Windows that follow each other and share the anchor
    position form a run. Returns (anchor position, first start, last start, anchor hash).
    """
    n = len(data)
    none = np.empty(0, np.int64)
    if n < length:
        return none, none, none, np.empty(0, np.uint64)
    bits = np.uint64(max(20, int(n).bit_length()))
    grams = RangeHash(data, 0).grams(k)
    keys = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(keys, length - k + 1)
    where = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    inside = np.ones(len(where), bool)
    for end in offsets[1:-1]:
        inside[max(0, end - length + 1) : end] = False
    change = np.ones(len(where), bool)
    change[1:] = (where[1:] != where[:-1]) | (inside[1:] != inside[:-1])
    begins = np.flatnonzero(change)
    ends = np.append(begins[1:], len(where)) - 1
    good = inside[begins]
    begins, ends = begins[good], ends[good]
    at = where[begins]
    return at, begins, ends, grams[at]
