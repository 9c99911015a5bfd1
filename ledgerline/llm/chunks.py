"""Known byte ranges and the numbers that stand for them, as numpy tables.

A tokenizer that splits texts into chunks encodes each different chunk once; after that, all chunks
of a block of texts are looked up at once. Ranges are told apart by 128 bits of hash.
"""

from __future__ import annotations

import gc
from collections.abc import Callable

import numpy as np

from .bytescan import RangeHash
from .common import release

#: The one table that a worker process keeps: another owner's table goes when a new one comes.
_HELD: list = []


def held(key: tuple, build: Callable):
    """The object of ``key`` if this process made it last, else a new one in its place, so that the
    tables of one step don't stay in workers that the next step uses."""
    if not _HELD or _HELD[0] != key:
        if _HELD:
            _HELD[:] = []
            gc.collect()
            release()
        _HELD[:] = [key, build()]
    return _HELD[1]


class ChunkTable:
    """Open addressing over (hash, hash) -> run of 32-bit numbers. Emptied beyond ``most`` ranges, which
    half fill two million slots of 20 bytes."""

    def __init__(self, most: int = 900_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.n, self.used = 0, 0
        self.first = np.zeros(1 << 12, np.int64)  # where each range's numbers begin, and the end
        self.flat = np.zeros(1 << 14, np.uint32)
        self._sized(14)

    def _sized(self, bits: int) -> None:
        self.bits = bits
        self.one, self.two = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.row = np.full(1 << bits, -1, np.int32)

    def _slots(self, one: np.ndarray) -> np.ndarray:
        return (one >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The range number of each pair of hashes, -1 where there is none."""
        slot, mask = self._slots(one), (1 << self.bits) - 1
        out = self.row[slot]
        live = np.flatnonzero((out >= 0) & ((self.one[slot] != one) | (self.two[slot] != two)))
        slot = slot[live]
        while len(live):
            slot = (slot + 1) & mask
            out[live] = self.row[slot]
            go = (out[live] >= 0) & ((self.one[slot] != one[live]) | (self.two[slot] != two[live]))
            live, slot = live[go], slot[go]
        return out

    def _place(self, one: np.ndarray, two: np.ndarray, rows: np.ndarray) -> None:
        slot, mask = self._slots(one), (1 << self.bits) - 1
        live = np.arange(len(one))
        while len(live):
            free = self.row[slot] < 0
            at, who = slot[free], live[free]
            self.row[at] = rows[who]  # of several, the last one stays
            won = self.row[at] == rows[who]
            self.one[at[won]], self.two[at[won]] = one[who[won]], two[who[won]]
            lost = np.ones(len(live), bool)
            lost[np.flatnonzero(free)[won]] = False
            live = live[lost]
            slot = (slot[lost] + (self.row[slot[lost]] >= 0)) & mask

    def add(self, one: np.ndarray, two: np.ndarray, numbers: list[bytes]) -> np.ndarray:
        """Takes new, different ranges with their numbers (little-endian 32-bit); their range numbers."""
        n = len(one)
        rows = np.arange(self.n, self.n + n, dtype=np.int32)
        if 2 * (self.n + n) > 1 << self.bits:
            bits = self.bits
            while 2 * (self.n + n) > 1 << bits:
                bits += 1
            full = self.row >= 0
            kept = self.one[full], self.two[full], self.row[full]
            self._sized(bits)
            self._place(*kept)
        self._place(one, two, rows)
        flat = np.frombuffer(b"".join(numbers), "<u4")
        while self.n + n + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.first[self.n + 1 : self.n + n + 1] = self.used + np.cumsum([len(b) // 4 for b in numbers])
        self.n, self.used = self.n + n, self.used + len(flat)
        return rows

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, learn: Callable[[np.ndarray], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all ranges in order, how many each has). ``learn`` gets the indices of ranges
        that aren't known, each different one once, and returns their numbers."""
        if not len(starts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        one, two = RangeHash(data, 0).of(starts, ends), RangeHash(data, 1).of(starts, ends)
        if self.n > self.most:
            self.clear()
        rows = self.find(one, two)
        new = np.flatnonzero(rows < 0)
        if len(new):
            _, pick, back = np.unique(one[new] ^ (two[new] << np.uint64(1)), return_index=True, return_inverse=True)
            at = new[pick]
            rows[new] = self.add(one[at], two[at], learn(at))[back]
        begin = self.first[rows]
        count = self.first[rows + 1] - begin
        ends_at = np.cumsum(count)
        at = np.arange(ends_at[-1]) + np.repeat(begin - ends_at + count, count)
        return self.flat[at], count
