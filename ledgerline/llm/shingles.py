"""Word shingles of whole texts as 64-bit hashes, many documents at a time.

Words are maximal runs of bytes other than space and 0x09-0x0D, A-Z lower-cased. A document's
set holds its distinct n-word shingles; with fewer words, the whole sequence is one shingle;
without words it is empty.
"""

from __future__ import annotations

import numpy as np

from .bytescan import RangeHash, blocks, join_texts, mix

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
CHUNK = 1 << 18


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the words of texts laid end to end; words end with their document."""
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(word hashes, index of the first word of each document and the end)."""
    data = LOWER[data]
    starts, ends = word_spans(data, offsets)
    hashes = RangeHash(data, 0).of(starts, ends) if len(starts) else np.empty(0, np.uint64)
    return hashes, np.searchsorted(starts, offsets)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    if len(words) == 0:
        return words
    n = min(n, len(words))
    found = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        found = mix(found * np.uint64(0x9FB21C651E98DF25) + words[i : len(words) - n + 1 + i])
    return found


def shingle_lists(data: np.ndarray, offsets: np.ndarray, n: int):
    """Yields the shingle hashes of each text in order, repeats included."""
    for begin, end, part, cuts in blocks(data, offsets, CHUNK):
        words, firsts = word_hashes(part, cuts)
        for i in range(end - begin):
            yield gram_hashes(words[firsts[i] : firsts[i + 1]], n)


def shingle_sets(texts: list[bytes], n: int):
    """Yields each text's sorted distinct shingle hashes, in order."""
    for found in shingle_lists(*join_texts(texts), n):
        yield np.unique(found)
