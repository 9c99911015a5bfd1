"""Language identification by bit-sliced Bloom filters of byte n-grams.

One Bloom filter for each language, all of one size and with the same hash functions, is stored
sliced: slot i holds a mask with bit l set if bit i of language l's filter is set; beyond 64
languages it holds several such words, each for the next 64. The AND of an
n-gram's slots is the set of all languages that (seem to) contain it. A text's n-grams give one
count for each language, which is corrected by the filter's rate of false positives; the language
with the largest corrected share wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import RangeHash, blocks, column_bytes, join_texts
from .common import broadcast_if_small, crc_fold
from .shingles import LOWER

LETTER = re.compile(r"[^\W\d_]")
SIZES = (3, 5)
CHUNK = 1 << 18


@dataclass(frozen=True)
class Filters:
    languages: tuple[str, ...]
    slots: np.ndarray
    false_rate: np.ndarray
    hashes: int

    def masks(self, grams: np.ndarray, word: int) -> np.ndarray:
        slots = self.slots[word]
        width = np.uint64(len(slots) - 1)
        found = slots[(grams & width).astype(np.int64)]
        for k in range(1, self.hashes):
            found = found & slots[((grams >> np.uint64(21 * k)) & width).astype(np.int64)]
        return found


def has_letter(text: str | None) -> bool:
    """Whether a text has a letter; word characters like superscript digits are none."""
    return text is not None and any(m.group().isalpha() for m in LETTER.finditer(text))


def _grams(data: np.ndarray) -> list[np.ndarray]:
    hashed = RangeHash(LOWER[data], 0)
    return [hashed.grams(n) for n in SIZES]


def train(texts: list[str], languages: list[str], share: float = 0.02, bits: int = 20, hashes: int = 2) -> Filters:
    """Filters of the n-grams that at least ``share`` of a language's texts contain (and two), so
    that a passage quoted from another language doesn't enter."""
    names = tuple(sorted(set(languages)))
    kind = np.uint8 if len(names) <= 8 else np.uint16 if len(names) <= 16 else np.uint64
    slots = np.zeros((-(-len(names) // 64), 1 << bits), kind)
    width = np.uint64(slots.shape[1] - 1)
    for at, name in enumerate(names):
        own = [t for t, l in zip(texts, languages, strict=True) if l == name]
        for n in range(len(SIZES)):
            each = [np.unique(_grams(np.frombuffer(t.encode("utf-8", "ignore"), np.uint8))[n]) for t in own]
            found, times = np.unique(np.concatenate(each) if each else np.empty(0, np.uint64), return_counts=True)
            kept = found[times >= max(min(2, len(own)), share * len(own))]
            for k in range(hashes):
                slots[at // 64, ((kept >> np.uint64(21 * k)) & width).astype(np.int64)] |= kind(1 << at % 64)
    fill = np.array([((slots[at // 64] >> kind(at % 64)) & kind(1)).mean() for at in range(len(names))])
    return Filters(names, slots, fill**hashes, hashes)


def score_bytes(filters: Filters, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Corrected shares of each text's n-grams in each language."""
    total = np.zeros((len(offsets) - 1, len(filters.languages)))
    count = np.zeros(len(offsets) - 1)
    for grams, n in zip(_grams(data), SIZES, strict=True):
        if not len(grams):
            continue
        first = np.minimum(offsets[:-1], len(grams))
        end = np.maximum(first, np.minimum(offsets[1:] - n + 1, len(grams)))
        count += end - first
        for at in range(len(filters.languages)):
            if at % 64 == 0:
                masks = filters.masks(grams, at // 64)
            sums = np.zeros(len(grams) + 1, np.int32)
            np.cumsum((masks >> masks.dtype.type(at % 64)) & masks.dtype.type(1), dtype=np.int32, out=sums[1:])
            total[:, at] += sums[end] - sums[first]
    expected = count[:, None] * filters.false_rate
    return np.maximum(0, (total - expected) / (1 - filters.false_rate)) / np.maximum(count, 1)[:, None]


def sample(docs: DataFrame, per_language: int, held_out: int, folds: int, most_bytes: int = 1 << 20) -> DataFrame:
    """At most ``per_language`` texts, of ``most_bytes`` at most, of each language, of the learning
    folds: of each of so many hash buckets the id of least second hash, so that any part of the ids
    is met, and of its texts in that language the first in order. Sampling looks at ids only, texts
    follow by a small join."""
    told = docs.where((crc_fold(F.col("doc_id"), folds) != held_out) & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (F.octet_length("text") <= most_bytes))
    first = F.min(F.struct(F.xxhash64(F.lit(1), "doc_id").alias("h"), "doc_id"))
    ids = told.groupBy("lang", F.pmod(F.xxhash64("doc_id"), F.lit(per_language)).alias("bucket")).agg(first.alias("m")).select("lang", "m.doc_id")
    return told.join(broadcast_if_small(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")


def identify_languages(docs: DataFrame, per_language: int = 200, held_out: int = 2, folds: int = 4) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang).

    Learns from at most ``per_language`` ids' texts for each language whose crc32 of the id
    modulo ``folds`` isn't ``held_out``. A null text or one without letters is 'und' with score 0.
    Equal shares go to the language that sorts first. A text too short for any n-gram, or with
    none known, gets the first language and score 0. A null doc_id is in the fold of the empty
    text. Repeated rows come back each; other columns are ignored. With nothing to learn from,
    every text is 'und'.
    """
    rows = sample(docs.select(F.col("doc_id").cast("long"), "text", "lang"), per_language, held_out, folds).collect()
    rows = sorted((r.lang, r.text) for r in rows)
    filters = train([t for _, t in rows], [l for l, _ in rows]) if rows else None
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            letters = [has_letter(t) for t in texts]
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            if known is not None:
                for begin, end, data, offsets in blocks(*column_bytes(batch.column(1)), CHUNK):
                    share = score_bytes(known, data, offsets)
                    best = share.argmax(axis=1)
                    top = share.max(axis=1) / np.maximum(share.sum(axis=1), 1e-12)
                    for i in range(begin, end):
                        if letters[i]:
                            names[i], scores[i] = known.languages[best[i - begin]], float(top[i - begin])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    every = docs.select(F.col("doc_id").cast("long"), "text", (crc_fold(F.col("doc_id"), folds) == held_out).alias("held_out"))
    return every.mapInArrow(scan, "doc_id long, held_out boolean, lang_pred string, score double")


def predict(filters: Filters, texts: list[str]) -> list[str]:
    share = score_bytes(filters, *join_texts([t.encode("utf-8", "ignore") for t in texts]))
    return [filters.languages[i] for i in share.argmax(axis=1)]
