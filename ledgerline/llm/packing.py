"""Packing documents into training sequences, shortest pack first over the length histogram.

Documents are tokenised whole; what exceeds a sequence is cut off in full sequences, and the rest
of each document is one piece. Only the histogram of piece lengths (at most ``size`` entries) comes
to the driver, where lengths are placed longest first, each into the shortest pack, the one with
the most room; packing patterns are counts, so a million equal lengths are one step. Pieces take
their places in the patterns by their rank among the pieces of their length. Ranks come from counts
of (length, bucket), so no length gathers in one task.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytescan import blocks, column_bytes, join_texts
from .chunks import ChunkTable, held
from .common import releasing, staged
from .shingles import SPACE

SIZE = 2048
END = 1
BUCKETS = 256
#: Bytes of text that are encoded at once.
BLOCK = 1 << 19
#: White space, as bytes in ASCII and as code points beyond it (fixed values).
ASCII_SPACES = b" \t\n\v\f\r"
WIDE_SPACES = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


class _Encoder:
    """Ids of whole texts. A byte-level vocabulary splits a text into words first and encodes each
    on its own, and a run of white space always begins a new word, so a text falls into chunks at
    those places. Each different chunk is encoded once; all chunks of a block of texts are then
    looked up at once.

    Texts that hold an added token, or white space beyond ASCII, are encoded by the tokenizer as a
    whole, as is every text if the vocabulary isn't byte-level.
    """

    def __init__(self, path: str):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one text at a time; threads would keep memory each
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # of its description only the parts that matter: the whole file would be a hundred thousand objects
        pre = json.loads(self.tokenizer.pre_tokenizer.__getstate__()) if self.tokenizer.pre_tokenizer else {}
        self.plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and self.tokenizer.normalizer is None
        # in a byte-level vocabulary each character of a token stands for one byte
        self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes_of[i] = len(token)
        self.table = ChunkTable()

    def _whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks that don't end with white space. They are encoded as one text, with a line
        break before those that begin without any; the tokens' bytes tell whose they are."""
        parts = [c if c[0] in ASCII_SPACES else b"\n" + c for c in chunks]
        ids = np.array(self.tokenizer.encode_batch_fast([b"".join(parts).decode()], add_special_tokens=False)[0].ids, "<u4")
        at = np.cumsum(self.bytes_of[ids])
        ends = np.cumsum([len(p) for p in parts])
        starts = ends - [len(c) for c in chunks]
        first = np.searchsorted(at, starts, side="right").tolist()
        last = (np.searchsorted(at, ends - 1, side="right") + 1).tolist()
        raw = ids.tobytes()
        return [raw[4 * b : 4 * e] for b, e in zip(first, last, strict=True)]

    def _odd(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts are encoded as a whole."""
        if not self.plain:
            return np.ones(len(offsets) - 1, bool)
        places = [np.flatnonzero((data >= 0x1C) & (data <= 0x1F))]
        lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
        padded = np.append(data, np.zeros(2, np.uint8))
        a, b, c = (padded[lead + k].astype(np.int64) for k in range(3))
        point = np.where(a == 0xC2, ((a & 31) << 6) | (b & 63), ((a & 15) << 12) | ((b & 63) << 6) | (c & 63))
        places.append(lead[np.isin(point, WIDE_SPACES)])
        raw = data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                places.append(np.array([at]))
                at = raw.find(token, at + 1)
        odd = np.zeros(len(offsets) - 1, bool)
        # a token found across two texts only makes the first one slower
        odd[np.searchsorted(offsets, np.concatenate(places), side="right") - 1] = True
        return odd

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts laid end to end, where each text's begin, and the end)."""
        odd = self._odd(data, offsets)
        space = SPACE[data]
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        if odd.any():
            begins &= ~np.repeat(odd, np.diff(offsets))
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))

        def learn(new: np.ndarray) -> list[bytes]:
            chunks = [data[b:e].tobytes() for b, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            whole = (odd[np.searchsorted(offsets, starts[new], side="right") - 1] | space[ends[new] - 1]).tolist()
            found = iter(self._chunks([c for c, w in zip(chunks, whole, strict=True) if not w]) if not all(whole) else ())
            return [self._whole(c) if w else next(found) for c, w in zip(chunks, whole, strict=True)]

        ids, count = self.table.numbers(data, starts, ends, learn)
        return ids, np.concatenate([[0], np.cumsum(count)])[np.searchsorted(starts, offsets)]

    def __call__(self, text: str) -> bytes:
        return self.encode_block(*join_texts([text.encode()]))[0].tobytes()


def pieces(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, row) of each piece; row tells rows of one
    doc_id apart."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = held(("packing", path), lambda: _Encoder(path))
        for batch in batches:
            names = batch.column(0).to_pylist()
            for begin, end, data, offsets in blocks(*column_bytes(batch.column(1)), BLOCK):
                out: list[tuple] = []
                ids, cuts = encode.encode_block(data, offsets)
                # each document's ids with the closing id after them
                closed = np.full(len(ids) + end - begin, END, np.uint32)
                closed[np.arange(len(ids)) + np.repeat(np.arange(end - begin), np.diff(cuts))] = ids
                raw, cuts = memoryview(closed.astype("<u4").tobytes()), (cuts + np.arange(end - begin + 1)).tolist()
                for doc, first, last in zip(names[begin:end], cuts, cuts[1:], strict=False):
                    for start in range(first, last, size):
                        stop = min(start + size, last)
                        out.append((doc, start - first, stop - start, zlib.crc32(raw[4 * start : 4 * stop]), last - first))
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(scan), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, how many sequences) by shortest pack first: each length, longest first, goes one
    at a time to the shortest pack, the one with the most room. If it doesn't fit there, it fits
    nowhere, and a new pack is opened, which then is the shortest until it is too full."""
    room: dict[int, Counter] = defaultdict(Counter)  # room left -> pattern -> count
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            most = max(room, default=0)
            if most >= length:
                start, have = next(iter(room[most].items()))
                count, times = min(left, have), 1
                room[most][start] -= count
                if count == have:
                    del room[most][start]
                if not room[most]:
                    del room[most]
            else:
                start, most = (), size
                times = min(size // length, left)
                count = left // times
            room[most - times * length][(*start, *[length] * times)] += count
            left -= count * times
    return sorted(((p, n) for found in room.values() for p, n in found.items()), reverse=True)


def _places(found: list[tuple[tuple[int, ...], int]]) -> list[tuple]:
    """(length, first rank, ranks, first sequence, offset) of each run of equal places."""
    out, used, sequence = [], Counter(), 0
    for pattern, count in found:
        offset = 0
        for length in pattern:
            out.append((length, used[length], count, sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return out


def pack(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece of every
    document. A null or empty text is the closing id alone. Rows that repeat a doc_id, or have a
    null one, are packed each. Further columns are ignored; no rows give no sequences."""
    spark = docs.sparkSession
    cut = staged(pieces(docs, path, size), "pieces")
    # The pieces of one length are ranked in buckets of some hundred thousand at most.
    buckets = BUCKETS * (1 + cut.count() // (BUCKETS * 200_000))
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = staged(cut.groupBy("length", "bucket").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(patterns(histogram, size))
    table = spark.createDataFrame(places or [(0, 0, 0, 0, 0)], "length long, first long, ranks long, sequence long, offset long").where("ranks > 0")
    # For each length and bucket: the ranks before it, and the runs of places that its own ranks meet.
    before = counts.select("length", "bucket", "n", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    met = before.join(table, "length").where((F.col("first") < F.col("before") + F.col("n")) & (F.col("first") + F.col("ranks") > F.col("before")))
    runs = met.groupBy("length", "bucket", "before").agg(F.collect_list(F.struct("first", "ranks", "sequence", "offset")).alias("runs"))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32"))
    ranked = cut.withColumn("own", own).join(runs, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("own") - 1)
    out = ranked.withColumn("run", F.element_at(F.filter("runs", lambda r: (r["first"] <= F.col("rank")) & (F.col("rank") < r["first"] + r["ranks"])), 1))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("run.sequence") + F.col("rank") - F.col("run.first")).alias("sequence_id"), F.col("run.offset").alias("offset"))
