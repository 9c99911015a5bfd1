"""SentencePiece encoding and decoding by suffix-array matching.

For a model of merges with byte fallback whose pieces never hold the word mark after another
character, a text falls into units (word marks, then other characters) that are encoded on their
own. The different new units of a block of texts are laid end to end and indexed by a suffix array;
every piece's occurrences are one range of it, found by binary search. The ranges give edges
(position, piece), which are sorted by position, and all units are relaxed over their edges side by
side in the model's order: in each, the best-scored edge that joins two neighbouring segments
first, of equal ones the leftmost. What no piece covers becomes byte pieces. Known units are looked
up in a table.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import blocks, column_bytes, join_texts
from .chunks import ChunkTable, held
from .suffix_dedup import suffix_array

MARK = "▁"
#: Characters that one suffix array indexes, and bytes of text that are encoded at once.
INDEXED = 1 << 19
BLOCK = 1 << 20
#: Units of more characters are relaxed one by one with a heap, as their merges take so many rounds.
LONG = 64
NONE = np.int32(1 << 30)


class Model:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.special = {i for i in range(size) if sp.is_control(i) or sp.is_unknown(i)}
        self.byte_of = {i: int(p[3:5], 16) for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.byte_ids = {b: i for i, b in self.byte_of.items()}
        plain = [i for i in range(size) if i not in self.special and i not in self.byte_of]
        if any(MARK in self.pieces[i].lstrip(MARK) for i in plain) or len(self.byte_ids) != 256:
            raise ValueError("a model whose units aren't independent, or without byte fallback")
        self.longest = max(len(self.pieces[i]) for i in plain)
        names = np.array([self.pieces[i] for i in plain], dtype=f"U{self.longest + 1}")
        order = np.argsort(names, kind="stable")
        self.names, self.ids = names[order], np.array(plain)[order]
        self.sizes = np.char.str_len(self.names)
        self.score = {i: sp.get_score(i) for i in plain}
        # the order of merging: 0 for the best score, equal scores share a number
        _, by = np.unique([-self.score[i] for i in plain], return_inverse=True)
        self.order = np.full(size + 1, NONE, np.int32)
        self.order[plain] = by
        self.text_of = [self.pieces[i].replace(MARK, " ") if i not in self.byte_of and i not in self.special else "" for i in range(size)]
        self.raw_of = [bytes([self.byte_of[i]]) if i in self.byte_of else self.text_of[i].encode() for i in range(size)]
        self.table = ChunkTable()

    def edges(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, size, id) of all occurrences of all pieces in code points, by position."""
        order = suffix_array(points.astype(np.int64) + 1, 1, self.longest)
        padded = np.concatenate([points, np.zeros(self.longest + 1, np.uint32)]).astype(np.uint32)
        heads = np.lib.stride_tricks.sliding_window_view(padded, self.longest)[: len(points)][order]
        heads = np.ascontiguousarray(heads).view(f"U{self.longest}").ravel()
        low = np.searchsorted(heads, self.names, side="left")
        beyond = np.char.add(self.names, "\U0010ffff")
        high = np.searchsorted(heads, beyond, side="left")
        count = np.maximum(0, high - low)
        which = np.repeat(np.arange(len(count)), count)
        at = order[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        by = np.argsort(at, kind="stable")
        return at[by], self.sizes[which][by], self.ids[which][by]

    def relax(self, unit: str, edges: dict[tuple[int, int], int]) -> list[int]:
        """The ids of a unit from its edges (start, end) -> id, by a heap."""
        n = len(unit)
        end = list(range(1, n + 1))  # of the segment that starts here
        before = list(range(-1, n - 1))  # start of the segment before
        heap = []

        def offer(start: int, middle: int) -> None:
            stop = end[middle]
            found = edges.get((start, stop))
            if found is not None:
                heapq.heappush(heap, (-self.score[found], start, middle, stop))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = bytearray(n)
        while heap:
            _, start, middle, stop = heapq.heappop(heap)
            if gone[start] or gone[middle] or end[start] != middle or end[middle] != stop:
                continue
            gone[middle] = 1
            end[start] = stop
            if stop < n:
                before[stop] = start
                offer(start, stop)
            if before[start] >= 0:
                offer(before[start], start)
        out, i = [], 0
        while i < n:
            found = edges.get((i, end[i]))
            if found is None:
                out += [self.byte_ids[b] for b in unit[i : end[i]].encode("utf-8", "surrogatepass")]
            else:
                out.append(found)
            i = end[i]
        return out

    def relax_all(self, begin: np.ndarray, size: np.ndarray, lattice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) of the segments of units side by side; ``lattice[position, size]`` is the
        id of the edge of so many characters there, -1 for none."""
        owner = np.repeat(np.arange(len(size)), size)
        head = np.cumsum(size) - size
        start = begin[owner] + np.arange(len(owner)) - head[owner]
        stop = start + 1
        cost = np.full(len(start), NONE, np.int32)
        longest = lattice.shape[1] - 1

        def price(at: np.ndarray, end: np.ndarray) -> np.ndarray:
            length = end - at
            return np.where(length <= longest, self.order[lattice[at, np.minimum(length, longest)]], NONE)

        inner = np.flatnonzero(owner[1:] == owner[:-1])
        cost[inner] = price(start[inner], stop[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(start):
            least = np.minimum.reduceat(cost, head)
            count = np.diff(np.append(head, len(start)))
            live = least < NONE
            if not live.all():
                rest = ~np.repeat(live, count)
                done.append((start[rest], stop[rest]))
                start, stop, cost = start[~rest], stop[~rest], cost[~rest]
                least, count = least[live], count[live]
                head = np.cumsum(count) - count
                if not len(start):
                    break
            # the leftmost of each unit's best edges joins its segment with the next one
            hits = np.flatnonzero(cost == np.repeat(least, count))
            unit = np.repeat(np.arange(len(count)), count)[hits]
            at = hits[np.concatenate([[True], unit[1:] != unit[:-1]])]
            stop[at] = stop[at + 1]
            keep = np.ones(len(start), bool)
            keep[at + 1] = False
            last = head + count - 1
            at_end = at + 1 == last
            cost[at[at_end]] = NONE
            inside = ~at_end
            cost[at[inside]] = price(start[at[inside]], stop[at[inside] + 2])
            before = at > head
            cost[at[before] - 1] = price(start[at[before] - 1], stop[at[before]])
            start, stop, cost = start[keep], stop[keep], cost[keep]
            count = count - 1
            head = np.cumsum(count) - count
        if not done:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        start, stop = (np.concatenate(x) for x in zip(*done, strict=True))
        by = np.argsort(start)
        return start[by], stop[by]

    def learn(self, units: list[str]) -> list[bytes]:
        """Ids of units, as little-endian 32-bit words."""
        out: list[bytes] = []
        begin = 0
        while begin < len(units):
            size, stop = 0, begin
            while stop < len(units) and (stop == begin or size + len(units[stop]) < INDEXED):
                size += len(units[stop]) + 1
                stop += 1
            out += self._indexed(units[begin:stop])
            begin = stop
        return out

    def _indexed(self, some: list[str]) -> list[bytes]:
        points = np.frombuffer("\0".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
        at, sizes, ids = self.edges(points)
        length = np.array([len(u) for u in some], np.int64)
        begin = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
        lattice = np.full((len(points) + 1, self.longest + 1), -1, np.int32)
        lattice[at, sizes] = ids
        short = length <= LONG
        first, last = self.relax_all(begin[short], length[short], lattice)
        found = lattice[first, np.minimum(last - first, self.longest)]
        raw = found.astype("<u4").tobytes()
        cut = np.searchsorted(first, begin).tolist()
        end = np.searchsorted(first, begin + length).tolist()
        uncovered = np.zeros(len(first) + 1, np.int64)
        np.cumsum(found < 0, out=uncovered[1:])
        odd = uncovered[end] > uncovered[cut]
        out = []
        for n, (b, e, plain, whole) in enumerate(zip(cut, end, short.tolist(), odd.tolist(), strict=True)):
            if plain and not whole:
                out.append(raw[4 * b : 4 * e])
                continue
            if plain:
                pairs = zip(first[b:e] - begin[n], last[b:e] - begin[n], found[b:e].tolist(), strict=True)
                each = (([i] if i >= 0 else [self.byte_ids[x] for x in some[n][f:t].encode("utf-8", "surrogatepass")]) for f, t, i in pairs)
                out.append(np.array([i for part in each for i in part], "<u4").tobytes())
                continue
            b, e = np.searchsorted(at, [begin[n], begin[n] + length[n]])
            own = dict(zip(zip((at[b:e] - begin[n]).tolist(), (at[b:e] - begin[n] + sizes[b:e]).tolist(), strict=True), ids[b:e].tolist(), strict=True))
            out.append(np.array(self.relax(some[n], own), "<u4").tobytes())
        return out

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of texts laid end to end, where each text's begin, and the end)."""
        raw = data.tobytes()
        if MARK.encode() in raw:  # the mark itself is read as a space
            cut = offsets.tolist()
            data, offsets = join_texts([raw[b:e].replace(MARK.encode(), b" ") for b, e in zip(cut, cut[1:], strict=False)])
        # a space before each text that isn't empty
        full = np.diff(offsets) > 0
        shift = np.concatenate([[0], np.cumsum(full)])
        spaced = np.full(len(data) + shift[-1], 32, np.uint8)
        spaced[np.arange(len(data)) + np.repeat(shift[1:], np.diff(offsets))] = data
        offsets = offsets + shift
        space = spaced == 32
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[offsets[:-1][full]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(spaced))

        def learn(new: np.ndarray) -> list[bytes]:
            return self.learn([spaced[b:e].tobytes().decode().replace(" ", MARK) for b, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])

        ids, count = self.table.numbers(spaced, starts, ends, learn)
        return ids, np.concatenate([[0], np.cumsum(count)])[np.searchsorted(starts, offsets)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit words."""
        ids, cuts = self.encode_block(*join_texts([t.encode() for t in texts]))
        raw, cuts = ids.astype("<u4").tobytes(), (4 * cuts).tolist()
        return [raw[b:e] for b, e in zip(cuts, cuts[1:], strict=False)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, runs of byte pieces read as UTF-8 (a byte that isn't
        part of a character becomes U+FFFD), the leading space of the encoder dropped."""
        try:  # a run of bytes that isn't UTF-8 isn't so among whole characters either
            text = b"".join(map(self.raw_of.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            parts, run = [], bytearray()
            for i in ids:
                if i in self.byte_of:
                    run.append(self.byte_of[i])
                    continue
                if run:
                    parts.append(_utf8(bytes(run)))
                    run.clear()
                parts.append(self.text_of[i])
            parts.append(_utf8(bytes(run)))
            text = "".join(parts)
        return text[1:] if text.startswith(" ") else text


def _utf8(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for n in (4, 3, 2, 1):
                try:
                    out.append(raw[i : i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


def model(path: str) -> Model:
    return held(("pieces", path), lambda: Model(path))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` (doc_id, text) with ``ids`` array<int>; a null or empty text has no ids."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(path)
        for batch in batches:
            for begin, end, data, offsets in blocks(*column_bytes(batch.column(1)), BLOCK):
                ids, cuts = known.encode_block(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, ids array<int>")


def piece_report(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, n_chars, decoded_sha256, round_trip) for every row of ``docs``
    (doc_id, text): texts are encoded, and the ids decoded again. A null or empty text has no
    pieces and decodes to nothing. Repeated rows come back each; further columns are ignored."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(path)
        for batch in batches:
            out: list[tuple] = []
            for _, _, data, offsets in blocks(*column_bytes(batch.column(1)), BLOCK):
                ids, cuts = known.encode_block(data, offsets)
                raw, cuts, places = memoryview(ids.astype("<u4").tobytes()), cuts.tolist(), offsets.tolist()
                for n, (b, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    back = known.decode(ids[b:e].tolist())
                    # the word mark itself decodes to a space
                    text, told = data[places[n] : places[n + 1]].tobytes().replace(MARK.encode(), b" "), back.encode("utf-8", "surrogatepass")
                    out.append((e - b, zlib.crc32(raw[4 * b : 4 * e]), len(back), hashlib.sha256(told).hexdigest(), told == text))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "n_pieces", "ids_crc32", "n_chars", "decoded_sha256", "round_trip"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, n_pieces long, ids_crc32 long, n_chars long, decoded_sha256 string, round_trip boolean")
