"""Removal of byte passages that already occurred, by distributed difference-cover suffix sorting.

1. Every ``length``-byte window has an anchor, its k-gram of least hash, at an offset that depends
   on the window's bytes alone. Runs of windows with one anchor, with the bytes they span (their
   *context*), are dealt out by the anchor's hash, so equal windows meet. A context that was seen
   before, byte for byte by 128 bits of hash, is removed at once and needs no sorting; an anchor
   with a single context needs none either.
2. The other contexts (first occurrences whose anchor has different contexts) are cut out of their
   texts and dealt into shards by anchor. Each shard sorts its suffixes by the difference cover
   modulo 3: triples at positions 1 and 2 modulo 3 are sorted and named, names that repeat are
   sorted by recursion, the remaining suffixes by their first symbol and the rank that follows, and
   the two orders are merged. Neighbours in the order that share ``length`` bytes form a class; all
   of its windows but the earliest are removed.
   An anchor with very many contexts is first split by longer anchors within it.
3. The windows found are merged to byte runs for each document and cut out.

Names that span ``length`` bytes or more need no further recursion, as no longer prefix is compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import RangeHash, blocks, column_bytes, minimizer_runs
from .common import releasing, staged

CHUNK = 1 << 18
#: Bytes of the anchor.
GRAM = 32
#: An anchor with more contexts than this is split by longer anchors, see ``grams``.
HOT = 2000
#: A context is packed as first start * 256 + number of starts - 1 (fewer than 256).
PACK = 256


# ---------------------------------------------------------------- suffix sorting


def _names(columns: list[np.ndarray]) -> tuple[np.ndarray, bool]:
    """Ranks from 1 of the rows of equally long columns, and whether all differ."""
    key = columns[0].astype(np.uint64)
    width = [int(c.max()).bit_length() if len(c) else 0 for c in columns]
    if sum(width) <= 64:
        for c, w in zip(columns[1:], width[1:], strict=True):
            key = (key << np.uint64(w)) | c.astype(np.uint64)
        order = np.argsort(key)
        same = key[order][1:] != key[order][:-1]
    else:
        first, _ = _names(columns[:2])
        return _names([first, *columns[2:]])
    names = np.empty(len(key), np.int64)
    names[order] = np.concatenate([[1], 1 + np.cumsum(same)]) if len(key) else []
    return names, bool(same.all())


def suffix_array(symbols: np.ndarray, spans: int = 1, enough: int = 1 << 60) -> np.ndarray:
    """Suffixes of ``symbols`` (positive integers) in order, by the difference cover modulo 3.

    ``spans`` is how many bytes a symbol covers; once names cover ``enough`` bytes, names that
    still repeat are left in order of position, and suffixes are in order of that prefix only.
    """
    n = len(symbols)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    s = np.concatenate([symbols, np.zeros(3, symbols.dtype)])
    # Sample: positions 1 and 2 modulo 3, one more past the end where n is 1 modulo 3.
    one = np.arange(1, n + (n % 3 == 1), 3)
    two = np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    names, unique = _names([s[sample], s[sample + 1], s[sample + 2]])
    if unique or spans * 3 >= enough:
        order = np.argsort(names, kind="stable")
    else:
        order = suffix_array(names, spans * 3, enough)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(order) + 1)
    if spans * 3 >= enough:
        rank[sample] = names
    sampled = sample[order]
    sampled = sampled[sampled < n]
    # The remaining suffixes: their first symbol, then the rank of the suffix that follows.
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort((s[rest].astype(np.uint64) << np.uint64(32)) | rank[rest + 1].astype(np.uint64), kind="stable")]
    return _merged(s, rank, rest, sampled)


def _packed(left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One comparable key for each row of two lists of columns."""
    m = len(left[0])
    columns = [np.concatenate(x) for x in zip(left, right, strict=True)]
    if sum(int(c.max()).bit_length() if len(c) else 0 for c in columns) <= 63:
        key = np.zeros(len(columns[0]), np.int64)
        for c in columns:
            key = (key << (int(c.max()).bit_length() if len(c) else 0)) | c.astype(np.int64)
    else:
        key, _ = _names(columns)
    return key[:m], key[m:]


def _merged(s: np.ndarray, rank: np.ndarray, rest: np.ndarray, sampled: np.ndarray) -> np.ndarray:
    """Merges two sorted lists of suffixes: a remaining suffix compares with a sampled one at 1
    modulo 3 by (symbol, rank), with one at 2 modulo 3 by (symbol, symbol, rank)."""
    one, two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    key, other = _packed([s[rest], rank[rest + 1]], [s[one], rank[one + 1]])
    less = np.searchsorted(other, key)
    key, other = _packed([s[rest], s[rest + 1], rank[rest + 2]], [s[two], s[two + 1], rank[two + 2]])
    less = np.maximum.accumulate(less + np.searchsorted(other, key)) if len(rest) else less
    out = np.empty(len(rest) + len(sampled), np.int64)
    at = less + np.arange(len(rest))
    free = np.ones(len(out), bool)
    free[at] = False
    out[at] = rest
    out[free] = sampled
    return out


def repeated_windows(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For windows at ``starts``, the index of their class of equal bytes, from a suffix array of
    ``data`` (in which no window crosses a cut)."""
    wanted = np.full(len(data), -1, np.int64)
    wanted[starts] = np.arange(len(starts))
    order = suffix_array(data.astype(np.int64) + 1, 1, length)
    order = order[wanted[order] >= 0]
    same = np.ones(max(0, len(order) - 1), bool)
    for k in range(0, length, 8):  # adjacent prefixes
        live = np.flatnonzero(same)
        if not len(live):
            break
        steps = np.arange(k, min(k + 8, length))
        same[live] = (data[order[live][:, None] + steps] == data[order[live + 1][:, None] + steps]).all(axis=1)
    label = np.empty(len(starts), np.int64)
    label[wanted[order]] = np.concatenate([[0], np.cumsum(~same)]) if len(order) else []
    return label


# ---------------------------------------------------------------- the dataflow


def grams(length: int) -> list[int]:
    """Lengths of anchors, ever longer; the last is the whole window, so that under one anchor all
    windows are equal and none is left to sort."""
    out, rest = [min(GRAM, length)], length - min(GRAM, length)
    while rest:
        rest = rest // 2 if rest > 4 else 0
        out.append(length - rest)
    return out


def _runs(bodies: DataFrame, length: int, gram: int) -> DataFrame:
    """From (doc_id, body, base), bytes that begin at ``base`` in their document: context rows (kind
    0: akey, ckey, doc_id, at) of first occurrences in a batch, and (kind 1) contexts that the batch
    itself shows to be repeats."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, base = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 2))
            found = []
            for begin, end, data, offsets in blocks(*column_bytes(batch.column(1)), CHUNK):
                at, first, last, akey = minimizer_runs(data, offsets, length, gram)
                if len(at):
                    ckey = RangeHash(data, 1).of(first, last + length) + (at - first).astype(np.uint64)
                    which = np.searchsorted(offsets, first, side="right") - 1
                    # a text without bytes shares its offset with the next one
                    found.append((akey.view(np.int64), ckey.view(np.int64), ids[begin + which], (base[begin + which] + first - offsets[which]) * PACK + last - first))
            if not found:
                continue
            akey, ckey, doc, at = (np.concatenate(x) for x in zip(*found, strict=True))
            # A context that the batch itself repeats is settled; it is dealt out by its place, so
            # that many copies of one passage don't meet in one task.
            order = np.lexsort((at, doc, ckey, akey))
            akey, ckey, doc, at = akey[order], ckey[order], doc[order], at[order]
            kind = np.zeros(len(akey), np.int32)
            kind[1:] = (akey[1:] == akey[:-1]) & (ckey[1:] == ckey[:-1])
            head = np.maximum.accumulate(np.where(kind == 0, np.arange(len(kind)), 0))
            same = (kind == 1) & (doc == doc[head]) & (at == at[head])
            akey = np.where(kind == 1, doc * 1_000_003 + at, akey)
            akey, ckey, doc, at, kind = (x[~same] for x in (akey, ckey, doc, at, kind))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (akey, ckey, doc, at, kind)], ["akey", "ckey", "doc_id", "at", "kind"])

    return bodies.mapInArrow(releasing(scan), "akey long, ckey long, doc_id long, at long, kind int")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over contexts sorted by (akey, ckey, doc_id, at): repeats (kind 1), and the first contexts
    (kind 0) of anchors that have more than one. An anchor's first context waits until a second
    one shows up, so one row is held between batches whatever the size of a group."""
    before = waiting = None
    for batch in batches:
        akey, ckey, doc, at, kind = (batch.column(i).to_numpy() for i in range(5))
        known = kind == 1
        told = [akey[known], doc[known], at[known], kind[known]]
        akey, ckey, doc, at = (x[~known] for x in (akey, ckey, doc, at))
        if len(akey):
            now = np.stack([akey, ckey, doc, at])
            last = np.concatenate([now[:, :1] if before is None else before, now[:, :-1]], axis=1)
            new_a = now[0] != last[0]
            if before is None:
                new_a[0] = True
            new_c = new_a | (now[1] != last[1])
            again = ~new_a & (now == last).all(axis=0)  # a repeated row of the table
            group = np.cumsum(new_a)
            several = np.bincount(group[new_c & ~new_a], minlength=group[-1] + 1) > 0
            out = (~new_c & ~again) | (new_c & ~new_a) | (new_a & several[group])
            rows = [akey[out], doc[out], at[out], np.where(new_c, 0, 1)[out]]
            if several[0] and waiting is not None:
                rows = [np.concatenate([[w], r]) for w, r in zip((*waiting, 0), rows, strict=True)]
                waiting = None
            if group[-1] > 0:
                begin = np.flatnonzero(new_a)[-1]
                waiting = None if several[-1] else (akey[begin], doc[begin], at[begin])
            before = now[:, -1:]
            told = [np.concatenate(x) for x in zip(told, rows, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in told[:3]] + [pa.array(told[3].astype(np.int32))], ["akey", "doc_id", "at", "kind"])


def _cut_out(length: int):
    """From (doc_id, text, contexts): the bytes of each context."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for i, spots in enumerate(batch.column(2).to_pylist()):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                for spot in spots:
                    first, more = divmod(spot["at"], PACK)
                    if first + more + length <= len(text):  # else of another row with this doc_id
                        rows.append((spot["akey"], spot["hot"], ids[i], first, text[first : first + more + length]))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["akey", "hot", "doc_id", "first", "body"])

    return scan


def _sorted_shard(length: int, most: int = 1 << 19):
    """Contexts sorted by anchor: suffix-sorts runs of whole anchors of about ``most`` bytes and
    returns the windows that occurred before, as (doc_id, at)."""

    def solve(akey: np.ndarray, doc: np.ndarray, first: np.ndarray, bodies: list[bytes]) -> pa.RecordBatch:
        sizes = np.array([len(b) for b in bodies], np.int64)
        data = np.frombuffer(b"".join(bodies), np.uint8)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        count = sizes - length + 1
        owner = np.repeat(np.arange(len(bodies)), count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        label = repeated_windows(data, begin[owner] + step, length)
        where = first[owner] + step
        order = np.lexsort((where, doc[owner], label))
        seen = np.zeros(len(order), bool)
        seen[1:] = label[order][1:] == label[order][:-1]
        # the earliest place itself may stand in two contexts; it stays
        head = np.maximum.accumulate(np.where(~seen, np.arange(len(order)), 0))
        seen &= (doc[owner][order] != doc[owner][order][head]) | (where[order] != where[order][head])
        hit = np.sort(order[seen])
        if not len(hit):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64())], ["doc_id", "at"])
        o, w = owner[hit], where[hit]
        edge = np.ones(len(hit), bool)
        edge[1:] = (o[1:] != o[:-1]) | (w[1:] != w[:-1] + 1)
        at = np.flatnonzero(edge)
        stop = np.append(at[1:], len(hit)) - 1
        return pa.RecordBatch.from_arrays([pa.array(doc[o[at]]), pa.array(w[at] * PACK + w[stop] - w[at])], ["doc_id", "at"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for key, doc, first, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if size > most and key != last:
                    a, d, f, b = zip(*held, strict=True)
                    yield solve(np.array(a), np.array(d, np.int64), np.array(f, np.int64), list(b))
                    held, size = [], 0
                held.append((key, doc, first, body))
                size += len(body)
                last = key
        if held:
            a, d, f, b = zip(*held, strict=True)
            yield solve(np.array(a), np.array(d, np.int64), np.array(f, np.int64), list(b))

    return scan


def repeated_runs(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc_id, at): runs of window starts, packed, whose bytes also start earlier.

    Contexts meet by their anchor and are sorted in shards of whole anchors. Those of an anchor with
    more than ``HOT`` are cut again by a longer anchor, and so on; however many contexts share a
    passage, none is ever gathered with all the others."""
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    bodies = docs.select("doc_id", F.col("text").cast("binary").alias("body"), F.lit(0).cast("long").alias("base"))
    found = None
    for gram in grams(length):
        met = _runs(bodies, length, gram).repartition("akey").sortWithinPartitions("akey", "ckey", "doc_id", "at")
        met = staged(met.mapInArrow(releasing(_met), "akey long, doc_id long, at long, kind int"), "contexts")
        firsts = met.where("kind = 0")
        hot = firsts.groupBy("akey").count().where(F.col("count") > HOT).select("akey", F.lit(True).alias("hot"))
        spots = firsts.join(hot, "akey", "left").groupBy("doc_id").agg(F.collect_list(F.struct("akey", "at", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("spots"))
        cut = docs.join(spots, "doc_id").select("doc_id", "text", "spots").mapInArrow(releasing(_cut_out(length)), "akey long, hot boolean, doc_id long, first long, body binary")
        cut = staged(cut, "cuts")
        shards = cut.where("not hot").select("akey", "doc_id", "first", "body").repartition("akey").sortWithinPartitions("akey")
        here = met.where("kind = 1").select("doc_id", "at").union(shards.mapInArrow(releasing(_sorted_shard(length)), "doc_id long, at long"))
        found = here if found is None else found.union(here)
        bodies = cut.where("hot").select("doc_id", "body", F.col("first").alias("base"))
        if bodies.isEmpty():
            break
    return found


def _merged_spans(ats: list[int], length: int, size: int) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    for at in sorted(ats):
        first, more = divmod(at, PACK)
        end = min(first + more + length, size)
        if first >= size:
            continue
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], end))
        else:
            spans.append((first, end))
    return spans


def with_spans(docs: DataFrame, length: int = 100) -> DataFrame:
    """``docs`` (doc_id first, then any columns with ``text``) with one more column ``__repeat_runs``: the
    packed runs of each document, null where there are none. Left as they are otherwise."""
    found = repeated_runs(docs, length).groupBy(F.col("doc_id").alias("__repeat_doc")).agg(F.collect_list("at").alias("__repeat_runs"))
    return docs.join(found, docs["doc_id"].cast("long") == F.col("__repeat_doc"), "left").drop("__repeat_doc")


def suffix_dedup_report(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs`` (doc_id, text).

    A null or empty text has no bytes and keeps none. A text shorter than ``length`` keeps all.
    Rows with a null doc_id take no part and keep their text. A row of the table that is repeated
    counts once and comes back each time; rows with one doc_id and different texts are taken as
    one document whose removed byte places are those of all. Further columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            out: list[tuple] = []
            for i, ats in enumerate(batch.column(2).to_pylist()):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                spans = _merged_spans(ats, length, len(text)) if ats else []
                kept, done = hashlib.sha256(), 0
                for first, end in spans:
                    kept.update(text[done:first])
                    done = end
                kept.update(text[done:])
                out.append((len(text), sum(e - f for f, e in spans), len(spans), kept.hexdigest()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = with_spans(docs.select(F.col("doc_id").cast("long"), "text"), length)
    return rows.select("doc_id", "text", "__repeat_runs").mapInArrow(releasing(scan), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def suffix_dedup(docs: DataFrame, length: int = 100) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``. A character that loses one of its
    bytes goes as a whole, so texts stay valid UTF-8. A null text stays null; a text that loses
    all its bytes becomes empty. Rows and columns are kept."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
        data, offsets = column_bytes(texts)
        out = texts.to_pylist()
        for i, ats in enumerate(runs.to_pylist()):
            if ats:
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                done, parts = 0, []
                for first, end in _merged_spans(ats, length, len(raw)):
                    while first > done and raw[first] & 0xC0 == 0x80:
                        first -= 1
                    while end < len(raw) and raw[end] & 0xC0 == 0x80:
                        end += 1
                    parts.append(raw[done:first])
                    done = end
                parts.append(raw[done:])
                out[i] = b"".join(parts).decode("utf-8", "ignore")
        return pa.array(out, pa.string())

    rows = with_spans(docs, length)
    return rows.withColumn("text", cut("text", "__repeat_runs")).select(docs.columns)
