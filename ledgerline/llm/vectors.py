"""Shared parts of the two vector searches: valid vectors, classes of equal vectors, blocked scans.

Equal vectors are one class with its ``k + 1`` least ids: no query can need more of them, since
equal vectors have equal scores and ties go to the smaller id. So a vector that a third of all rows
share is one row of the index.

A blocked scan sends index rows to shards of bounded size and each query to the shards it has to
look into. Within a task the rows of a shard come first and are held; its queries then stream by in
batches, so that memory doesn't grow with the number of queries. Shards that many queries ask are
held by several tasks, each with a part of the queries.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD = 16384
#: Queries that one task takes for one shard.
PART = 20_000


def matrix(column) -> tuple[np.ndarray, np.ndarray]:
    """The valid rows of an Arrow list column as float64 (non-null, the commonest length of the
    batch's column is not assumed: the caller filters lengths), and their indexes."""
    rows = [i for i, v in enumerate(column) if v.is_valid]
    if not rows:
        return np.empty((0, 0)), np.empty(0, np.int64)
    values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(rows), -1), np.array(rows)


def valid(embeddings: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, v array<double>): vectors that are not null and hold no null or non-finite
    component; with ``zero`` also all-zero ones. Vectors of another than the commonest length (of
    equally common ones the longer) and rows without an id take no part."""
    v = F.col("v")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where("vec_id is not null and v is not null and size(v) > 0")
    rows = rows.where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    if not zero:
        rows = rows.where(F.exists(v, lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (common["n"] if common else -1))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): distinct vectors with their k + 1 least ids, ascending. Each batch keeps only so
    many ids of a vector before anything is shuffled."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list[int]] = {}
            x, _ = matrix(batch.column(1))
            x = x + 0.0  # -0.0 is 0.0
            for vec_id, row in zip(batch.column(0).to_pylist(), x, strict=True):
                held.setdefault(row.tobytes(), []).append(vec_id)
            ids = [heapq.nsmallest(k + 1, set(v)) for v in held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(ids, pa.list_(pa.int64()))], ["v", "ids"])

    some = rows.select("vec_id", "v").mapInArrow(fold, "v binary, ids array<long>")
    return some.groupBy("v").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))


def sample_matrix(found: DataFrame, most: int) -> np.ndarray:
    """About ``most`` of the class vectors at most, those of least hash: a share of the hash range
    is taken, so tasks send what they have of the sample and no more."""
    n = found.count()
    rows = found.select("v")
    if n > most:
        rows = rows.where(F.pmod(F.xxhash64("v"), F.lit(1 << 40)) < int((1 << 40) * most / n))
    body = sorted(bytes(r.v) for r in rows.collect())
    return np.array([np.frombuffer(b, np.float64) for b in body])


def sequential_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products, summed from the first component to the last."""
    out = np.zeros(len(a))
    for j in range(a.shape[1] if len(a) else 0):
        out += a[:, j] * b[:, j]
    return out


def queries_of(rows: DataFrame, step: int) -> DataFrame:
    """(query_id, v binary): valid vectors whose id is divisible by ``step``, each id once; one with
    several vectors asks with the one whose bytes come first."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x + 0.0], pa.binary())], ["query_id", "v"])

    return rows.where(F.col("vec_id") % step == 0).select("vec_id", "v").mapInArrow(pack, "query_id long, v binary").groupBy("query_id").agg(F.min("v").alias("v"))


def blocked_scan(base: DataFrame, asked: DataFrame, prepare: Callable, answer: Callable, result: str) -> DataFrame:
    """base: (shard, cell, v, ids); asked: (shard, query_id, v, want binary).

    ``prepare(cells, matrix, ids)`` makes a shard's state; ``answer(state, ids, matrix, wants)``
    returns the Arrow columns of ``result`` for a batch of its queries.
    """
    parts = asked.groupBy("shard").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    rows = base.join(parts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"), F.col("cell").cast("long").alias("key"), "v", "ids", F.lit(None).cast("binary").alias("want"))
    asking = asked.join(parts, "shard").select("shard", F.pmod(F.xxhash64("query_id"), "parts").cast("int").alias("part"), F.lit(1).alias("side"), F.col("query_id").alias("key"), "v", F.lit(None).cast("array<long>").alias("ids"), "want")
    both = rows.union(asking).repartition("shard", "part").sortWithinPartitions("shard", "part", "side", "key")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, state = None, [], None
        for batch in batches:
            shard, part, side = (batch.column(i).to_numpy() for i in range(3))
            cut = np.flatnonzero((np.diff(shard) != 0) | (np.diff(part) != 0) | (np.diff(side) != 0)) + 1
            for begin, end in zip([0, *cut], [*cut, len(shard)], strict=True):
                if begin == end:
                    continue
                here = (shard[begin], part[begin])
                if here != place:
                    place, held, state = here, [], None
                piece = batch.slice(begin, end - begin)
                if side[begin] == 0:
                    held.append((piece.column(3).to_numpy(), np.array([np.frombuffer(v, np.float64) for v in piece.column(4).to_pylist()]), piece.column(5).to_pylist()))
                elif held or state is not None:
                    if state is None:
                        state = prepare(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), [i for h in held for i in h[2]])
                        held = []
                    for at in range(0, len(piece), 256):
                        some = piece.slice(at, 256)
                        x = np.array([np.frombuffer(v, np.float64) for v in some.column(4).to_pylist()])
                        yield answer(state, some.column(3).to_numpy(), x, some.column(6).to_pylist())

    return both.mapInArrow(scan, result)


def best(hits: DataFrame, k: int, kind: str) -> DataFrame:
    """The k best (query_id, rank, vec_id, score) of all hits of each query, which are at most
    some k for each shard it asked. A vec_id with several vectors counts with its best one."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast(kind).alias("score"))


def take_best(query: int, scores: np.ndarray, ids: list[list[int]], k: int) -> list[tuple[int, float]]:
    """The k best (vec_id, score) of classes with scores, the query's own id left out. An id that
    stands in several classes counts once, with its best score, however many of them come first."""
    most = k + 1
    while True:
        whole = most >= len(scores)
        near = np.arange(len(scores)) if whole else np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
        found: dict[int, float] = {}
        for i in near[np.argsort(-scores[near], kind="stable")]:
            for v in ids[i]:
                if v != query:
                    found.setdefault(v, scores[i])
        if whole or len(found) >= k:
            return [(v, -s) for s, v in heapq.nsmallest(k, ((-s, v) for v, s in found.items()))]
        most *= 4
