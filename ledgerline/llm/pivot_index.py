"""Exact top-k inner products of integer vectors by a pivot-distance index.

Inner products become distances by one more component: with M the largest length of a candidate,
x' = (x, sqrt(M*M - |x|^2)) and q' = (q, 0) have |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the largest
product is the least distance. Vectors are keyed by their nearest pivot and their distance to it;
a pivot's key range is cut into annuli. A query first searches the annuli around its own distance to
its nearest pivot, which gives a k-th best score. By the triangle inequality an annulus [r0, r1] of
pivot p holds nothing nearer than max(d(q, p) - r1, r0 - d(q, p)); annuli are taken in the order of
that bound until it excludes the k-th best score. Products are computed in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .multi_index import codebook
from .vectors import SHARD, best, blocked_scan, classes, queries_of, sample_matrix, take_best, valid

SAMPLE = 20_000
RESULT = "query_id long, vec_id long, score long"


def lifted(x: np.ndarray, square: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(0.0, square - (x**2).sum(axis=1)))[:, None]], axis=1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (x**2).sum(axis=1)[:, None] - 2 * (x @ pivots.T) + (pivots**2).sum(axis=1)))


def top_products(embeddings: DataFrame, k: int = 5, step: int = 50, scale: int = 256, pivots: int = 48, rings: int = 24) -> DataFrame:
    """(query_id, rank, vec_id, score): for each valid vector whose id is divisible by ``step``, the
    ``k`` other rows of largest integer inner product of floor(scale * component).

    Null vectors and those with null or non-finite components take no part, nor do rows without an
    id or of another length than most. Zero vectors do. Equal scores are ranked by id. Repeated
    rows count once; an id with several vectors counts with its best one, and asks with the one whose
    bytes come first. Further columns are ignored; without queries or candidates there are no rows.
    Exact: products are summed in double precision while they stay below 2**53, and in 64-bit
    integers beyond; vectors whose squared length exceeds 2**62 are refused.
    """
    spark = embeddings.sparkSession
    rows = valid(embeddings, zero=True)
    rows = rows.withColumn("v", F.transform("v", lambda c: F.floor(c * scale).cast("double")))
    found = staged(classes(rows, k), "classes")
    x = sample_matrix(found, SAMPLE)
    if not len(x):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float((np.frombuffer(b, np.float64) ** 2).sum()) for b in batch.column(0).to_pylist()], pa.float64())], ["square"])

    square = found.select("v").mapInArrow(lengths, "square double").agg(F.max("square")).first()[0]
    if square > 2.0**62:
        raise ValueError("vectors too long for 64-bit products")
    wide = square >= 2.0**53  # by which no inner product of two vectors is larger
    centres = codebook(lifted(x, square), pivots)
    near = distances(lifted(x, square), centres)
    own = near.argmin(axis=1)
    # Ring edges by the sample's distances; the first and last ring are open.
    edges = np.array([np.quantile(near[own == p, p], np.linspace(0, 1, rings + 1)[1:-1]) if (own == p).any() else np.zeros(rings - 1) for p in range(len(centres))])
    index = spark.sparkContext.broadcast((centres, edges, square))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, edges, square = index.value
        for batch in batches:
            v = np.array([np.frombuffer(b, np.float64) for b in batch.column(0).to_pylist()]).reshape(batch.num_rows, -1)
            far = distances(lifted(v, square), centres) if len(v) else np.empty((0, len(centres)))
            pivot = far.argmin(axis=1) if len(v) else np.empty(0, np.int64)
            away = far[np.arange(len(v)), pivot]
            ring = np.array([np.searchsorted(edges[p], d, side="right") for p, d in zip(pivot, away, strict=True)], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pivot * rings + ring, pa.int64()), pa.array(away, pa.float64()), *batch.columns], ["cell", "away", "v", "ids"])

    filed = staged(found.mapInArrow(file, "cell long, away double, v binary, ids array<long>"), "index")
    ranges = filed.groupBy("cell").agg(F.min("away").alias("r0"), F.max("away").alias("r1"), F.count("*").alias("n")).orderBy("cell").collect()  # at most pivots * rings
    cell = np.array([r["cell"] for r in ranges])
    r0, r1, n = (np.array([r[c] for r in ranges], float) for c in ("r0", "r1", "n"))
    first = ((np.cumsum(n) - n) // SHARD).astype(np.int64)
    spread = np.maximum(1, -(-n // SHARD)).astype(np.int64)
    plan = spark.sparkContext.broadcast((cell, r0, r1, n, first, spread))
    table = spark.createDataFrame([(int(c), int(f), int(s)) for c, f, s in zip(cell, first, spread, strict=True)], "cell long, first long, spread long")
    base = staged(filed.join(F.broadcast(table), "cell").select((F.col("first") + F.pmod(F.xxhash64("v"), "spread")).alias("shard"), "cell", "v", "ids"), "base")

    def bounds(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least distance of each annulus by the triangle inequality, and the pivots' distances."""
        centres, _, _ = index.value
        cell, r0, r1, *_ = plan.value
        d = distances(np.concatenate([q, [0.0]])[None], centres)[0]
        to = d[cell // rings]
        return np.maximum(0.0, np.maximum(to - r1, r0 - to)), d

    def sent(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["shard", "query_id", "v", "want"])

    def spread_out(query: int, body: bytes, which: np.ndarray) -> list[tuple]:
        cell, _, _, _, first, spread = plan.value
        visited: dict[int, list[int]] = {}
        for i in which.tolist():
            for s in range(int(spread[i])):
                visited.setdefault(int(first[i]) + s, []).append(int(cell[i]))
        return [(s, query, body, np.array(cs, np.int64).tobytes()) for s, cs in visited.items()]

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The annuli of the nearest pivot around the query's own distance, some more than k rows."""
        for batch in batches:
            out: list[tuple] = []
            for query, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                least, d = bounds(np.frombuffer(body, np.float64))
                cell, _, _, n, _, _ = plan.value
                order = np.lexsort((least, d[cell // rings]))
                enough = int(np.searchsorted(np.cumsum(n[order]), 4 * (k + 1))) + 1
                out += spread_out(query, body, order[:enough])
            yield sent(out)

    def onward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All annuli that the bound doesn't exclude, given the k-th best score so far."""
        square = index.value[2]
        for batch in batches:
            out: list[tuple] = []
            for query, body, kth in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                q = np.frombuffer(body, np.float64)
                least, _ = bounds(q)
                order = np.argsort(least)
                if kth is not None:
                    # one part in 10**9 and one unit of slack for rounding
                    reach = np.sqrt(max(0.0, float(q @ q) + square - 2.0 * (kth - 1)) + 1e-9 * square) * (1 + 1e-9) + 1e-6
                    order = order[: int(np.searchsorted(least[order], reach, side="right"))]
                out += spread_out(query, body, order)
            yield sent(out)

    def prepare(cells, v, ids):
        return cells, v, ids

    def answer(state, queries, q, wants):
        cells, v, ids = state
        out: list[tuple] = []
        products = (q.astype(np.int64) @ v.T.astype(np.int64)) if wide else q @ v.T  # whole numbers
        for query, row, want in zip(queries.tolist(), products, wants, strict=True):
            pick = np.flatnonzero(np.isin(cells, np.frombuffer(want, np.int64)))
            out += ((query, vec, int(score)) for vec, score in take_best(query, row[pick], [ids[i] for i in pick], k))
        columns = list(zip(*out, strict=True)) if out else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    asking = staged(queries_of(rows, step), "queries")
    shape = "shard long, query_id long, v binary, want binary"
    start = best(blocked_scan(base, staged(asking.mapInArrow(home, shape), "home"), prepare, answer, RESULT), k, "long")
    start = staged(start, "start")
    kth = start.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    rest = staged(asking.join(kth, "query_id", "left").select("query_id", "v", "kth").mapInArrow(onward, shape), "onward")
    hits = start.select("query_id", "vec_id", "score").union(blocked_scan(base, rest, prepare, answer, RESULT))
    return best(hits, k, "long")
