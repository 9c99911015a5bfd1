"""Approximate nearest neighbours by an inverted multi-index.

Each half of a vector is quantised by its own codebook; a cell is a pair of centroids. Both
codebooks are fitted on a bounded sample, and every distinct vector is filed in its cell. A query
traverses the pairs in order of their summed distance, with a heap over the two sorted lists, until
the cells hold the wanted share of all vectors; their vectors are ranked again by the exact inner
product. Distance of a half is the negative inner product with its centroid. The share is the least
of a few that reaches the wanted recall within the sample (self-measured, leaving the query out).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .vectors import SHARD, best, blocked_scan, classes, queries_of, sample_matrix, sequential_products, take_best, valid

SAMPLE = 20_000
SHARES = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0)
RESULT = "query_id long, vec_id long, score double"


def codebook(x: np.ndarray, k: int, rounds: int = 10, seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        for j in range(len(centres)):
            own = near == j
            if own.any():
                centres[j] = x[own].mean(axis=0)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells in order of first[i] + second[j], until those met hold ``wanted`` vectors. The next
    cell of each row of the grid waits in the heap once the cell before it was met."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    fa, fb = first[a].tolist(), second[b].tolist()
    heap, cells, met = [(fa[0] + fb[0], 0, 0)], [], 0
    wide = len(b)
    grid = sizes[np.ix_(a, b)]
    while heap and met < wanted:
        _, i, j = heapq.heappop(heap)
        if grid[i, j]:
            cells.append(int(a[i]) * wide + int(b[j]))
            met += int(grid[i, j])
        if j + 1 < wide:
            heapq.heappush(heap, (fa[i] + fb[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (fa[i + 1] + fb[0], i + 1, 0))
    return cells


def calibrated_share(x: np.ndarray, one: np.ndarray, two: np.ndarray, k: int, recall: float, tries: int = 200) -> float:
    """The least share with which ``tries`` sample vectors find ``recall`` of their true k."""
    half = x.shape[1] // 2
    cell = nearest(x[:, :half], one) * len(two) + nearest(x[:, half:], two)
    sizes = np.bincount(cell, minlength=len(one) * len(two)).reshape(len(one), len(two))
    spots = np.linspace(0, len(x) - 1, min(tries, len(x))).astype(int)
    need = []
    for q in spots:
        scores = x @ x[q]
        scores[q] = -np.inf
        true = np.argsort(-scores)[: min(k, len(x) - 1)]
        order = traverse(-(one @ x[q, :half]), -(two @ x[q, half:]), sizes, len(x))
        seen = np.cumsum([sizes.flat[c] for c in order]) / len(x)
        where = {c: s for c, s in zip(order, np.concatenate([[0], seen[:-1]]), strict=True)}
        need.append([where[c] for c in cell[true]])
    flat = np.concatenate([np.zeros(1), *need])  # never empty
    return next((s for s in SHARES if (flat < s).mean() >= recall), 1.0)


def nearest_neighbours(embeddings: DataFrame, k: int = 20, step: int = 20, centroids: int = 64, recall: float = 0.96) -> DataFrame:
    """(query_id, rank, vec_id, score): for each valid vector whose id is divisible by ``step``, the
    ``k`` found rows of largest inner product, its own row left out.

    Null and zero vectors and those with null or non-finite components take no part, nor do rows
    without an id or of another length than most. Equal scores are ranked by id. Repeated rows
    count once; an id with several vectors counts with its best one, and asks with the one whose bytes
    come first. Further columns are ignored; without queries or candidates there are no rows.
    """
    spark = embeddings.sparkSession
    rows = valid(embeddings, zero=False)
    found = staged(classes(rows, k), "classes")
    x = sample_matrix(found, SAMPLE)
    if not len(x):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    half = x.shape[1] // 2
    one, two = codebook(x[:, :half], centroids), codebook(x[:, half:], centroids, seed=1)
    share = calibrated_share(x, one, two, k, recall)
    books = spark.sparkContext.broadcast((one, two))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = books.value
        for batch in batches:
            v = np.array([np.frombuffer(b, np.float64) for b in batch.column(0).to_pylist()]).reshape(batch.num_rows, -1)
            cells = nearest(v[:, :half], one) * len(two) + nearest(v[:, half:], two) if len(v) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), *batch.columns], ["cell", "v", "ids"])

    filed = staged(found.mapInArrow(file, "cell long, v binary, ids array<long>"), "index")
    sizes = np.zeros(len(one) * len(two), np.int64)
    for r in filed.groupBy("cell").count().collect():  # at most centroids ** 2 rows
        sizes[r["cell"]] = r["count"]
    # Neighbouring cells fill shards of bounded size; a cell beyond that size gets several.
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    shard_of, spread = before // SHARD, np.maximum(1, -(-sizes // SHARD))
    plan = spark.sparkContext.broadcast((shard_of, spread, sizes.reshape(len(one), len(two)), max(1, int(np.ceil(share * total)))))
    cells = spark.createDataFrame([(int(c), int(shard_of[c]), int(spread[c])) for c in np.flatnonzero(sizes)], "cell long, first long, spread long")
    base = filed.join(F.broadcast(cells), "cell").select((F.col("first") + F.pmod(F.xxhash64("v"), "spread")).alias("shard"), "cell", "v", "ids")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = books.value
        shard_of, spread, grid, wanted = plan.value
        for batch in batches:
            out: list[tuple] = []
            for query, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                q = np.frombuffer(body, np.float64)
                visited: dict[int, list[int]] = {}
                for c in traverse(-(one @ q[:half]), -(two @ q[half:]), grid, wanted):
                    for s in range(int(spread[c])):
                        visited.setdefault(int(shard_of[c]) + s, []).append(c)
                out += ((s, query, body, np.array(cs, np.int32).tobytes()) for s, cs in visited.items())
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["shard", "query_id", "v", "want"])

    asked = staged(queries_of(rows, step).mapInArrow(route, "shard long, query_id long, v binary, want binary"), "asked")

    def prepare(cell, v, ids):
        order = np.argsort(cell, kind="stable")
        names, begin = np.unique(cell[order], return_index=True)
        slots = dict(zip(names.tolist(), zip(begin.tolist(), [*begin[1:].tolist(), len(cell)], strict=True), strict=True))
        return v[order], [ids[i] for i in order], slots, float(np.sqrt((v * v).sum(axis=1)).max(initial=0.0))

    def answer(state, queries, q, wants):
        v, ids, slots, longest = state
        out: list[tuple] = []
        for query, row, want in zip(queries.tolist(), q, wants, strict=True):
            spans = [slots[c] for c in np.frombuffer(want, np.int32).tolist() if c in slots]
            if not spans:
                continue
            pick = np.concatenate([np.arange(b, e) for b, e in spans])
            rough = v[pick] @ row
            slack = 4 * len(row) * np.finfo(np.float64).eps * longest * float(np.sqrt(row @ row))
            most, found = k + 1, []
            while len(found) < k:  # more than once only if ids repeat with many near vectors
                if whole := most >= len(pick):
                    some = pick
                else:  # all that may tie with the last of them, as both products round
                    some = pick[rough >= np.partition(rough, len(rough) - most)[len(rough) - most] - slack]
                scores = sequential_products(v[some], np.broadcast_to(row, (len(some), len(row))))
                found = take_best(query, scores, [ids[i] for i in some], k)
                if whole:
                    break
                most *= 4
            out += ((query, vec, score) for vec, score in found)
        columns = list(zip(*out, strict=True)) if out else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])

    return best(blocked_scan(base, asked, prepare, answer, RESULT), k, "double")
