"""Quality by naive Bayes support vectors.

A text is the set of its n-grams (words, pairs of words, 3 and 4 bytes, and three marks in a row of
whether a word repeats the one before), each hashed to a bucket.
Of every bucket, the learning texts of either label that hold it are counted, over all learning
texts, in Spark; the logarithm of the smoothed ratio of both shares is the bucket's naive Bayes
weight. Indicators scaled by these weights (and texts by their length, so that long texts weigh no
more) are the rows of a linear hinge-loss model, fitted by dual coordinate descent on a bounded
sample. Margins become scores by a logistic curve fitted on margins of texts that the model hadn't
seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytescan import RangeHash, blocks, column_bytes, join_texts
from .common import broadcast_if_small, crc_fold, release, releasing, staged
from .shingles import gram_hashes, word_hashes

BUCKETS = 1 << 18
BYTE_SIZES = (3, 4)
CHUNK = 1 << 18


def bucket_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Yields the ascending distinct buckets of each text's n-grams."""
    low, present = np.uint64(BUCKETS - 1), np.zeros(BUCKETS, bool)
    for begin, end, part, cuts in blocks(data, offsets, CHUNK):
        hashed = RangeHash(part, 1)
        grams = [((hashed.grams(n) >> np.uint64(20 + n)) & low).astype(np.int32) for n in BYTE_SIZES]
        words, firsts = word_hashes(part, cuts)
        for i in range(end - begin):
            first, last = int(cuts[i]), int(cuts[i + 1])
            own = words[firsts[i] : firsts[i + 1]]
            found = [g[first : max(first, last - n + 1)] for n, g in zip(BYTE_SIZES, grams, strict=True)]
            again = gram_hashes((own[1:] == own[:-1]).astype(np.uint64), 3)
            found += [((h >> np.uint64(17)) & low).astype(np.int32) for h in (gram_hashes(own, 1), gram_hashes(own, 2), again)]
            for buckets in found:
                present[buckets] = True
            out = np.flatnonzero(present).astype(np.int32)
            present[out] = False
            yield out


@dataclass(frozen=True)
class Model:
    ratio: np.ndarray  # log-count ratio of each bucket
    weight: np.ndarray  # of each scaled indicator
    bias: float
    curve: tuple[float, float]  # slope and offset of the logistic curve

    def margin(self, buckets: np.ndarray) -> float:
        r = self.ratio[buckets].astype(np.float64)
        return self.bias + float(r @ self.weight[buckets]) / max(1e-12, float(np.sqrt(r @ r)))

    def score(self, buckets: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.curve[0] * self.margin(buckets) + self.curve[1], -40, 40))))


def log_ratios(good: np.ndarray, bad: np.ndarray, n_good: int, n_bad: int, smooth: float = 1.0) -> np.ndarray:
    """log of (share of good texts with the bucket / share of bad ones), both smoothed."""
    return (np.log((good + smooth) / (n_good + 2 * smooth)) - np.log((bad + smooth) / (n_bad + 2 * smooth))).astype(np.float32)


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, costs: np.ndarray, size: int, rounds: int = 15, close: float = 1e-2) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + bias^2 / 2 + sum of cost * max(0, 1 - sign * margin)
    over sparse rows (indexes, values), one dual variable at a time in random order. Ends when no
    variable's projected gradient is above ``close``, or after ``rounds`` passes."""
    w, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            gradient = signs[i] * (float(v @ w[at]) + bias) - 1.0
            projected = min(gradient, 0.0) if alpha[i] <= 0 else max(gradient, 0.0) if alpha[i] >= costs[i] else gradient
            worst = max(worst, abs(projected))
            if projected:
                step = min(max(alpha[i] - gradient / square[i], 0.0), costs[i]) - alpha[i]
                alpha[i] += step
                w[at] += step * signs[i] * v
                bias += step * signs[i]
        if worst <= close:
            break
    return w, bias


def logistic_curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and offset by Newton steps, towards smoothed targets."""
    n1, n0 = good.sum(), len(good) - good.sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * w)
        w = w + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return max(0.0, float(w[0])), float(w[1])


def train(sets: list[np.ndarray], good: np.ndarray, ratio: np.ndarray, share: float, cost: float = 1.0, parts: int = 2) -> Model:
    """The model of a sample, given the ratios of all learning texts. Each label has the same
    total cost. The curve is fitted on margins of each of ``parts`` parts by a model of the others, and
    moved from the sample's share of good texts to ``share``, that of all learning texts."""
    rows = []
    for at in sets:
        v = ratio[at].astype(np.float64)
        rows.append((at, v / max(1e-12, float(np.sqrt(v @ v)))))
    signs = np.where(good, 1.0, -1.0)

    def fitted(chosen: np.ndarray):
        times = {y: max(1, int((good[chosen] == y).sum())) for y in (True, False)}
        costs = np.array([cost * len(chosen) / (2 * times[bool(good[i])]) for i in chosen])
        return dual_descent([rows[i] for i in chosen], signs[chosen], costs, len(ratio))

    margins = np.zeros(len(rows))
    part = np.zeros(len(rows), int)
    for y in (True, False):  # each part has its share of both labels
        own = np.flatnonzero(good == y)
        part[own] = np.arange(len(own)) % parts
    for k in range(parts):
        w, bias = fitted(np.flatnonzero(part != k))
        for i in np.flatnonzero(part == k):
            margins[i] = float(rows[i][1] @ w[rows[i][0]]) + bias
    w, bias = fitted(np.arange(len(rows)))
    slope, offset = logistic_curve(margins, good)
    moved = np.log(share / (1 - share)) - np.log(good.mean() / (1 - good.mean()))
    return Model(ratio, w.astype(np.float32), bias, (slope, offset + float(moved)))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(good, h, text) to (good, h, buckets)."""
    for batch in batches:
        found = list(bucket_sets(*column_bytes(batch.column(2))))
        ends = np.zeros(len(found) + 1, np.int32)
        np.cumsum([len(b) for b in found], out=ends[1:])
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *found])))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["good", "h", "buckets"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(good, text) to (bucket, bad, good): a task's texts with each bucket; bucket -1: all its texts."""
    times = np.zeros((2, BUCKETS + 1), np.int64)
    for batch in batches:
        good = batch.column(0).to_numpy(zero_copy_only=False).astype(int)
        for y, buckets in zip(good, bucket_sets(*column_bytes(batch.column(1))), strict=True):
            times[y, buckets] += 1
            times[y, -1] += 1
    at = np.flatnonzero(times.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(np.where(at == BUCKETS, -1, at).astype(np.int32)), pa.array(times[0][at]), pa.array(times[1][at])], ["bucket", "bad", "good"])


def fit(docs: DataFrame, labels: DataFrame, held_out: int | None = 0, folds: int = 5, most: int = 1200, most_buckets: int = 6 << 20) -> Model | None:
    """Counts n-grams over all labelled texts outside fold ``held_out``, and fits the model on at
    most ``most`` of their ids for each label, those of least hash, as long as the sets of a label
    have ``most_buckets`` buckets in all. Null labels, other labels than 0 and 1, and null texts
    aren't learned from; of several labels of one document the largest counts; of several texts of
    one id each is counted, and the first in order is in the sample. None without both labels."""
    known = labels.where("doc_id is not null and quality in (0, 1)")
    if held_out is not None:
        known = known.where(crc_fold(F.col("doc_id"), folds) != held_out)
    known = staged(known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("quality") == 1).alias("good")), "known")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    # One row for each bucket that occurs: a bounded table.
    told = texts.join(broadcast_if_small(known), "doc_id").select("good", "text").mapInArrow(releasing(_counted), "bucket int, bad long, good long")
    told = told.groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow()
    times = np.zeros((2, BUCKETS + 1), np.int64)
    times[:, told.column("bucket").to_numpy()] = np.stack([told.column("bad").to_numpy(), told.column("good").to_numpy()])
    n_bad, n_good = (int(n) for n in times[:, -1])
    if not n_bad or not n_good:
        return None
    ratio = log_ratios(times[1, :-1], times[0, :-1], n_good, n_bad)
    hashed = known.withColumn("h", F.xxhash64("doc_id"))
    chosen = None
    for y in (True, False):
        part = hashed.where(F.col("good") == y).orderBy("h", "doc_id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.first("good").alias("good"), F.first("h").alias("h"), F.min("text").alias("text"))
    rows = staged(rows.select("good", "h", "text").mapInArrow(releasing(_sets), "good boolean, h long, buckets array<int>"), "sample")
    order = Window.partitionBy("good").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)  # over a sample
    size = rows.select("good", "h", F.sum(F.size("buckets")).over(order).alias("all")).where(F.col("all") <= most_buckets)
    sample = rows.join(F.broadcast(size), ["good", "h"]).select("good", "h", "buckets").toArrow().sort_by([("good", "ascending"), ("h", "ascending")])
    good = np.array(sample.column("good").to_pylist(), bool)
    release()
    if good.all() or not good.any():
        return None
    sets = [np.asarray(b, np.int32) for b in sample.column("buckets").to_numpy()]
    return train(sets, good, ratio, n_good / (n_good + n_bad))


def score_texts(model: Model, texts: list[str | None]) -> list[float]:
    return [model.score(b) for b in bucket_sets(*join_texts([(t or "").encode("utf-8", "ignore") for t in texts]))]


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, held_out: int = 0, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Null and empty texts have no n-grams and get the score of the bias alone; repeated rows come
    back each; a null doc_id is in the fold of the empty text and is never learned from; very long
    texts are scored whole; other columns are ignored. With nothing to learn from, or one label
    only, every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, held_out, folds))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [0.5] * len(batch) if model is None else [model.score(b) for b in bucket_sets(*column_bytes(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    every = docs.select(F.col("doc_id").cast("long"), "text", (crc_fold(F.col("doc_id"), folds) == held_out).alias("held_out"))
    out = every.mapInArrow(releasing(scan), "doc_id long, held_out boolean, score double")
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
