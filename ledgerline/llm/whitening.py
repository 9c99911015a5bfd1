"""Whitening of embeddings by MLlib's singular value decomposition of centred rows.

Vectors become integers, so that counts, sums and deviations from the mean are exact whatever their
offset. The centred rows are decomposed by ``computeSVD``: its right vectors are the eigenvectors of
the covariance and its singular values, squared and divided by n, the eigenvalues. The total
variance doesn't come from them but from the exact deviations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

SCALE, SHIFT = 1024, 100_000
#: Singular values below this share of the largest one are rounding noise of the Gramian.
NOISE = 3e-7
#: Scaled entries from here on don't fit the arithmetic of longs.
LARGE = 2.0**61


def scaled(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x array<long>): floor(1024 * c) + 100000 of every entry. Left out are vectors that are
    null, empty, or hold a null or non-finite entry or one of 2**51 or more in size, and those of
    another than the commonest length (of equally common ones the longer)."""
    v = F.col("v")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall(v, lambda c: c.isNotNull() & (F.abs(c * float(SCALE)) < LARGE)))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.where(F.size("v") == (common["n"] if common else -1))
    return rows.select("vec_id", F.transform(v, lambda c: F.floor(c * float(SCALE)).cast("long") + F.lit(SHIFT).cast("long")).alias("x"))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _fits(n: int, largest: int, dims: int) -> bool:
    """Whether sums of ``dims`` squares of n * x - S stay inside 64 bits."""
    return dims * (2 * n * (largest + 1)) ** 2 < 1 << 63


def deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int]]:
    """n * x - S as doubles, each rounded once, and the exact sum of its squares for each row."""
    largest = int(np.abs(x).max(initial=0))
    if _fits(n, max(largest, -(-max(map(abs, sums), default=0) // max(1, n))), x.shape[1]):
        d = n * x - np.array(sums, np.int64)
        return d.astype(np.float64), (d * d).sum(axis=1).tolist()
    d = n * x.astype(object) - np.array(sums, object)
    return d.astype(np.float64), (d * d).sum(axis=1).tolist()


@dataclass(frozen=True)
class Moments:
    """Count, mean and centred products of rows; two of them add up without loss of digits."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    def plus(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n))

    @staticmethod
    def of(w: np.ndarray) -> Moments:
        mean = w.mean(axis=0)
        return Moments(len(w), mean, (w - mean).T @ (w - mean))


def _added(parts: DataFrame, size: int) -> Moments:
    """All of (n, mean, products), first in a few tasks, then on the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Moments(0, np.zeros(size), np.zeros((size, size)))
        for batch in batches:
            for n, mean, products in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = total.plus(Moments(n, np.array(mean), np.array(products).reshape(size, size)))
        yield _row(total)

    total = Moments(0, np.zeros(size), np.zeros((size, size)))
    for r in parts.repartition(16).mapInArrow(add, MOMENTS).collect():
        total = total.plus(Moments(r.n, np.array(r.mean), np.array(r.products).reshape(size, size)))
    return total


MOMENTS = "n long, mean array<double>, products array<double>"


def _row(m: Moments) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([m.n]), pa.array([m.mean.tolist()]), pa.array([m.products.ravel().tolist()])], ["n", "mean", "products"])


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """(n, S): the number of rows and the exact sum of each dimension. Each task sums what it reads,
    in two words; the words of all tasks are summed as decimals."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for batch in batches:
            x = _matrix(batch.column(0))
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([high.tolist()]), pa.array([low.tolist()])], ["n", "high", "low"])

    told = rows.select("x").mapInArrow(words, "n long, high array<long>, low array<long>")
    wide = told.select("n", F.posexplode(F.arrays_zip("high", "low")))
    found = wide.groupBy("pos").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("col.high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("col.low").cast("decimal(38,0)")).alias("low")).orderBy("pos").collect()
    return (int(found[0]["n"]) if found else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in found]


@dataclass(frozen=True)
class Whitener:
    n: int
    sums: list[int]
    vectors: np.ndarray  # a column for each component
    values: np.ndarray  # eigenvalues, falling
    total: float  # trace of the covariance

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Whitened components and exact deviations of rows of integers."""
        d, exact = deviations(x, self.n, self.sums)
        return (d / self.n) @ self.vectors / np.sqrt(self.values), exact


def fit(rows: DataFrame, most: int = 8) -> Whitener | None:
    """Decomposes all of ``rows`` (x array<long>). At most ``most`` components are kept, none with an
    eigenvalue that can't be told from rounding. None if no row differs from another."""
    n, total = sums(rows)
    if not n:
        return None

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_of = 0
        for batch in batches:
            all_of += sum(deviations(_matrix(batch.column(0)), n, total)[1])
        yield pa.RecordBatch.from_arrays([pa.array([str(all_of)])], ["squares"])

    # One short string for each task, as the sum may be longer than any number type.
    squares = sum(int(r.squares) for r in rows.select("x").mapInArrow(exact, "squares string").collect())
    if not squares:
        return None
    dims = len(total)

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = deviations(_matrix(batch.column(0)), n, total)[0] / n
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(len(r) + 1, dtype=np.int32) * dims), pa.array(r.ravel()))], ["r"])

    centred = rows.select("x").mapInArrow(centre, "r array<double>").select(array_to_vector("r").alias("r"))
    # Asked for all components it decomposes the Gramian in full, not by iteration to a tolerance.
    found = RowMatrix(MLUtils.convertVectorColumnsFromML(centred, "r"), n, dims).computeSVD(dims, False, NOISE)
    values = np.array(found.s.toArray())[:most] ** 2 / n
    vectors = np.array(found.V.toArray())[:, : len(values)]
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))] < 0, -1.0, 1.0)
    return Whitener(n, total, vectors, values, float(Fraction(squares, n**3)))


def whitening_report(embeddings: DataFrame, most: int = 8) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact) for each
    valid row of ``embeddings`` (vec_id, embedding) and component.

    Rows that repeat, or have no id, come back each and count each. There are fewer than ``most``
    components if the vectors span fewer dimensions, and no rows if all vectors are equal or none is
    valid. A component's largest entry is positive. Of components with equal eigenvalues any basis may
    come. ``deviation_exact`` is the deviation as text; where it is beyond a long, ``deviation`` is
    null. Other columns are ignored.
    """
    rows = staged(scaled(embeddings), "scaled")
    model = fit(rows, most)
    spark = embeddings.sparkSession
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact string")
    shared = spark.sparkContext.broadcast(model)
    size = len(model.values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Moments(0, np.zeros(size), np.zeros((size, size)))
        for batch in batches:
            if len(batch):
                total = total.plus(Moments.of(shared.value.apply(_matrix(batch.column(0)))[0]))
        yield _row(total)

    seen = _added(rows.select("x").mapInArrow(moments, MOMENTS), size)
    error = float(np.abs(seen.products / seen.n - np.eye(size)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            w, exact = m.apply(_matrix(batch.column(1)))
            at = pa.array(np.repeat(np.arange(len(w)), size))
            longs = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
            component = pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(w)))
            explained = pa.array(np.tile(m.values / m.total, len(w)))
            whole = len(w) * size
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), component, pa.array(np.full(whole, m.n)), longs.take(at), pa.array(w.ravel()), explained, pa.array(np.full(whole, error)), pa.array(map(str, exact), pa.string()).take(at)],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
            )

    return rows.select("vec_id", "x").mapInArrow(project, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact string")
