"""Shared plumbing: reading tables, shared intermediate tables, hashing of ids."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a batch that goes to a Python worker. Both sides hold some batches for each task, and
#: Spark's 64 MB are a tenth of a small executor.
BATCH = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def lean(spark: SparkSession) -> None:
    """Lets batches to Python workers have ``BATCH`` bytes at most, if the session allows more."""
    now = spark.conf.get(BATCH_SETTING, None)
    if now is not None and (not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH):
        spark.conf.set(BATCH_SETTING, str(BATCH))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    lean(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset, a temporary one on
    a single machine, and an error on a cluster, whose executors don't share such a folder."""
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not known:
        known = sc.getCheckpointDir()
    if not known:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        known = tempfile.mkdtemp(prefix="ledgerline-")
        sc.setCheckpointDir(known)
    return known.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and returns a scan of it: lineage ends there,
    and lost executors lose nothing."""
    spark = df.sparkSession
    lean(spark)
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Gives freed memory back to the system. Workers are kept for later steps, and an allocator
    that keeps what one step needed for a moment would take it from all of them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def settle_heaps(spark: SparkSession) -> None:
    """Has the executors and the driver collect their garbage, after which their JVMs give freed heap
    back. A heap that grew for one step's sorting would otherwise stay beside the next step's Python
    workers, and what a model was fitted with would stay beside the plans of all later steps."""
    release()
    spark.sparkContext._jvm.System.gc()
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')")).write.format("noop").mode("overwrite").save()


#: glibc's settings and their numbers: from which size on a block is a mapping of its own, which goes
#: back when it is freed, and how much may lie unused at the heap's end. Left alone, the first grows
#: to 32 MB with the blocks that are freed, and each worker keeps what it once used.
MALLOC = {-3: 3 << 20, -1: 16 << 20}


def plain_allocator() -> None:
    tune = getattr(ctypes.CDLL(None), "mallopt", None)
    for setting, value in MALLOC.items() if tune is not None else ():
        tune(setting, value)


def releasing(scan: Callable) -> Callable:
    """``scan``, a function over a task's batches, which gives memory back as it goes and when they
    are through."""

    def run(batches):
        plain_allocator()
        yield from scan(batches)
        release()

    return run


def crc_fold(doc_id, folds: int):
    """crc32 of doc_id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def crc_fold_py(doc_id, folds: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def vocabulary(name: str) -> str:
    """The path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def broadcast_if_small(rows: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A written table of ids, marked for broadcast if it has at most ``most`` rows (about 8 MB of
    longs); a larger one is left to a shuffled join."""
    return F.broadcast(rows) if rows.count() <= most else rows
