"""From a landed file to raw: digests, archive, strict validation, control file, manifest, ingest.

A plain file is digested by one task that reads it line by line, as its digests can't be put
together from parts, and validated by as many tasks as Spark reads it in. An archive is unpacked by one task,
member by member and piece by piece, to text files that are then validated like plain ones. The
driver sees one small row for each part and range. Every step can be done again: parts are written
before the manifest that names them, the manifest is created once, and raw is the ledger of what was
ingested, so a restart at any point goes on where it stopped.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterator
from datetime import date, datetime
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import Feed, delivery_id, renamed
from ..operators.refs import SnapshotStore
from ..operators.registry import Registry
from . import strict
from .delivery import Rejected, decoded_pieces, opened, read_control, text_lines
from .objects import Objects
from .raw_ingest import Delivery, IngestRefused, IngestResult, ingest, name_of, next_name, settle, unchanged_resend

#: Stages of a receipt, in order.
STAGES = {"DISCOVERED": 0, "LANDED": 1, "NORMALIZED": 2, "INGESTED": 3}
#: ``container_md5`` is that of the file as it was sent, ``logical_md5`` that of its parts so far.
EXAMINED = "part long, member string, bytes long, md5 string, sha256 string, logical_md5 string, container_md5 string, problem string"


def is_archive(path: str) -> bool:
    return PurePosixPath(path).name.lower().endswith(".zip")


def _examined_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in EXAMINED.split(", ")]
    kinds = [pa.int64() if c.endswith("long") else pa.string() for c in EXAMINED.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def examined(spark: SparkSession, feed: Feed, path: str) -> DataFrame:
    """One row for each part of a file: its digests, or what is wrong with it. An archive's bytes must
    fit in one task's memory (and in 2 GB), its members needn't; a plain file may have any size."""
    return _archive(spark, feed, path) if is_archive(path) else _plain(spark, path)


def _archive(spark: SparkSession, feed: Feed, path: str) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for where, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = content.as_buffer()
                whole, container, n, name = hashlib.md5(), hashlib.md5(body).hexdigest(), 0, PurePosixPath(where).name
                try:
                    for n, (name, pieces) in enumerate(opened(body, feed.member_pattern)):
                        md5, sha, size = hashlib.md5(), hashlib.sha256(), 0

                        def seen(pieces=pieces, digests=(md5, sha, whole)):
                            nonlocal size
                            for piece in pieces:
                                for d in digests:
                                    d.update(piece)
                                size += len(piece)
                                yield piece

                        for _ in decoded_pieces(seen(), feed.encoding):
                            pass
                        out.append((n, name, size, md5.hexdigest(), sha.hexdigest(), whole.hexdigest(), container, None))
                except Rejected as e:
                    out.append((n, name, len(body), None, None, None, container, str(e)))
            yield _examined_batch(out)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(scan, EXAMINED)


def _plain(spark: SparkSession, path: str) -> DataFrame:
    mark, name = strict.marked(spark, path), PurePosixPath(path).name

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        md5, sha, size, last, whole = hashlib.md5(), hashlib.sha256(), 0, -1, None

        def add(body: bytes) -> None:
            nonlocal size
            md5.update(body)
            sha.update(body)
            size += len(body)

        for batch in batches:
            begin = batch.column(0).to_numpy()
            if len(begin) and (begin[0] < last or (begin[1:] < begin[:-1]).any()):
                raise RuntimeError("ranges out of order")
            for at in range(0, len(batch), 10_000):
                if whole is None:
                    whole = batch.column(1)[0].as_py()
                    add(codecs.BOM_UTF8 if mark else b"")
                else:
                    add(b"\n")
                add(b"\n".join(batch.column(2).slice(at, 10_000).to_pylist()))
            last = begin[-1] if len(begin) else last
        if whole is not None and size < whole:
            add(b"\n")
        if whole is None:
            whole = 0
        problem = None if size == whole else f"{size} bytes were read of {whole}"
        yield _examined_batch([(0, name, size, md5.hexdigest(), sha.hexdigest(), md5.hexdigest(), md5.hexdigest(), problem)])

    lines = spark.read.option("lineSep", "\n").text(path)
    cut = lines.select(F.col("_metadata.file_block_start").alias("begin"), F.col("_metadata.file_size").alias("whole"), F.col("value").cast("binary").alias("line"))
    return cut.coalesce(1).mapInArrow(scan, EXAMINED)


def unpacked(spark: SparkSession, feed: Feed, path: str) -> DataFrame:
    """(part, n, value): the lines of all members of an archive, decoded and in order."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for part, (_, pieces) in enumerate(opened(content.as_buffer(), feed.member_pattern)):
                    n = 0
                    for lines in text_lines(decoded_pieces(pieces, feed.encoding)):
                        yield pa.RecordBatch.from_arrays([pa.array([part] * len(lines), pa.int32()), pa.array(range(n, n + len(lines)), pa.int64()), pa.array(lines, pa.string())], ["part", "n", "value"])
                        n += len(lines)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(scan, "part int, n long, value string")


def receive(store: SnapshotStore, registry: Registry, objects: Objects, feed: Feed, path: str, received_at: datetime, batch_id: str, control: dict | None = None) -> IngestResult:
    """Takes one landed file through the front door. ``control`` holds the arguments of
    ``read_control``; its fields cob_date, n_rows, version and md5 (of the file as it was sent) are
    what the sender declares. What is refused leaves its reason in quarantine, its evidence and a
    failed receipt in the registry. Bytes that are known for their feed and date are an unchanged
    resend: nothing is unpacked, validated or ingested again, but a delivery that stopped half done
    is brought to its end."""
    spark, transport = store.spark, PurePosixPath(path).name
    registry.record("receipts", transport_id=transport, status="LANDED")
    try:
        result = _receive(spark, store, registry, objects, feed, path, received_at, batch_id, control)
    except (Rejected, IngestRefused) as e:
        registry.record("receipts", transport_id=transport, status="FAILED", detail=str(e))
        raise
    registry.record("receipts", transport_id=transport, status="INGESTED", detail=result.delivery_id)
    return result


def _refuse(registry: Registry, objects: Objects, path: str, size: int, reason: str) -> None:
    transport = PurePosixPath(path).name
    fact = {"object": path, "reason": reason, "bytes": size}
    objects.put(f"quarantine/{transport}.{hashlib.sha256(reason.encode()).hexdigest()[:8]}.reason.json", json.dumps(fact, sort_keys=True).encode())
    registry.record("evidence", check_name="strict_parse", outcome="fail", detail=reason, subject=transport)
    raise Rejected(reason)


def _receive(spark, store, registry, objects, feed, path, received_at, batch_id, control) -> IngestResult:
    transport = PurePosixPath(path).name
    parts = sorted(examined(spark, feed, path).collect())  # one row for each part
    size = sum(r["bytes"] for r in parts)
    if bad := [f"{r['member']}: {r['problem']}" for r in parts if r["problem"]] or ([] if parts else ["no such file"]):
        _refuse(registry, objects, path, size, "; ".join(bad))
    declared = read_control(**control) if control else {}
    cob: date = declared.get("cob_date") or feed.parse_name(transport)[0]
    digest = parts[-1]["logical_md5"]
    delivery = delivery_id(feed.source_system, feed.name, str(cob), digest)
    known = settle(store, registry, feed, delivery, cob, digest)
    if known is not None:
        return known
    landed = unchanged_resend(registry, feed, cob, digest)
    if landed is not None:
        return IngestResult(landed, 0, None, "unchanged resend")
    paths, read_as = (path,), feed
    if is_archive(path):
        folder = f"ready/{delivery}"
        paths, read_as = tuple(f"{objects.root}/{folder}/part={r['part']}" for r in parts), renamed(feed, encoding="UTF-8")
        if not objects.exists(f"manifests/{delivery}.json"):
            # one task unpacks, so sorting what is in order only keeps Spark from ordering by part alone
            unpacked(spark, feed, path).sortWithinPartitions("part", "n").drop("n").write.mode("overwrite").partitionBy("part").text(f"{objects.root}/{folder}")
            for r in parts:
                if not r["bytes"]:
                    objects.put(f"{folder}/part={r['part']}/empty.txt", b"")
    found = strict.validated(spark, read_as, list(paths))
    told = {(int(m[1]) if (m := re.search(r"/part=(\d+)/[^/]*$", p)) and is_archive(path) else 0): problem for p, (_, problem) in found.items()}
    if bad := [f"{r['member']}: {told[r['part']]}" for r in parts if told.get(r["part"])]:
        _refuse(registry, objects, path, size, "; ".join(bad))
    listed = [{"member": r["member"], "path": p, "bytes": r["bytes"], "md5": r["md5"], "sha256": r["sha256"]} for r, p in zip(parts, paths, strict=True)]
    objects.manifest(delivery, listed, {"separator": feed.separator, "quote": feed.quote, "header": feed.header, "encoding": read_as.encoding, "schema_version": feed.schema_version})
    registry.record("receipts", transport_id=transport, status="NORMALIZED", detail=delivery)
    version = declared.get("version")
    taken = {r["name"] for r in registry.frame("deliveries").where((F.col("feed") == feed.name) & (F.col("cob_date") == str(cob)) & F.col("name").isNotNull()).select("name").collect()}  # of one date
    name = name_of(feed, cob, version) if version is not None else next_name(feed, cob, taken)
    told = Delivery(delivery, cob, paths, received_at, declared.get("n_rows"), declared.get("md5"), parts[-1]["container_md5"])
    return ingest(store, read_as, told, batch_id, registry=registry, digest=digest, name=name)
