"""Raw ingest: a delivery becomes rows of ``raw.<feed>``, once, with provenance, after its checks."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..contracts import Feed
from ..functions.conform import extra_columns
from ..operators.quality import evidence_id
from ..operators.refs import Conflict, SnapshotStore
from ..operators.registry import Registry
from .delivery import read_parts


class IngestRefused(RuntimeError):
    """A failed integrity check; never retried. The branch stays for a look."""


@dataclass(frozen=True)
class Delivery:
    delivery_id: str
    cob_date: date
    paths: tuple[str, ...]
    received_at: datetime
    declared_rows: int | None = None
    declared_md5: str | None = None
    actual_md5: str | None = None


@dataclass
class IngestResult:
    delivery_id: str
    rows: int
    version: int | None
    status: str
    evidence: list[dict] = field(default_factory=list)


def reconcile_schema(df: DataFrame, feed: Feed) -> tuple[DataFrame, list[str], list[str]]:
    """Declared columns in order (missing ones NULL), undeclared ones in the ``_extra_columns`` map;
    and the names of both."""
    inner = [c for c in df.columns if c not in ("_source_file", "_part", "_order")]
    missing = [s for s in feed.columns.values() if s not in inner]
    extra = [c for c in inner if c not in feed.columns.values()]
    declared = [(F.lit(None) if s in missing else F.col(f"`{s}`")).cast("string").alias(p) for p, s in feed.columns.items()]
    return df.select(*declared, extra_columns(extra).alias("_extra_columns"), "_source_file", "_part", "_order"), missing, extra


def numbered(df: DataFrame) -> DataFrame:
    """``_row_number`` from 1 in file order over all parts, without one global window: offsets of
    the read partitions come from a small count, and numbers inside a partition from its order."""
    tagged = df.withColumn("_slot", F.shiftright("_order", 33))
    sizes = tagged.groupBy("_part", "_slot").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part", "_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.withColumn("_before", before).drop("_n"))  # one row for each read partition
    inside = F.row_number().over(Window.partitionBy("_part", "_slot").orderBy("_order"))
    return tagged.withColumn("_in", inside).join(offsets, ["_part", "_slot"]).withColumn("_row_number", (F.col("_before") + F.col("_in")).cast("long")).drop("_part", "_order", "_slot", "_in", "_before")


def checks(feed: Feed, delivery: Delivery, rows: int, missing: list[str], extra: list[str]) -> list[dict]:
    """Every integrity check with its outcome, passes included."""
    told = lambda name, good, detail="", severity="fail": {"check": name, "outcome": "pass" if good else severity, "detail": detail, "delivery_id": delivery.delivery_id}
    out = [told("schema_drift", not (missing or extra), f"missing {missing}, extra {extra}", feed.schema_drift)]
    if feed.expected_min_rows is not None:
        out.append(told("expected_min_rows", rows >= feed.expected_min_rows, str(rows)))
    if feed.expected_max_rows is not None:
        out.append(told("expected_max_rows", rows <= feed.expected_max_rows, str(rows)))
    if delivery.declared_rows is not None:
        out.append(told("declared_row_count", rows == delivery.declared_rows, str(rows)))
    if delivery.declared_md5 is not None:
        out.append(told("declared_md5", delivery.declared_md5 == delivery.actual_md5, str(delivery.actual_md5)))
    return out


def ingested(store: SnapshotStore, feed: Feed, delivery_id: str, ref: str = "main", cob: date | None = None) -> bool:
    """The ledger is the data: whether raw has a row of the delivery, in its date's partition if that
    is known. Only a missing table is empty; any other failure to read is raised."""
    if not store.has(f"raw.{feed.name}", ref):
        return False
    rows = store.read(f"raw.{feed.name}", ref) if cob is None else of_date(store, feed, cob, ref)
    return bool(rows.where(F.col("_delivery_id") == delivery_id).limit(1).count())


def committed(raw: DataFrame) -> DataFrame:
    """(delivery_id, cob_date, version, n_rows) of what a raw table holds."""
    return raw.groupBy(F.col("_delivery_id").alias("delivery_id")).agg(F.max("_cob_date").alias("cob_date"), F.max("_file_version").alias("version"), F.count("*").alias("n_rows"))


def checkpoint(rows: DataFrame, cob: date, delivery: str | None = None) -> DataFrame:
    """The rows of a business date, of one delivery if it is named."""
    out = rows.where(F.col("_cob_date") == F.lit(cob))
    return out if delivery is None else out.where(F.col("_delivery_id") == delivery)


def of_date(store: SnapshotStore, feed: Feed, cob: date, ref: str = "main") -> DataFrame | None:
    """Raw rows of one business date, from its partition alone; None without a table."""
    table = f"raw.{feed.name}"
    return store.read(table, ref, {f"_cob_date={cob}"}).where(F.col("_cob_date") == F.lit(cob)) if store.has(table, ref) else None


def next_version(store: SnapshotStore, feed: Feed, cob: date, ref: str) -> int:
    rows = of_date(store, feed, cob, ref)
    return 1 if rows is None else (rows.agg(F.max("_file_version")).first()[0] or 0) + 1


def finished(store: SnapshotStore, registry: Registry | None, intent: dict) -> None:
    """All that follows a merge, each step once: the tag, the delivery's fact, the end of the branch."""
    told = intent["told"]
    if store.files_.list(store._folder(intent["branch"])):
        store.tag(intent["tag"], intent["branch"])
    if registry is not None:
        registry.record_once("deliveries", told["delivery_id"], delivery_id=told["delivery_id"], feed=told["feed"], cob_date=told["cob_date"], version=int(told["version"]), rows=int(told["rows"]), md5=told["md5"] or None, name=told["name"] or None)
    store.delete(intent["branch"])
    if registry is not None:
        registry.settle(intent["intent"], "done")


def recover(store: SnapshotStore, registry: Registry, delivery_id: str | None = None) -> dict[str, str]:
    """Brings half-done ingests to an end (of one delivery, if it is named): intent -> done, or dropped
    if its merge wasn't done. To be run when no ingest of them is on its way."""
    out = {}
    for intent in registry.open_intents("ingest"):
        if delivery_id is not None and intent["told"]["delivery_id"] != delivery_id:
            continue
        branch = intent["branch"]
        if store.files_.list(store._folder(branch)) and not store.merged(branch):
            registry.settle(intent["intent"], "dropped")  # before the branch goes: one without a branch was merged
            store.delete(branch)
            out[intent["intent"]] = "dropped"
        else:
            finished(store, registry, intent)
            out[intent["intent"]] = "done"
    return out


def settle(store: SnapshotStore, registry: Registry, feed: Feed, delivery: str, cob: date, digest: str) -> IngestResult | None:
    """What is known of a delivery that comes in again: its end, if it is in raw, with all facts that a
    crash kept from being recorded; None if it has to be ingested."""
    recover(store, registry, delivery)
    rows = of_date(store, feed, cob)
    have = None if rows is None else committed(rows.where(F.col("_delivery_id") == delivery)).first()
    if have is None:
        return None
    registry.record_once("deliveries", delivery, delivery_id=delivery, feed=feed.name, cob_date=str(cob), version=have["version"], rows=have["n_rows"], md5=digest)
    return IngestResult(delivery, 0, None, "already ingested")


def unchanged_resend(registry: Registry, feed: Feed, cob: date, digest: str) -> str | None:
    """The delivery that brought these bytes for this feed and date, if there is one."""
    known = registry.frame("deliveries").where((F.col("feed") == feed.name) & (F.col("cob_date") == str(cob)) & (F.col("md5") == digest))
    found = known.select("delivery_id").first()
    return found[0] if found else None


def ingest(store: SnapshotStore, feed: Feed, delivery: Delivery, batch_id: str, attempts: int = 3, registry: Registry | None = None, digest: str | None = None, name: str | None = None) -> IngestResult:
    """Reads, reconciles, stamps, appends on a branch, checks and merges. A delivery that main has
    is a no-op. If main moved on meanwhile, it is tried again on a fresh branch. The files are read
    once: rows are counted where they were written. With a registry every check's outcome is
    recorded before it counts, and what follows the merge is written down before it. ``digest`` and
    ``name`` are the delivery's bytes' and its file name of the date."""
    spark = store.spark
    for attempt in range(attempts):
        if ingested(store, feed, delivery.delivery_id, cob=delivery.cob_date):
            return IngestResult(delivery.delivery_id, 0, None, "already ingested")
        branch = store.branch(f"ingest/{feed.name}/{delivery.delivery_id}/{batch_id}-{uuid.uuid4().hex[:8]}")
        version = next_version(store, feed, delivery.cob_date, branch)
        rows, missing, extra = reconcile_schema(read_parts(spark, feed, list(delivery.paths)), feed)
        stamped = numbered(rows).withColumns({
            "_cob_date": F.lit(delivery.cob_date), "_ingest_ts": F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp"), "_file_version": F.lit(version),
            "_batch_id": F.lit(batch_id), "_delivery_id": F.lit(delivery.delivery_id), "_received_at": F.lit(delivery.received_at).cast("timestamp"),
            "_schema_version": F.lit(feed.schema_version), "_source_system": F.lit(feed.source_system),
        })
        store.append(stamped, f"raw.{feed.name}", branch, ["_cob_date"])
        count = checkpoint(of_date(store, feed, delivery.cob_date, branch), delivery.cob_date, delivery.delivery_id).count()
        evidence = checks(feed, delivery, count, missing, extra)
        for e in evidence if registry is not None else ():
            registry.record("evidence", evidence_id=evidence_id(delivery.delivery_id, e["check"]), check_name=e["check"], outcome=e["outcome"], detail=e["detail"], subject=delivery.delivery_id)
        if bad := [e["check"] for e in evidence if e["outcome"] == "fail"]:
            raise IngestRefused(f"{bad} on {delivery.delivery_id}; see branch {branch}: {evidence}")
        told = {"delivery_id": delivery.delivery_id, "feed": feed.name, "cob_date": str(delivery.cob_date), "version": str(version), "rows": str(count), "md5": digest or "", "name": name or ""}
        intent = {"intent": f"ingest-{delivery.delivery_id}-{branch.rpartition('/')[2]}", "kind": "ingest", "branch": branch, "tag": f"snapshot/{feed.name}/{delivery.cob_date}/{batch_id}" + (f"-v{version}" if version > 1 else ""), "told": told}
        if registry is not None:
            registry.intend(intent["intent"], intent["kind"], branch, intent["tag"], **told)
        try:
            store.merge(branch)
        except Conflict:
            if registry is not None:
                registry.settle(intent["intent"], "dropped")
            store.delete(branch)
            continue
        finished(store, registry, intent)
        return IngestResult(delivery.delivery_id, count, version, "ingested", evidence)
    raise Conflict(f"{delivery.delivery_id}: main moved on {attempts} times")


def name_of(feed: Feed, cob: date, version: int = 1) -> str:
    """The file name of a date and version. Where the feed's pattern has no place for a version, it
    goes before the name's ending."""
    name, plain = feed.render_name(cob, version), feed.render_name(cob)
    if version == 1 or name != plain:
        return name
    stem, dot, ending = plain.rpartition(".")
    return f"{stem}_v{version}{dot}{ending}" if dot else f"{plain}_v{version}"


def next_name(feed: Feed, cob: date, taken: set[str], most: int = 99) -> str:
    """The first file name of a date that isn't taken: plain, then _v2, up to ``most``."""
    for n in range(1, most + 1):
        if (name := name_of(feed, cob, n)) not in taken:
            return name
    raise IngestRefused(f"{most} versions of {feed.name} for {cob} already")
