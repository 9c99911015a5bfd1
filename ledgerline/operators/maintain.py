"""Retention and maintenance: what to keep, what to drop, when to compact."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .calendar import keep_set
from .refs import SnapshotStore, path_of


class RetentionRefused(RuntimeError):
    """A rule that would delete everything, or break what is promised."""


@dataclass(frozen=True)
class Thresholds:
    max_files_per_partition: int = 20
    min_average_mb: float = 32.0
    min_files: int = 10
    recent_days: int = 7


def file_metrics(files: DataFrame) -> DataFrame:
    """One row: counts and sizes per partition, then over partitions."""
    each = files.groupBy("partition").agg(F.count("*").alias("files"), F.avg("size").alias("average"), F.sum("size").alias("bytes"))
    return each.agg(F.sum("files").alias("total_files"), F.max("files").alias("max_files_per_partition"), (F.sum("bytes") / F.sum("files") / 1048576).alias("avg_file_size_mb"), F.count("*").alias("partitions"))


def decide(metrics: dict, limits: Thresholds = Thresholds()) -> tuple[bool, str]:
    """Whether to compact, and why."""
    if not metrics.get("total_files"):
        return False, "empty"
    if metrics["max_files_per_partition"] > limits.max_files_per_partition:
        return True, "many files in a partition"
    if metrics["total_files"] >= limits.min_files and metrics["avg_file_size_mb"] < limits.min_average_mb:
        return True, "small files"
    return False, "healthy"


def packed_bins(parts: DataFrame, target: int, min_inputs: int = 5, small: float = 0.75) -> DataFrame:
    """(folder, part, bin): parts (folder, part, files, bytes) to be rewritten together. Of each
    partition, parts whose files are below ``small`` of the target on average are laid end to end,
    smallest first, and cut at multiples of the target; a bin with fewer than ``min_inputs`` files
    stays as it is. Bins are numbered from 0 over all partitions."""
    fit = parts.where((F.col("files") > 0) & (F.col("bytes") < F.lit(small * target) * F.col("files")))
    order = Window.partitionBy("folder").orderBy("bytes", "part").rowsBetween(Window.unboundedPreceding, -1)
    laid = fit.withColumn("_own", F.floor(F.coalesce(F.sum("bytes").over(order), F.lit(0)) / target))
    enough = laid.groupBy("folder", "_own").agg(F.sum("files").alias("_files")).where(F.col("_files") >= min_inputs)
    numbered = enough.withColumn("bin", F.row_number().over(Window.orderBy("folder", "_own")) - 1)  # one row for each bin
    return laid.join(numbered.drop("_files"), ["folder", "_own"]).select("folder", "part", "bin")


def compact_recent(store: SnapshotStore, table: str, branch: str, newest: date, limits: Thresholds = Thresholds(), sort: list[str] | None = None, target_mb: float = 256, min_inputs: int = 5, fold_deletes: int = 8) -> dict:
    """Rewrites small files of a table's recent partitions if the metrics of these ask for it, packed
    to the target size, each bin by one task. Sizes come from the store's lists; parts that aren't
    chosen keep their files. Parts that lost rows ``fold_deletes`` times or more are rewritten too.
    Returns {decision, bins, parts}."""
    column = store.ref(branch)["tables"][table]["column"]
    since = f"{column}={newest - timedelta(days=limits.recent_days - 1)}"
    entries = [e for e in store.entries(table, branch) if column is None or since <= e["folder"] < f"{column}=:"]
    held = [(e["folder"], e["part"], e["files"], e["bytes"]) for e in entries]
    if not held:
        return {"decision": "empty", "bins": 0, "parts": 0}
    parts = store.spark.createDataFrame(held, "folder string, part string, files long, bytes long")
    each = parts.groupBy(F.col("folder").alias("partition")).agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
    metrics = each.agg(F.sum("files").alias("total_files"), F.max("files").alias("max_files_per_partition"), (F.sum("bytes") / F.sum("files") / 1048576).alias("avg_file_size_mb")).first().asDict()
    go, why = decide(metrics, limits)
    chosen = packed_bins(parts, int(target_mb * 1048576), min_inputs).collect() if go else []  # one row for each part
    bins = {path_of({"folder": r["folder"], "part": r["part"]}): r["bin"] for r in chosen}
    # parts that lost rows are written without them, each by itself if it is in no bin
    for e in entries:
        if len(e.get("deletes", [])) >= fold_deletes and path_of(e) not in bins:
            bins[path_of(e)] = max(bins.values(), default=-1) + 1
    if bins:
        store.rewrite_parts(table, branch, bins, sort or [])
    return {"decision": why, "bins": len(set(bins.values())), "parts": len(bins)}


def scd2_cutoff(kept: DataFrame, column: str = "effective_from") -> date:
    first = kept.agg(F.min(column)).first()[0]
    if first is None:
        raise RetentionRefused("the set of dates to keep is empty")
    return first


def retention_counts(versions: DataFrame, cutoff: date) -> DataFrame:
    """(current_versions, expiring, total) of a dimension."""
    return versions.agg(F.count_if("is_current").alias("current_versions"), F.count_if(~F.col("is_current") & (F.col("effective_to") < F.lit(cutoff))).alias("expiring"), F.count("*").alias("total"))


def is_scd2(df: DataFrame) -> bool:
    return {"effective_from", "effective_to", "is_current"} <= set(df.columns)


def apply_retention(store: SnapshotStore, table: str, branch: str, business_days: int = 10, month_ends: int = 80) -> None:
    """Dimensions lose closed versions that ended before the first kept date; other tables lose
    whole dates, by leaving their folders out if they have one for each date. Nothing to keep is
    refused for both."""
    df = store.read(table, branch)
    column = "effective_from" if is_scd2(df) else "cob_date" if "cob_date" in df.columns else "_cob_date"
    kept = keep_set(df.select(column).distinct(), business_days, month_ends, column=column)
    cutoff = scd2_cutoff(kept, column)
    if is_scd2(df):
        store.delete_where(table, branch, ~F.col("is_current") & (F.col("effective_to") < F.lit(cutoff)))
    elif store.ref(branch)["tables"][table]["column"] == column:
        store.keep_partitions(table, branch, kept)
    else:
        store.write(df.join(kept, column, "left_semi"), table, branch, [column])


#: A year of a retention window, in days (fixed value).
DAYS_PER_YEAR = 365.25
PUBLISHED = r"^published/(?:([^/]+)/)?(\d{4}-\d{2}-\d{2})/(.+)$"


def judged_tags(tags: DataFrame, windows: DataFrame, today, pattern: str = PUBLISHED) -> DataFrame:
    """(tag, report, as_at, judged_on, judged_by, keep_years, verdict) for tags (ref, taken_at in
    seconds or NULL): each by its own report's window (report, keep_years), from the day it was
    taken, or where that isn't known from the date it is about, which can't be later. The verdict is
    keep or expire; foreign for a name of another shape, which is never touched; unresolved if its
    report has no window. A window of a NULL report holds for names without one."""
    part = lambda n: F.nullif(F.regexp_extract("ref", pattern, n), F.lit(""))
    told = tags.select(F.col("ref").alias("tag"), part(1).alias("report"), F.try_to_date(part(2), "yyyy-MM-dd").alias("as_at"), F.to_date(F.timestamp_seconds("taken_at")).alias("_taken"))
    years = windows.select(F.col("report").alias("_report"), F.col("keep_years").cast("double").alias("keep_years"))
    told = told.join(years, told["report"].eqNullSafe(years["_report"]) & told["as_at"].isNotNull(), "left").drop("_report")
    judged = told.withColumn("judged_by", F.coalesce("_taken", "as_at")).withColumn("judged_on", F.when(F.col("as_at").isNull(), None).when(F.col("_taken").isNull(), "date").otherwise("taken"))
    # the cutoff is a whole day: the present less the window, cut off
    cutoff = F.to_date(F.lit(today).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("keep_years") * F.lit(DAYS_PER_YEAR * 86400).cast("decimal(18,6)")))
    verdict = F.when(F.col("as_at").isNull(), "foreign").when(F.col("keep_years").isNull() | (F.col("keep_years") <= 0), "unresolved").when(F.col("judged_by") < cutoff, "expire").otherwise("keep")
    return judged.select("tag", "report", "as_at", "judged_on", "judged_by", "keep_years", verdict.alias("verdict"))


def sweep_tags(store: SnapshotStore, windows: dict[str | None, float], now: datetime, prefix: str = "published/", pattern: str = PUBLISHED) -> list[str]:
    """Deletes the expired tags of a prefix. One whose window can't be resolved refuses the whole sweep."""
    tags = [(n, float(r["time"]) if r.get("time") is not None else None) for n, r in store.refs().items() if r["kind"] == "tag" and n.startswith(prefix)]
    spark = store.spark
    judged = judged_tags(spark.createDataFrame(tags, "ref string, taken_at double"), spark.createDataFrame(list(windows.items()), "report string, keep_years double"), now, pattern)
    found = [(r["tag"], r["verdict"]) for r in judged.where("verdict in ('expire', 'unresolved')").orderBy("tag").collect()]
    if odd := [t for t, v in found if v == "unresolved"]:
        raise RetentionRefused(f"no window for {odd}")
    for tag, _ in found:
        store.delete(tag)
    return [t for t, _ in found]


def orphan_tables(store: SnapshotStore, known: set[str]) -> DataFrame:
    """(table_name, standing, parts, bytes): tables that no model or feed in ``known`` stands for, on
    main or held by a tag only, and folders that no ref names at all (unnamed, parts as they lie)."""
    held = store.holdings()
    main = held.where("ref = 'main'").select("table_name").distinct().withColumn("_main", F.lit(True))
    each = held.select("table_name", "folder", "part", "bytes").distinct().groupBy("table_name").agg(F.count("*").alias("parts"), F.sum("bytes").alias("bytes"))
    named = each.join(main, "table_name", "left").select("table_name", F.when(F.col("_main"), "main").otherwise("pinned").alias("standing"), "parts", "bytes").where(~F.col("table_name").isin(*known) if known else F.lit(True))
    lying = [row for t in store.files_.list("data") for row in held_parts(store, t)]
    folders = store.spark.createDataFrame(lying, "table_name string, folder string, part string").join(each.select("table_name"), "table_name", "left_anti")
    return named.unionByName(folders.groupBy("table_name").agg(F.count("*").alias("parts")).select("table_name", F.lit("unnamed").alias("standing"), "parts", F.lit(None).cast("long").alias("bytes")))


def window_refusal(retention_days: dict[str, int], promised_days: dict[str, int], feeds_behind: dict[str, set[str]]) -> list[tuple[str, str]]:
    """(report, feed) whose feed is kept for less time than the report promises to reproduce."""
    return sorted((r, f) for r, days in promised_days.items() for f in feeds_behind.get(r, ()) if retention_days.get(f, 0) < days)


def lost_inputs(pins: DataFrame, landed: DataFrame) -> DataFrame:
    """(tag, delivery_id) whose delivery is no longer landed."""
    return pins.select("tag", "delivery_id").distinct().join(landed.select("delivery_id"), "delivery_id", "left_anti").select("tag", "delivery_id")


def held_parts(store: SnapshotStore, table: str) -> list[tuple[str, str, str]]:
    """(table_name, folder, part) of a table's folders as they lie in the store, by one listing of each."""
    out = []
    for n in store.files_.list(f"data/{table}"):
        out += [(table, n, p) for p in store.files_.list(f"data/{table}/{n}")] if "=" in n else [(table, "", n)]
    return out


def divergence(held: DataFrame, target: str = "main") -> DataFrame:
    """(ref, kind, taken_at, table_name, folder, part, files, bytes) of what pins hold and ``target``
    doesn't: what only they keep alive."""
    ours = held.where(F.col("ref") == target).select("table_name", "folder", "part")
    return held.where((F.col("ref") != target) & (F.col("kind") == "tag")).join(ours, ["table_name", "folder", "part"], "left_anti")


def oldest_pins(diverged: DataFrame) -> DataFrame:
    """(table_name, oldest_pin, taken_at, parts, bytes): for each table the oldest diverging pin, and what
    all diverging pins together keep alive, shared parts once."""
    pins = diverged.groupBy("table_name").agg(F.min_by("ref", F.struct("taken_at", "ref")).alias("oldest_pin"), F.min("taken_at").alias("taken_at"))
    parts = diverged.select("table_name", "folder", "part", "bytes").distinct().groupBy("table_name").agg(F.count("*").alias("parts"), F.sum("bytes").alias("bytes"))
    return pins.join(parts, "table_name")


def reproducible(store: SnapshotStore, tags: list[str] | None = None) -> DataFrame:
    """(tag, table_name, parts, diverged, diverged_bytes, lost, readable) for each pin and table: what
    main no longer has, what is gone from the store, and so whether the pin can be read. All pins are
    one relation, so states that share lists share their reading, and no pin is a job of its own."""
    held = store.holdings([*(tags if tags is not None else [n for n, r in store.refs().items() if r["kind"] == "tag"]), "main"])
    there = [row for t in store.files_.list("data") for row in held_parts(store, t)]
    there = store.spark.createDataFrame(there, "table_name string, folder string, part string").withColumn("_there", F.lit(True))
    key = ["table_name", "folder", "part"]
    ours = held.where("ref = 'main'").select(*key).withColumn("_ours", F.lit(True))
    pins = held.where("ref <> 'main'").join(there, key, "left").join(ours, key, "left")
    away = F.col("_ours").isNull()
    out = pins.groupBy(F.col("ref").alias("tag"), "table_name").agg(F.count("*").alias("parts"), F.count_if(away).alias("diverged"), F.coalesce(F.sum(F.when(away, F.col("bytes"))), F.lit(0)).alias("diverged_bytes"), F.count_if(F.col("_there").isNull()).alias("lost"))
    return out.withColumn("readable", F.col("lost") == 0)


def backlog(deferred: DataFrame, done: DataFrame, today: str) -> DataFrame:
    """(kind, waiting, oldest, age_days): deferred work (kind, item, deferred_on) that isn't done."""
    left = deferred.join(done.select("kind", "item").distinct(), ["kind", "item"], "left_anti")
    out = left.groupBy("kind").agg(F.count("*").alias("waiting"), F.min("deferred_on").alias("oldest"))
    return out.withColumn("age_days", F.datediff(F.lit(today).cast("date"), "oldest"))


def expired_objects(listing: DataFrame, now: float, keep_days: dict[str, float], protected: DataFrame | None = None) -> DataFrame:
    """The objects of a listing (path, size, changed_at in seconds) that a sweep may delete: those
    of a folder in ``keep_days`` beyond its age, unless they are protected (path)."""
    age = F.lit(now) - F.col("changed_at")
    gone = F.lit(False)
    for folder, days in sorted(keep_days.items()):
        gone = gone | (F.startswith("path", F.lit(folder.rstrip("/") + "/")) & (age > F.lit(days * 86400.0)))
    out = listing.where(gone)
    return out if protected is None else out.join(protected.select("path").distinct(), "path", "left_anti")


def sweep_objects(files, folders: dict[str, float], protected: DataFrame | None = None, now: float | None = None) -> int:
    """Deletes the expired objects below landing, ready and quarantine folders of a ``Files`` root."""
    found = [row for f in folders for row in files.walk(f)]
    if not found:
        return 0
    listing = files.spark.createDataFrame(found, "path string, size long, changed_at double")
    gone = 0
    for r in expired_objects(listing, time.time() if now is None else now, folders, protected).toLocalIterator():
        gone += files.delete(r["path"])
    return gone


def orphans(listing: DataFrame, known: DataFrame, key: str = "path") -> DataFrame:
    return listing.join(known.select(key).distinct(), key, "left_anti")


def trend(history: DataFrame, days: int) -> DataFrame:
    """(table_name, first_bytes, last_bytes, growth) over the newest ``days`` measured."""
    newest = history.agg(F.max("measured_on").alias("_max"))
    recent = history.crossJoin(F.broadcast(newest)).where(F.col("measured_on") > F.date_sub("_max", days))
    return recent.groupBy("table_name").agg(F.min_by("bytes", "measured_on").alias("first_bytes"), F.max_by("bytes", "measured_on").alias("last_bytes")).withColumn("growth", F.col("last_bytes") - F.col("first_bytes"))
