"""Slowly changing dimensions: versions with inclusive ranges, built in full or by replay."""

from __future__ import annotations

from datetime import date

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conform import OPEN_END, all_of, conformed, effective_month, retracted, row_hash
from .snapshot import dedupe_latest, known_as_of, last_in_file, newest_rows, window_start

RANGE = ["effective_from", "effective_to", "is_current", "effective_from_month"]


class PrunedHistory(RuntimeError):
    """A rebuild would lose versions whose dates raw no longer holds."""


def changes(rows: DataFrame, keys: list[str], hashed: list[str], by: str = "cob_date") -> DataFrame:
    """Rows that differ from the key's row before; a reversion is a change."""
    order = Window.partitionBy(*keys).orderBy(by)
    out = rows.withColumn("_hash", row_hash(*hashed)).withColumn("_before", F.lag("_hash").over(order))
    return out.where(F.col("_before").isNull() | (F.col("_before") != F.col("_hash"))).drop("_before")


def ranges(rows: DataFrame, keys: list[str], by: str = "cob_date") -> DataFrame:
    """effective_from, effective_to (the day before the next version, or the open end),
    is_current and effective_from_month."""
    nxt = F.lead(by).over(Window.partitionBy(*keys).orderBy(by))
    return rows.withColumns({"effective_from": F.col(by), "effective_to": F.coalesce(F.date_sub(nxt, 1), F.lit(OPEN_END)), "is_current": nxt.isNull(), "effective_from_month": effective_month(by)})


def versions(daily: DataFrame, keys: list[str], hashed: list[str], by: str = "cob_date") -> DataFrame:
    return ranges(changes(daily, keys, hashed, by), keys, by).drop("_hash")


def daily_rows(raw: DataFrame, columns: dict[str, str], keys: list[str], derived: dict[str, Column] | None = None) -> DataFrame:
    """One cleaned row for each key and date, of the date's newest delivery."""
    cleaned = raw.select(*[conformed(c, kind).alias(c) for c, kind in columns.items()], F.col("_batch_id").alias("source_batch_id"), "_cob_date", "_file_version", "_row_number")
    kept = dedupe_latest(cleaned.withColumns(derived or {}), keys)
    return kept.withColumn("cob_date", F.col("_cob_date")).drop("_cob_date", "_file_version", "_row_number")


def build_full(raw: DataFrame, columns: dict[str, str], keys: list[str], hashed: list[str], derived: dict[str, Column] | None = None, knowledge: str | None = None) -> DataFrame:
    out = versions(daily_rows(known_as_of(raw, knowledge), columns, keys, derived), keys, hashed)
    return out.select(*columns, *(derived or {}), "source_batch_id", *RANGE)


def refuse_pruned(target: DataFrame, raw: DataFrame, override: bool = False) -> None:
    """Raises if the target has versions from dates that raw has no delivery for."""
    lost = target.select(F.col("effective_from").alias("_cob_date")).distinct().join(raw.select("_cob_date").distinct(), "_cob_date", "left_anti")
    if not override and (first := lost.orderBy("_cob_date").first()):
        raise PrunedHistory(f"raw no longer holds {first[0]} and maybe more; set the override to lose these versions")


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return all_of([a[k].eqNullSafe(b[k]) for k in keys])


def _scope(raw: DataFrame, target: DataFrame, columns: dict[str, str], keys: list[str], lookback_days: int) -> tuple[DataFrame, date]:
    """(keys..., _from) of the touched keys, those with a raw row in the window, and the window's
    start. A key replays from its last version before the window, one without from the beginning
    (NULL)."""
    start: date = window_start(target, "effective_from", lookback_days)
    touched = raw.where(F.col("_cob_date") >= F.lit(start)).select(*[conformed(k, columns[k]).alias(k) for k in keys]).distinct()
    last = target.where(F.col("effective_from") < F.lit(start)).join(touched, _same(target, touched, keys), "left_semi").groupBy(*keys).agg(F.max("effective_from").alias("_from"))
    return touched.join(last, _same(touched, last, keys), "left").select(*[touched[k] for k in keys], "_from"), start


def _lost(target: DataFrame, raw: DataFrame) -> DataFrame:
    """Versions that begin on a date that raw has no delivery for."""
    dates = raw.select(F.col("_cob_date").alias("_held")).distinct()
    return target.join(dates, target["effective_from"] == dates["_held"], "left_anti")


def replay_changes(raw: DataFrame, target: DataFrame, columns: dict[str, str], keys: list[str], hashed: list[str], lookback_days: int = 3, derived: dict[str, Column] | None = None) -> DataFrame:
    """What new deliveries change in a dimension: the versions of each touched key from its replay
    start on, and a marker for each version there that isn't derived again, with the key, its
    effective_from and an effective_to that no version can have. To be merged by ``merge_versions``
    or by a store's ``upsert`` on (keys, effective_from).

    The version before the start seeds the comparison, and versions in scope whose date raw has
    lost are inputs too. Only dates from the earliest start on are read, and of those only rows of
    touched keys are cleaned and ranked; the newest delivery of a date is still told from all of its
    rows, by an aggregate of two columns. Keys without an earlier version need all dates.
    """
    derived = derived or {}
    begin, start = _scope(raw, target, columns, keys, lookback_days)
    begin = begin.persist(StorageLevel.DISK_ONLY)
    floor, fresh = begin.agg(F.min("_from"), F.count_if(F.col("_from").isNull())).first()
    renamed = begin.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_from")
    on = lambda df: all_of([df[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys])
    scope = target.join(renamed, on(target)).drop(*[f"_k_{k}" for k in keys])
    inside = scope.where("_from is null or effective_from >= _from")
    before = scope.where("effective_from < _from")
    latest = Window.partitionBy(*keys).orderBy(F.desc("effective_from"))
    seed = before.withColumn("_n", F.row_number().over(latest)).where("_n = 1")
    fields = [*columns, *derived, "source_batch_id"]

    def again(rows: DataFrame, wanted: DataFrame) -> DataFrame:
        """Daily rows of some dates and keys."""
        meta = ["_batch_id", "_cob_date", "_file_version", "_row_number"]
        rows = newest_rows(rows.select(*columns, *meta))
        rows = rows.select(*[conformed(c, kind).alias(c) for c, kind in columns.items()], F.col("_batch_id").alias("source_batch_id"), *meta[1:])
        kept = rows.join(wanted, all_of([rows[k].eqNullSafe(wanted[f"_k_{k}"]) for k in keys]) & (F.col("_from").isNull() | (F.col("_cob_date") >= F.col("_from")))).select(rows["*"])
        return last_in_file(kept.withColumns(derived), keys).select(*fields, F.col("_cob_date").alias("cob_date"))

    daily = None
    if floor is not None:
        daily = again(raw.where(F.col("_cob_date") >= F.lit(floor)), renamed.where("_from is not null"))
    if fresh or daily is None:
        new = again(raw, renamed.where("_from is null"))
        daily = new if daily is None else daily.unionByName(new)
    pruned = _lost(inside, raw)
    held = seed.select(*fields, F.col("effective_from").alias("cob_date")).unionByName(pruned.select(*fields, F.col("effective_from").alias("cob_date")))
    computed = versions(daily.unionByName(held), keys, hashed).select(*fields, *RANGE)
    return computed.unionByName(retractions(inside, computed, keys).select(*fields, *RANGE))


def retractions(inside: DataFrame, computed: DataFrame, keys: list[str]) -> DataFrame:
    """A marker for each version in scope that wasn't derived again: NULL but for its key,
    effective_from and the marker as effective_to."""
    new = computed.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("effective_from").alias("_at"))
    lost = inside.join(new, all_of([inside[k].eqNullSafe(new[f"_k_{k}"]) for k in keys]) & (F.col("effective_from") == F.col("_at")), "left_anti")
    own = {*keys, "effective_from"}
    kinds = {f.name: f.dataType for f in computed.schema}
    return lost.select(*[F.col(c) if c in own else retracted().alias(c) if c == "effective_to" else F.lit(None).cast(kinds[c]).alias(c) for c in computed.columns])


def merge_versions(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The target with changed versions in place of those of equal key and start, and without those
    that are marked."""
    fields = changes.columns
    new = changes.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("effective_from").alias("_at"))
    kept = target.join(new, all_of([target[k].eqNullSafe(new[f"_k_{k}"]) for k in keys]) & (target["effective_from"] == new["_at"]), "left_anti")
    return kept.select(*fields).unionByName(changes.where(F.col("effective_to") != retracted()))


def replay(raw: DataFrame, target: DataFrame, columns: dict[str, str], keys: list[str], hashed: list[str], lookback_days: int = 3, derived: dict[str, Column] | None = None) -> DataFrame:
    """The target after new deliveries, equal to a full build for re-deliveries of dates from each
    touched key's replay start on; all other versions stay untouched."""
    start: date = window_start(target, "effective_from", lookback_days)
    touched = raw.where(F.col("_cob_date") >= F.lit(start)).select(*[conformed(k, columns[k]).alias(k) for k in keys]).distinct().count()
    if touched >= MOST * target.select(*keys).distinct().count():
        return rebuild(raw, target, columns, keys, hashed, derived)
    return merge_versions(target, replay_changes(raw, target, columns, keys, hashed, lookback_days, derived), keys)


#: The share of keys from which on building all of them anew costs less than replaying the touched ones.
MOST = 0.5


def rebuild(raw: DataFrame, target: DataFrame, columns: dict[str, str], keys: list[str], hashed: list[str], derived: dict[str, Column] | None = None) -> DataFrame:
    """A full build that keeps what raw has lost: versions of the target whose date raw no longer
    holds are inputs like daily rows. The rows of a replay of every key from its beginning."""
    fields = [*columns, *(derived or {}), "source_batch_id"]
    daily = daily_rows(raw, columns, keys, derived).select(*fields, "cob_date")
    held = _lost(target, raw).select(*fields, F.col("effective_from").alias("cob_date"))
    return versions(daily.unionByName(held), keys, hashed).select(*fields, *RANGE)


def as_of_join(facts: DataFrame, dimension: DataFrame, keys: list[str], at: str, how: str = "left", carry: list[str] | None = None) -> DataFrame:
    """Facts with the version in force on their date: a hash join on the key, the range as residual."""
    side = dimension.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("effective_from").alias("_valid_from"), F.col("effective_to").alias("_valid_to"), *(carry or [c for c in dimension.columns if c not in (*keys, *RANGE)]))
    on = all_of([F.col(k) == F.col(f"_{k}") for k in keys]) & F.col(at).between(F.col("_valid_from"), F.col("_valid_to"))
    return facts.join(side, on, how).drop(*[f"_{k}" for k in keys], "_valid_to").withColumnRenamed("_valid_from", "reference_effective_from")


def as_of_join_spread(facts: DataFrame, dimension: DataFrame, keys: list[str], at: str, how: str = "left", carry: list[str] | None = None, part: int = 1_000_000) -> DataFrame:
    """``as_of_join`` for keys with very many facts or versions: both sides meet by key and month.

    A month's versions are those that begin in it and the one carried in from before, so a fact is
    compared with the versions of its month, not with all of its key's; and months of a key with
    more than ``part`` facts are dealt out to several tasks (facts equal in all columns to one). The carried versions come from one row
    for each key and month; the crowded months are at most the facts' number over ``part``, so they
    are broadcast. Ranges of a key must not overlap (``broken_ranges``); NULL keys and dates match
    nothing. Rows and columns are those of ``as_of_join``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"no such join here: {how}")
    carry = carry or [c for c in dimension.columns if c not in (*keys, *RANGE)]
    names = [f"_{k}" for k in keys]
    versions = dimension.select(*[F.col(k).alias(f"_{k}") for k in keys], F.trunc("effective_from", "MM").alias("_month"), F.struct(F.col("effective_from").alias("_valid_from"), F.col("effective_to").alias("_valid_to"), *carry).alias("_v"))
    counted = facts.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.trunc(at, "MM").alias("_month")).agg(F.count("*").alias("_n"))
    crowded = counted.where(F.col("_n") > part).select(*names, "_month", F.ceil(F.col("_n") / part).cast("int").alias("_parts"))
    # The last version of each month, then for each month with facts the last one of the months before.
    last = versions.groupBy(*names, "_month").agg(F.max_by("_v", F.col("_v")["_valid_from"]).alias("_last"))
    marks = last.unionByName(counted.select(*names, "_month"), allowMissingColumns=True).groupBy(*names, "_month").agg(F.first("_last", ignorenulls=True).alias("_last"), F.bool_or(F.col("_last").isNull()).alias("_wanted"))
    before = Window.partitionBy(*names).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("_v", F.last("_last", ignorenulls=True).over(before)).where("_wanted and _v is not null").select(*names, "_month", "_v")
    side = versions.unionByName(carried).join(F.broadcast(crowded), [*names, "_month"], "left")
    side = side.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))).select(*names, "_month", "_part", "_v.*")
    dealt = facts.withColumn("_fact_month", F.trunc(at, "MM"))
    known = crowded.select(*[F.col(n).alias(f"_k{n}") for n in names], F.col("_month").alias("_k_month"), F.col("_parts").alias("_fact_parts"))
    dealt = dealt.join(F.broadcast(known), all_of([F.col(k) == F.col(f"_k_{k}") for k in keys]) & (F.col("_fact_month") == F.col("_k_month")), "left")
    # Rows of a crowded month are dealt by what they hold, so that a task that runs again deals them alike.
    told = F.xxhash64(*[c for c, kind in facts.dtypes if not kind.startswith("map")])
    dealt = dealt.withColumn("_fact_part", F.when(F.col("_fact_parts").isNull(), 0).otherwise(F.pmod(told, F.col("_fact_parts"))).cast("int")).drop(*[f"_k{n}" for n in names], "_k_month", "_fact_parts")
    on = all_of([F.col(k) == F.col(f"_{k}") for k in keys]) & (F.col("_fact_month") == F.col("_month")) & (F.col("_fact_part") == F.col("_part")) & F.col(at).between(F.col("_valid_from"), F.col("_valid_to"))
    return dealt.join(side, on, how).drop(*names, "_month", "_part", "_fact_month", "_fact_part", "_valid_to").withColumnRenamed("_valid_from", "reference_effective_from")


def broken_ranges(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Versions that are inverted, overlap the next one or leave a gap, and keys that don't have
    exactly one open version; no rows if all is well."""
    order = Window.partitionBy(*keys).orderBy("effective_from", "effective_to")
    nxt = F.lead("effective_from").over(order)
    flawed = versions.withColumn("_next", nxt).select(
        *keys, "effective_from", F.when(F.col("effective_to") < F.col("effective_from"), "inverted").when(F.col("_next") <= F.col("effective_to"), "overlap").when(F.col("_next") > F.date_add("effective_to", 1), "gap").alias("flaw")
    )
    current = versions.groupBy(*keys).agg(F.count_if("is_current").alias("_n"), F.max("effective_from").alias("effective_from")).where("_n <> 1")
    return flawed.where("flaw is not null").unionByName(current.select(*keys, "effective_from", F.lit("not one current").alias("flaw")))
