"""Full-snapshot supersession: the newest delivery restates its whole business date."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conform import PROVENANCE, WINDOW_FLOOR, conformed, source_provenance

INSTANT = re.compile(r"\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2}(\.\d{1,6})?)?")


def newest_versions(raw: DataFrame) -> DataFrame:
    """(_cob_date, newest): one small row for each date."""
    return raw.groupBy("_cob_date").agg(F.max("_file_version").alias("newest"))


def rank_latest(rows: DataFrame, keys: list[str], newest: str | None = None) -> Column:
    """1 for the last row of a key in its date's newest delivery; NULL for older deliveries."""
    version = F.max("_file_version").over(Window.partitionBy("_cob_date")) if newest is None else F.col(newest)
    order = Window.partitionBy("_cob_date", "_file_version", *keys).orderBy(F.desc("_row_number"))
    return F.when(F.col("_file_version") == version, F.row_number().over(order))


def dedupe_latest(raw: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each date and key, from the newest delivery of the date, last in file.

    The newest version comes from a small aggregate that is joined (broadcast if it is small), not
    from a window over whole dates, so that a date with most rows isn't one task; the last row is
    then found among the newest rows alone."""
    return last_in_file(newest_rows(raw), keys)


def newest_rows(raw: DataFrame) -> DataFrame:
    """The rows of each date's newest delivery."""
    newest = newest_versions(raw)
    return raw.join(newest, raw["_cob_date"].eqNullSafe(newest["_cob_date"])).drop(newest["_cob_date"]).where("_file_version = newest").drop("newest")


def last_in_file(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows of one delivery for each date, the last of each date and key."""
    order = Window.partitionBy("_cob_date", *keys).orderBy(F.desc("_row_number"))
    return rows.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def known_as_of(raw: DataFrame, instant: str | None, incremental: bool = False) -> DataFrame:
    """Rows that had arrived by ``instant`` (yyyy-MM-dd[ HH:mm:ss]); refused on incremental builds."""
    if instant is None:
        return raw
    if incremental:
        raise ValueError("an as-of build is a full build")
    if not INSTANT.fullmatch(instant):
        raise ValueError(f"not an instant: {instant}")
    return raw.where(F.coalesce("_received_at", "_ingest_ts") <= F.lit(instant).cast("timestamp"))


def window_start(target: DataFrame | None, column: str, lookback_days: int) -> date | None:
    """Calendar days before the last target date; a literal, so that partitions are pruned."""
    if target is None:
        return None
    last = target.agg(F.max(column)).first()[0] or WINDOW_FLOOR
    return last - timedelta(days=lookback_days)


def incremental_window(source: DataFrame, column: str, target: DataFrame | None, target_column: str, lookback_days: int = 3) -> DataFrame:
    start = window_start(target, target_column, lookback_days)
    return source if start is None else source.where(F.col(column) >= F.lit(start))


def conform(raw: DataFrame, columns: dict[str, str], keys: list[str], derived: dict[str, Column] | None = None, audit: list[Column] | None = None) -> DataFrame:
    """A date-partitioned prepared table: clean, rank on the cleaned key, keep one, derive."""
    meta = ["_cob_date", "_file_version", "_row_number", "_source_file", "_received_at", "_schema_version", "_source_system", "_delivery_id", "_batch_id"]
    cleaned = raw.select(*[conformed(c, kind).alias(c) for c, kind in columns.items()], *[m for m in meta if m in raw.columns])
    kept = dedupe_latest(cleaned, keys).withColumn("cob_date", F.col("_cob_date"))
    out = kept.withColumns(derived or {})
    provenance = source_provenance() if "_delivery_id" in out.columns else []
    told = out.select("cob_date", *columns, *provenance, *(audit or []), *(derived or {}))
    return in_order(told, list(columns), audit=tuple(c for c in told.columns if c not in ("cob_date", *columns, *PROVENANCE, *(derived or {}))))


def rows_per_date(df: DataFrame, column: str = "_cob_date") -> DataFrame:
    """(cob_date, n_rows): how many rows each date has."""
    return df.groupBy(F.col(column).alias("cob_date")).agg(F.count("*").alias("n_rows"))


def in_order(df: DataFrame, columns: list[str], scd2: bool = False, audit: tuple[str, ...] = ()) -> DataFrame:
    """The fixed order of a prepared table's columns: the date (not in a dimension), the contract's
    columns, provenance, what audits, what is derived, and a dimension's range last. Columns that
    aren't there are left out, none is lost."""
    head = [] if scd2 else ["cob_date"]
    tail = ["effective_from", "effective_to", "is_current", "effective_from_month"] if scd2 else []
    known = [*head, *columns, *PROVENANCE, "source_batch_id", *audit]
    derived = [c for c in df.columns if c not in (*known, *tail)]
    return df.select(*[c for c in (*dict.fromkeys([*known, *derived]), *tail) if c in df.columns])


def overwrite_dates(df: DataFrame, path: str, partition: str = "cob_date") -> None:
    """Replaces exactly the dates that ``df`` returns; each must be whole."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
