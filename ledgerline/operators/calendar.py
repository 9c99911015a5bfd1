"""Business dates: month-ends, retention sets, gaps, lateness and feed status. Inputs are tables of
distinct dates, so the few global windows run over thousands of rows at most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conform import deadline


def month_end_dates(dates: DataFrame, column: str = "cob_date") -> DataFrame:
    """The last date of each month, without the latest month, which may be in progress."""
    ends = dates.groupBy(F.trunc(column, "MM").alias("_m")).agg(F.max(column).alias(column))
    latest = ends.agg(F.max("_m").alias("_last"))
    return ends.crossJoin(F.broadcast(latest)).where("_m < _last").select(column)


def _newest(dates: DataFrame, column: str, n: int) -> DataFrame:
    return dates.select(column).distinct().orderBy(F.desc(column)).limit(max(0, n))


def keep_set(dates: DataFrame, business_days: int, month_ends: int = 0, month_end_years: int = 0, column: str = "cob_date") -> DataFrame:
    """The newest business days and complete month-ends."""
    days = _newest(dates, column, business_days)
    ends = _newest(month_end_dates(dates, column), column, max(month_ends, 12 * month_end_years))
    return days.union(ends).distinct()


def expire_set(dates: DataFrame, business_days: int, month_ends: int = 0, month_end_years: int = 0, column: str = "cob_date") -> DataFrame:
    return dates.select(column).distinct().join(keep_set(dates, business_days, month_ends, month_end_years, column), column, "left_anti")


def _islands(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """(feed, missing): the ``at`` of ``calendar`` that lie between neighbouring ones of a feed. Both
    have ordinals, so what is missing between two places is a sequence, and only that is made. A
    feed's places before the calendar are one place before its first."""
    order = Window.orderBy("at")  # over distinct dates or weeks
    numbered = calendar.withColumn("_n", F.row_number().over(order))
    placed = days.join(numbered, "at", "left").select("feed", F.coalesce("_n", F.lit(0)).alias("_n")).distinct()
    gaps = placed.withColumn("_next", F.lead("_n").over(Window.partitionBy("feed").orderBy("_n"))).where("_next > _n + 1")
    each = gaps.select("feed", F.explode(F.sequence(F.col("_n") + 1, F.col("_next") - 1)).alias("_n"))
    return each.join(numbered, "_n").select("feed", F.col("at").alias("missing"))


def find_gaps(days: DataFrame, lookback: int = 0, weekly: tuple[str, ...] | Column = ()) -> DataFrame:
    """(feed, missing): dates (for weekly feeds ISO weeks, as 2026-W01) that other feeds have within
    a feed's own first and last date. The calendar is the union of all feeds' dates, its newest
    ``lookback`` dates (0: all) are looked at. ``weekly`` names feeds, or is a condition on them."""
    days = days.select("feed", "cob_date").distinct()
    calendar = days.select("cob_date").distinct()
    if lookback:
        calendar = _newest(calendar, "cob_date", lookback)
    is_weekly = weekly if isinstance(weekly, Column) else F.col("feed").isin(*weekly) if weekly else F.lit(False)
    day = F.date_format("cob_date", "yyyy-MM-dd")
    week = F.format_string("%04d-W%02d", F.extract(F.lit("YEAROFWEEK"), F.col("cob_date")).cast("int"), F.weekofyear("cob_date"))
    daily = _islands(days.where(~is_weekly).select("feed", day.alias("at")), calendar.select(day.alias("at")))
    return daily.unionByName(_islands(days.where(is_weekly).select("feed", week.alias("at")).distinct(), calendar.select(week.alias("at")).distinct()))


def first_arrivals(arrivals: DataFrame, newest: int = 0) -> DataFrame:
    """(feed, cob_date, first_arrival), for each feed's ``newest`` dates only unless that is 0."""
    first = arrivals.groupBy("feed", "cob_date").agg(F.min("arrived_at").alias("first_arrival"))
    if not newest:
        return first
    order = Window.partitionBy("feed").orderBy(F.desc("cob_date"))
    return first.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= newest).drop("_n")


def lateness(arrivals: DataFrame, clock: str = "06:00", newest: int = 0) -> DataFrame:
    """(feed, cob_date, first_arrival, deadline, is_late, is_bulk): the first arrival against the
    deadline; a feed is a bulk load if more than one date is late, all arriving on one day."""
    first = first_arrivals(arrivals, newest)
    told = first.withColumn("deadline", deadline("cob_date", clock)).withColumn("is_late", F.col("first_arrival") > F.col("deadline"))
    late = told.where("is_late").groupBy("feed").agg((F.count("*") > 1).alias("_many"), (F.count_distinct(F.to_date("first_arrival")) == 1).alias("_one"))
    return told.join(late, "feed", "left").withColumn("is_bulk", F.coalesce(F.col("_many") & F.col("_one") & F.col("is_late"), F.lit(False))).drop("_many", "_one")


def feed_status(expected: DataFrame, receipts: DataFrame, deliveries: DataFrame, commits: DataFrame, failures: DataFrame, now: str, clock: str = "06:00") -> DataFrame:
    """(feed, cob_date, status) for (feed, cob_date, is_expected) by precedence: not expected,
    committed, in progress, failed, received, past its deadline, waiting."""
    out = expected
    for name, side in (("_c", commits), ("_d", deliveries), ("_f", failures), ("_r", receipts)):
        out = out.join(side.select("feed", "cob_date").distinct().withColumn(name, F.lit(True)), ["feed", "cob_date"], "left")
    status = (
        F.when(~F.col("is_expected"), "NOT_EXPECTED")
        .when(F.col("_c"), "COMPLETE")
        .when(F.col("_d"), "PROCESSING")
        .when(F.col("_f"), "FAILED")
        .when(F.col("_r"), "RECEIVED")
        .when(F.lit(now).cast("timestamp") > deadline("cob_date", clock), "MISSING")
        .otherwise("WAITING")
    )
    return out.select("feed", "cob_date", status.alias("status"))


def pending(manifests: DataFrame, ingested: DataFrame, keep: DataFrame) -> DataFrame:
    """Manifests none of whose parts is ingested and whose date is kept."""
    return manifests.join(ingested.select("delivery_id").distinct(), "delivery_id", "left_anti").join(keep, "cob_date", "left_semi")


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key, by descending ``order``: an aggregate, so partial on each side."""
    rest = [c for c in rows.columns if c not in keys]
    top = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_top"))
    return top.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in rest])


def receipt_state(events: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """(transport_id, status): stages only move forward, but a failure holds at any time, and the
    next stage after the last failure begins anew, however far it was before."""
    rank = F.create_map(*[F.lit(x) for k, v in ranks.items() for x in (k, v)])
    failed = F.max(F.when(F.col("status") == "FAILED", F.col("occurred_at"))).over(Window.partitionBy("transport_id"))
    since = events.withColumn("_failed", failed).where("_failed is null or occurred_at >= _failed")
    scored = since.withColumn("_rank", F.when(F.col("status") == "FAILED", -2).otherwise(F.coalesce(rank[F.col("status")], F.lit(-1))))
    return scored.groupBy("transport_id").agg(F.max_by("status", F.struct("_rank", "occurred_at")).alias("status"))


def status_summary(status: DataFrame) -> DataFrame:
    """(cob_date, status, feeds): how many feeds of each date stand where."""
    return status.groupBy("cob_date", "status").agg(F.count("*").alias("feeds"))


def freshness(rows: DataFrame, column: str, now: str, limits: dict[str, tuple[float, float]], default: tuple[float, float] = (26, 50), source: str = "source") -> DataFrame:
    """(source, newest, age_hours, status) of sources by their newest ``column``: pass, warn from
    the first and error from the second limit of hours on. ``limits`` are by source."""
    by = F.create_map(*[F.lit(x) for k, (w, e) in limits.items() for x in (k, F.struct(F.lit(float(w)).alias("w"), F.lit(float(e)).alias("e")))]) if limits else None
    fallback = F.struct(F.lit(float(default[0])).alias("w"), F.lit(float(default[1])).alias("e"))
    limit = fallback if by is None else F.coalesce(F.element_at(by, F.col("source")), fallback)
    newest = rows.groupBy(F.col(source).alias("source")).agg(F.max(column).alias("newest"))
    aged = newest.withColumn("age_hours", (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / F.lit(3.6e9)).withColumn("_l", limit)
    # a source without any time is as stale as can be
    status = F.when(F.col("age_hours").isNull() | (F.col("age_hours") > F.col("_l.e")), "error").when(F.col("age_hours") > F.col("_l.w"), "warn").otherwise("pass")
    return aged.select("source", "newest", "age_hours", status.alias("status"))
