"""More queries: operators made for hot keys, large comparisons and rebuilding no more than is needed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendar, maintain, marts, reconcile, scd2
from .queries import ALL_FEEDS, NATION_DAYS, _doubles, nation_days, query, t, versions_sql

# ---------------------------------------------------------------- as-of join by key and month

# Three keys hold all order lines; their level changes on most days, so each has thousands of versions.
LEVELS = versions_sql("SELECT l_returnflag, CAST(l_shipdate AS DATE) AS cob_date, CAST(count(*) % 7 AS VARCHAR) AS level FROM lineitem GROUP BY 1, 2", "l_returnflag", "level")


def _levels(spark, d):
    daily = t(spark, d, "lineitem").groupBy("l_returnflag", F.to_date("l_shipdate").alias("cob_date")).agg((F.count("*") % 7).cast("string").alias("level"))
    return scd2.versions(daily, ["l_returnflag"], ["level"])


@query(f"""WITH v AS ({LEVELS}) SELECT l.l_returnflag, level, count(*) AS n_rows, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, max(effective_from) AS newest_version
FROM lineitem l LEFT JOIN v ON v.l_returnflag = l.l_returnflag AND CAST(l_shipdate AS DATE) + l_linenumber BETWEEN effective_from AND effective_to GROUP BY 1, 2""")
def as_of_join_hot_keys(spark, d):
    facts = t(spark, d, "lineitem").select("l_returnflag", F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber").cast("int")).alias("cob_date"), "l_quantity", "l_orderkey", "l_linenumber")
    out = scd2.as_of_join_spread(facts, _levels(spark, d), ["l_returnflag"], "cob_date", carry=["level"])
    return _doubles(out.groupBy("l_returnflag", "level").agg(F.count("*").alias("n_rows"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"), F.max("reference_effective_from").alias("newest_version")), "quantity")


# ---------------------------------------------------------------- reconciliation by a hash tree

LINES = "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem"
OLD_LINES = "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 991 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity FROM lineitem WHERE l_orderkey % 997 <> 0"


@query(f"""WITH l AS (SELECT l_orderkey, count(*) AS n, list_sort(list([l_linenumber, l_partkey, l_quantity])) AS rows FROM ({OLD_LINES} UNION ALL {LINES} WHERE l_orderkey % 983 = 0 AND l_linenumber = 1 AND l_orderkey % 997 <> 0) GROUP BY 1),
n AS (SELECT l_orderkey, count(*) AS n, list_sort(list([l_linenumber, l_partkey, l_quantity])) AS rows FROM ({LINES} WHERE l_orderkey % 977 <> 0) GROUP BY 1)
SELECT coalesce(l.l_orderkey, n.l_orderkey) AS l_orderkey, CASE WHEN n.l_orderkey IS NULL THEN 'legacy_only' WHEN l.l_orderkey IS NULL THEN 'new_only' ELSE 'changed' END AS status, coalesce(l.n, 0) AS legacy_rows, coalesce(n.n, 0) AS new_rows
FROM l FULL JOIN n ON l.l_orderkey = n.l_orderkey WHERE l.rows IS DISTINCT FROM n.rows""")
def recon_tree(spark, d):
    """Order lines by order, so most keys have several rows; one side lacks some, has changed ones,
    and has rows twice."""
    new = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    k = F.col("l_orderkey")
    legacy = new.where(k % 997 != 0)
    twice = legacy.where((k % 983 == 0) & (F.col("l_linenumber") == 1))
    legacy = legacy.withColumn("l_quantity", F.when(k % 991 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))).unionByName(twice)
    out = reconcile.compare_by_tree(legacy, new.where(k % 977 != 0), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_quantity"])
    return out.withColumn("l_orderkey", F.col("l_orderkey").cast("double").cast("long"))


# ---------------------------------------------------------------- change mart, restated dates only

REACHED = """(CAST(day(ks.cob_date) AS INTEGER) = 15 OR CAST(day(prior) AS INTEGER) = 15 OR CAST(day(month_end) AS INTEGER) = 15 OR NOT EXISTS (SELECT 1 FROM old WHERE old.cob_date = ks.cob_date AND old.prior IS NOT DISTINCT FROM ks.prior AND old.month_end IS NOT DISTINCT FROM ks.month_end))"""
OLD_PAIRS = "od AS (SELECT cob_date FROM d WHERE day(cob_date) <> 20), ome AS (SELECT max(cob_date) AS m FROM od GROUP BY date_trunc('month', cob_date)), old AS (SELECT cob_date, lag(cob_date) OVER (ORDER BY cob_date) AS prior, (SELECT max(m) FROM ome WHERE m < od.cob_date) AS month_end FROM od)"


@query(f"""WITH {NATION_DAYS}, {OLD_PAIRS} SELECT ks.cob_date, ks.k AS counterparty_id, ks.prior AS prior_cob_date, ks.month_end AS prior_month_end, CAST(c.mtm AS DOUBLE) AS total_mtm, CAST(p.mtm AS DOUBLE) AS prior_total_mtm, CAST(m.mtm AS DOUBLE) AS month_end_mtm
FROM ks LEFT JOIN e c ON c.cob_date = ks.cob_date AND c.k = ks.k LEFT JOIN e p ON p.cob_date = ks.prior AND p.k = ks.k LEFT JOIN e m ON m.cob_date = ks.month_end AND m.k = ks.k WHERE {REACHED}""")
def exposure_change_restated(spark, d):
    """The part of the change mart that has to be made again after the 15ths were delivered anew
    and the 20ths came for the first time."""
    e = nation_days(spark, d)
    days = e.select("cob_date").distinct()
    before = marts.date_pairs(days.where(F.dayofmonth("cob_date") != 20))
    pairs = marts.restated_pairs(marts.date_pairs(days), before, days.where(F.dayofmonth("cob_date") == 15))
    out = marts.exposure_change(e, pairs=pairs).select("cob_date", "counterparty_id", "prior_cob_date", "prior_month_end", "total_mtm", "prior_total_mtm", "month_end_mtm")
    return _doubles(out, "total_mtm", "prior_total_mtm", "month_end_mtm")


# ---------------------------------------------------------------- gaps of sparse weekly feeds

USER_FEEDS = "(SELECT DISTINCT event_type || '-' || CAST(user_id AS VARCHAR) AS feed, CAST(ts AS DATE) AS cob_date FROM events)"
WEEK = "printf('%04d-W%02d', CAST(isoyear(cob_date) AS INTEGER), CAST(weekofyear(cob_date) AS INTEGER))"


@query(f"""WITH b AS (SELECT feed, min(cob_date) AS lo, max(cob_date) AS hi FROM {USER_FEEDS} GROUP BY 1), x AS (SELECT DISTINCT feed, {WEEK} AS missing FROM b JOIN (SELECT DISTINCT cob_date FROM {ALL_FEEDS}) c ON c.cob_date BETWEEN lo AND hi)
SELECT feed, missing FROM x WHERE NOT EXISTS (SELECT 1 FROM (SELECT feed, {WEEK} AS w FROM {USER_FEEDS}) f WHERE f.feed = x.feed AND f.w = x.missing)""")
def gaps_weekly_users(spark, d):
    """Each user's events of one type are a weekly feed."""
    e = t(spark, d, "events").select(F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("feed"), F.to_date("ts").alias("cob_date"))
    return calendar.find_gaps(e, weekly=F.lit(True))


@query(f"""WITH c AS (SELECT DISTINCT cob_date FROM {USER_FEEDS} ORDER BY cob_date DESC LIMIT 9), b AS (SELECT feed, min(cob_date) AS lo, max(cob_date) AS hi FROM {USER_FEEDS} GROUP BY 1)
SELECT feed, CAST(cob_date AS VARCHAR) AS missing FROM b JOIN c ON c.cob_date BETWEEN lo AND hi WHERE NOT EXISTS (SELECT 1 FROM {USER_FEEDS} f WHERE f.feed = b.feed AND f.cob_date = c.cob_date)""")
def gaps_daily_recent(spark, d):
    """The same as daily feeds, looked at over the newest nine dates."""
    e = t(spark, d, "events").select(F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("feed"), F.to_date("ts").alias("cob_date"))
    return calendar.find_gaps(e, 9)


# ---------------------------------------------------------------- compaction

SMALL_PARTS = "(SELECT strftime(l_shipdate, '%Y-%m') AS folder, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS part, 1 + l_linenumber % 3 AS files, CAST(l_quantity * 1000 AS BIGINT) AS bytes FROM lineitem)"


@query(f"""WITH f AS (SELECT folder, part, files, CAST(floor(coalesce(sum(bytes) OVER (PARTITION BY folder ORDER BY bytes, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 60000) AS BIGINT) AS own FROM {SMALL_PARTS} WHERE bytes < 0.75 * 60000 * files),
b AS (SELECT folder, own, row_number() OVER (ORDER BY folder, own) - 1 AS bin FROM f GROUP BY folder, own HAVING sum(files) >= 5) SELECT folder, part, CAST(bin AS INTEGER) AS bin FROM f JOIN b USING (folder, own)""")
def compaction_bins(spark, d):
    """Order lines as the parts of months, packed to a target size."""
    parts = t(spark, d, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("folder"), F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("part"), (1 + F.col("l_linenumber") % 3).cast("long").alias("files"), (F.col("l_quantity") * 1000).cast("long").alias("bytes"))
    return maintain.packed_bins(parts, 60_000)
