"""The engine's operators over the driver's tables, each with the SQL that checks it.

The tables stand in for the domain: a counterparty is a customer, a trade an order line, a business
date an order's or event's date, file order the key, and odd and even keys two deliveries of a date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import conform as C
from ..operators import calendar, maintain, marts, publish, quality, reconcile, registry, scd2, snapshot
from ..sources import delivery, raw_ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---------------------------------------------------------------- scalar expressions

DIRTY = "CASE c_custkey % 5 WHEN 0 THEN '  ' || lower(c_mktsegment) || ' ' WHEN 1 THEN 'N/A' WHEN 2 THEN '' WHEN 3 THEN 'NULL' ELSE c_mktsegment END"


@query(f"SELECT c_custkey, nullif(nullif(nullif(trim({DIRTY}), ''), 'NULL'), 'N/A') AS cleaned, upper(nullif(nullif(nullif(trim({DIRTY}), ''), 'NULL'), 'N/A')) AS code FROM customer")
def clean_codes(spark, d):
    df = t(spark, d, "customer").select("c_custkey", F.expr(DIRTY).alias("raw"))
    return df.select("c_custkey", C.clean_string("raw").alias("cleaned"), C.upper_code("raw").alias("code"))


FLAGS = "CASE event_id % 7 WHEN 0 THEN 'Y' WHEN 1 THEN 'no' WHEN 2 THEN 'TRUE' WHEN 3 THEN '0' WHEN 4 THEN 'maybe' WHEN 5 THEN 'n' ELSE NULL END"


@query(f"SELECT event_id, CASE WHEN upper({FLAGS}) IN ('Y','YES','TRUE','1') THEN true WHEN upper({FLAGS}) IN ('N','NO','FALSE','0') THEN false END AS flag FROM events")
def yes_no(spark, d):
    return t(spark, d, "events").select("event_id", C.yes_no_flag(F.expr(FLAGS)).alias("flag"))


@query("""SELECT o_orderkey, coalesce(CAST(try_strptime(raw, '%Y-%m-%d') AS DATE), CAST(try_strptime(raw, '%Y%m%d') AS DATE)) AS parsed FROM (
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') WHEN 2 THEN 'n/a' END AS raw FROM orders)""")
def parse_dates(spark, d):
    raw = F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "yyyyMMdd")).when(F.col("o_orderkey") % 4 == 2, "n/a")
    return t(spark, d, "orders").select("o_orderkey", C.parse_date(raw).alias("parsed"))


AMOUNT = "CASE WHEN p_partkey % 3 = 0 THEN 'n.a.' WHEN p_partkey % 3 = 1 THEN CAST(p_size AS VARCHAR) ELSE CAST(p_size AS VARCHAR) || '.125' END"


@query(f"SELECT p_partkey, CAST(TRY_CAST({AMOUNT} AS DECIMAL(18,2)) AS DOUBLE) AS amount, TRY_CAST(CASE WHEN p_partkey % 2 = 0 THEN 'x' ELSE CAST(p_size AS VARCHAR) END AS INTEGER) AS whole FROM part")
def safe_casts(spark, d):
    raw = F.when(F.col("p_partkey") % 3 == 0, "n.a.").when(F.col("p_partkey") % 3 == 1, F.col("p_size").cast("string")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".125")))
    whole = F.when(F.col("p_partkey") % 2 == 0, "x").otherwise(F.col("p_size").cast("string"))
    return t(spark, d, "part").select("p_partkey", C.safe_cast(raw, "decimal(18,2)").cast("double").alias("amount"), C.safe_cast(whole, "int").alias("whole"))


@query("SELECT n_nationkey, coalesce(did, split_part(path, '/', -1)) AS delivery_ref FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'dlv_' || n_nationkey END AS did, 'landing/a/' || n_name || '.csv' AS path FROM nation)")
def delivery_refs(spark, d):
    n = t(spark, d, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("dlv_"), F.col("n_nationkey").cast("string"))).alias("_delivery_id"), F.concat(F.lit("landing/a/"), "n_name", F.lit(".csv")).alias("_source_file"))
    return n.select("n_nationkey", C.delivery_ref().alias("delivery_ref"))


NAME = "'TRADE_' || strftime(o_orderdate, '%Y%m%d') || CASE WHEN o_orderkey % 2 = 0 THEN '_v' || (o_orderkey % 9 + 1) ELSE '' END || '.csv'"


@query(rf"SELECT o_orderkey, CAST(strptime(regexp_extract(n, '^TRADE_(\d{{8}})', 1), '%Y%m%d') AS DATE) AS cob_date, coalesce(TRY_CAST(nullif(regexp_extract(n, '_v(\d+)\.csv$', 1), '') AS INTEGER), 1) AS version FROM (SELECT o_orderkey, {NAME} AS n FROM orders)")
def parse_filenames(spark, d):
    name = F.concat(F.lit("TRADE_"), F.date_format("o_orderdate", "yyyyMMdd"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("_v"), (F.col("o_orderkey") % 9 + 1).cast("string"))).otherwise(""), F.lit(".csv"))
    cob, version = C.parse_filename("n", r"^TRADE_(\d{8})(?:_v(\d+))?\.csv$")
    return t(spark, d, "orders").select("o_orderkey", name.alias("n")).select("o_orderkey", cob.alias("cob_date"), version.alias("version"))


@query("SELECT c_custkey, sha256(concat_ws('||', coalesce(c_name, ''), coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END, ''), CAST(c_nationkey AS VARCHAR))) AS row_hash FROM customer")
def scd2_hash(spark, d):
    return t(spark, d, "customer").select("c_custkey", C.row_hash("c_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")), "c_nationkey").alias("row_hash"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN m IS NOT NULL THEN m < c END AS is_matured FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 5 <> 0 THEN CAST(l_shipdate AS DATE) END AS m, DATE '1995-06-17' AS c FROM lineitem)")
def matured_flags(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 5 != 0, F.to_date("l_shipdate")).alias("m"), F.lit("1995-06-17").cast("date").alias("c"))
    return li.select("l_orderkey", "l_linenumber", C.is_matured("m", "c").alias("is_matured"))


RATING_SQL = "CASE p_partkey % 25 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(C.RATINGS)) + " WHEN 22 THEN 'WR' END"
RANK_SQL = "CASE rating " + " ".join(f"WHEN '{r}' THEN {i + 1}" for i, r in enumerate(C.RATINGS)) + " END"
IG_SQL = "CASE WHEN rating IN (" + ",".join(f"'{r}'" for r in C.RATINGS[: C.INVESTMENT_GRADES]) + ") THEN 'INVESTMENT_GRADE' WHEN rating IS NOT NULL THEN 'SUB_INVESTMENT_GRADE' END"


def _rated(spark, d):
    r = F.try_element_at(F.array(*map(F.lit, (*C.RATINGS, "WR"))), (F.col("p_partkey") % 25 + 1).cast("int"))
    return t(spark, d, "part").select("p_partkey", "p_brand", r.alias("rating"))


@query(f"SELECT p_partkey, rating, CAST({RANK_SQL} AS INTEGER) AS rating_rank, {IG_SQL} AS grade_band FROM (SELECT p_partkey, {RATING_SQL} AS rating FROM part)")
def grade_band(spark, d):
    return _rated(spark, d).select("p_partkey", "rating", C.rating_rank("rating").alias("rating_rank"), C.grade_band("rating").alias("grade_band"))


@query(f"SELECT p_brand, CAST(max({RANK_SQL}) AS INTEGER) AS worst_rank, min(CASE WHEN {IG_SQL} = 'INVESTMENT_GRADE' THEN 1 ELSE 0 END) AS all_investment_grade FROM (SELECT p_brand, {RATING_SQL} AS rating FROM part) GROUP BY p_brand")
def worst_rank(spark, d):
    return _rated(spark, d).groupBy("p_brand").agg(F.max(C.rating_rank("rating")).alias("worst_rank"), F.min(F.when(C.grade_band("rating") == "INVESTMENT_GRADE", 1).otherwise(0)).alias("all_investment_grade"))


@query("SELECT n_nationkey, CAST(map_keys(m) AS VARCHAR) AS names, m['n_name'] AS n_name FROM (SELECT n_nationkey, MAP {'n_name': n_name, 'n_regionkey': CAST(n_regionkey AS VARCHAR)} AS m FROM nation)")
def extra_columns_map(spark, d):
    m = t(spark, d, "nation").select("n_nationkey", C.extra_columns(["n_name", "n_regionkey"]).alias("m"))
    return m.select("n_nationkey", F.concat(F.lit("["), F.array_join(F.map_keys("m"), ", "), F.lit("]")).alias("names"), F.col("m")["n_name"].alias("n_name"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 1 AS TIMESTAMP) + INTERVAL 390 MINUTE AS due FROM orders")
def deadlines(spark, d):
    return t(spark, d, "orders").select("o_orderkey", C.deadline(F.to_date("o_orderdate"), "06:30").alias("due"))


@query("SELECT c_custkey, sha256(concat_ws(chr(31), printf('%.10f', CAST(c_custkey AS DOUBLE)), trim(c_name), printf('%.10f', c_acctbal))) AS row_hash FROM customer")
def canonical_hashes(spark, d):
    df = t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return df.select("c_custkey", C.canonical_row_hash(df, ["c_custkey", "c_name", "c_acctbal"]).alias("row_hash"))


# ---------------------------------------------------------------- supersession and windows

RAW = "(SELECT CAST(o_orderdate AS DATE) AS _cob_date, 1 + o_orderkey % 2 AS _file_version, o_orderkey AS _row_number, o_custkey, o_totalprice, o_orderpriority FROM orders)"


def _raw_orders(spark, d):
    o = t(spark, d, "orders")
    return o.select(F.to_date("o_orderdate").alias("_cob_date"), (1 + F.col("o_orderkey") % 2).alias("_file_version"), F.col("o_orderkey").alias("_row_number"), "o_custkey", "o_totalprice", "o_orderpriority")


DEDUPE = f"SELECT _cob_date, o_custkey, _row_number, o_totalprice, o_orderpriority, _file_version FROM (SELECT *, CASE WHEN _file_version = max(_file_version) OVER (PARTITION BY _cob_date) THEN row_number() OVER (PARTITION BY _cob_date, _file_version, o_custkey ORDER BY _row_number DESC) END AS rk FROM {RAW}) WHERE rk = 1"


@query(f"SELECT _cob_date AS cob_date, o_custkey, _row_number, o_totalprice FROM ({DEDUPE})")
def dedupe_latest_orders(spark, d):
    return snapshot.dedupe_latest(_raw_orders(spark, d), ["o_custkey"]).select(F.col("_cob_date").alias("cob_date"), "o_custkey", "_row_number", "o_totalprice")


@query(f"SELECT _cob_date AS cob_date, count(rk) AS ranked, count(*) AS total FROM (SELECT *, CASE WHEN _file_version = max(_file_version) OVER (PARTITION BY _cob_date) THEN row_number() OVER (PARTITION BY _cob_date, _file_version, o_custkey ORDER BY _row_number DESC) END AS rk FROM {RAW}) GROUP BY 1")
def dedupe_ranks(spark, d):
    ranked = _raw_orders(spark, d)
    return ranked.withColumn("rk", snapshot.rank_latest(ranked, ["o_custkey"])).groupBy(F.col("_cob_date").alias("cob_date")).agg(F.count("rk").alias("ranked"), F.count("*").alias("total"))


@query("""SELECT user_id, cob_date, event_id FROM (SELECT *, row_number() OVER (PARTITION BY cob_date, user_id ORDER BY event_id DESC) AS rk FROM (
SELECT *, max(v) OVER (PARTITION BY cob_date) AS newest FROM (SELECT user_id, event_id, CAST(ts AS DATE) AS cob_date, 1 + event_id % 3 AS v, CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 2 DAY END AS received, ts + INTERVAL 5 DAY AS ingested FROM events)
WHERE coalesce(received, ingested) <= (SELECT min(ts) + INTERVAL 20 DAY FROM events)) WHERE v = newest) WHERE rk = 1""")
def as_of_knowledge(spark, d):
    e = t(spark, d, "events")
    raw = e.select("user_id", "event_id", F.to_date("ts").alias("_cob_date"), (1 + F.col("event_id") % 3).alias("_file_version"), F.col("event_id").alias("_row_number"), F.when(F.col("event_id") % 2 == 0, F.col("ts") + F.expr("INTERVAL 2 DAYS")).alias("_received_at"), (F.col("ts") + F.expr("INTERVAL 5 DAYS")).alias("_ingest_ts"))
    instant = e.agg(F.date_format(F.min("ts") + F.expr("INTERVAL 20 DAYS"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    return snapshot.dedupe_latest(snapshot.known_as_of(raw, instant), ["user_id"]).select("user_id", F.col("_cob_date").alias("cob_date"), "event_id")


@query(f"SELECT _cob_date AS cob_date, count(*) AS n_rows FROM {RAW} WHERE _cob_date >= (SELECT max(_cob_date) - 3 FROM {RAW} WHERE _cob_date < DATE '1998-01-01') GROUP BY 1")
def incremental_window_orders(spark, d):
    raw = _raw_orders(spark, d)
    target = raw.where("_cob_date < DATE '1998-01-01'")
    return snapshot.rows_per_date(snapshot.incremental_window(raw, "_cob_date", target, "_cob_date", 3))


# ---------------------------------------------------------------- dimensions


def versions_sql(source: str, key: str, attribute: str) -> str:
    return f"""SELECT {key}, {attribute}, cob_date AS effective_from, coalesce(CAST(nxt - 1 AS DATE), DATE '9999-12-31') AS effective_to, nxt IS NULL AS is_current, CAST(date_trunc('month', cob_date) AS DATE) AS effective_from_month FROM (
SELECT *, lead(cob_date) OVER (PARTITION BY {key} ORDER BY cob_date) AS nxt FROM (SELECT *, lag({attribute}) OVER (PARTITION BY {key} ORDER BY cob_date) AS prev, row_number() OVER (PARTITION BY {key} ORDER BY cob_date) AS rn FROM ({source}))
WHERE rn = 1 OR coalesce(prev, '') <> coalesce({attribute}, ''))"""


EVENT_DAYS = "SELECT user_id, CAST(ts AS DATE) AS cob_date, max_by(event_type, event_id) AS event_type FROM events GROUP BY 1, 2"
EVENT_VERSIONS = versions_sql(EVENT_DAYS, "user_id", "event_type")


def _event_versions(spark, d):
    daily = t(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("cob_date")).agg(F.max_by("event_type", "event_id").alias("event_type"))
    return scd2.versions(daily, ["user_id"], ["event_type"]).select("user_id", "event_type", *scd2.RANGE)


@query(EVENT_VERSIONS)
def scd2_user_events(spark, d):
    return _event_versions(spark, d)


CUSTOMER_DAYS = f"SELECT o_custkey, _cob_date AS cob_date, o_orderpriority FROM ({DEDUPE})"
CUSTOMER_VERSIONS = versions_sql(CUSTOMER_DAYS, "o_custkey", "o_orderpriority")


def _customer_versions(spark, d):
    daily = snapshot.dedupe_latest(_raw_orders(spark, d), ["o_custkey"]).select("o_custkey", F.col("_cob_date").alias("cob_date"), "o_orderpriority")
    return scd2.versions(daily, ["o_custkey"], ["o_orderpriority"]).select("o_custkey", "o_orderpriority", *scd2.RANGE)


@query(CUSTOMER_VERSIONS)
def scd2_customer_priority(spark, d):
    return _customer_versions(spark, d)


@query(f"""WITH v AS ({CUSTOMER_VERSIONS}) SELECT o_custkey, o_orderpriority, effective_from, effective_to, is_current FROM v
WHERE NOT (NOT is_current AND effective_to < DATE '1997-01-01')""")
def scd2_replayed(spark, d):
    """A dimension built from the dates before 1998 and brought up to date by replay, then
    restricted like a retention run: equal to the full build."""
    raw = _raw_orders(spark, d).select("_cob_date", "_file_version", "_row_number", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderpriority", F.lit("b").alias("_batch_id"))
    columns = {"o_custkey": "string", "o_orderpriority": "string"}
    target = scd2.build_full(raw.where("_cob_date < DATE '1998-01-01'"), columns, ["o_custkey"], ["o_orderpriority"]).persist(StorageLevel.DISK_ONLY)  # a stored table elsewhere
    out = scd2.replay(raw, target, columns, ["o_custkey"], ["o_orderpriority"], 3)
    return out.where("is_current or effective_to >= DATE '1997-01-01'").select(F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderpriority", "effective_from", "effective_to", "is_current")


# A re-delivery of the last dates: the first deliveries of each date are known to the target.
FIRST = f"SELECT _cob_date AS cob_date, o_custkey, o_orderpriority FROM ({DEDUPE.replace(RAW, '(SELECT * FROM ' + RAW + ' WHERE _file_version = 1)')})"
RECENT = "(SELECT max(effective_from) - 30 FROM old)"


@query(f"""WITH old AS ({versions_sql(FIRST, "o_custkey", "o_orderpriority")}), new AS ({CUSTOMER_VERSIONS}),
touched AS (SELECT DISTINCT o_custkey FROM {RAW} WHERE _cob_date >= {RECENT}), b AS (SELECT t.o_custkey, coalesce(max(effective_from) FILTER (WHERE effective_from < {RECENT}), DATE '0001-01-01') AS f FROM touched t LEFT JOIN old USING (o_custkey) GROUP BY 1),
daily AS (SELECT o_custkey, cob_date, o_orderpriority FROM ({CUSTOMER_DAYS}) JOIN b USING (o_custkey) WHERE cob_date >= f UNION ALL SELECT o_custkey, effective_from, o_orderpriority FROM (SELECT old.*, row_number() OVER (PARTITION BY o_custkey ORDER BY effective_from DESC) AS n FROM old JOIN b USING (o_custkey) WHERE effective_from < f) WHERE n = 1),
v AS ({versions_sql("SELECT * FROM daily", "o_custkey", "o_orderpriority")})
SELECT o_custkey, o_orderpriority, effective_from, effective_to, is_current FROM v
UNION ALL SELECT o_custkey, NULL, effective_from, DATE '0001-01-01', NULL FROM old JOIN b USING (o_custkey) WHERE effective_from >= f AND (o_custkey, effective_from) NOT IN (SELECT o_custkey, effective_from FROM v)""")
def scd2_markers(spark, d):
    """Changed versions and retraction markers of re-delivered dates."""
    raw = _raw_orders(spark, d).select("_cob_date", "_file_version", "_row_number", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderpriority", F.lit("b").alias("_batch_id"))
    columns = {"o_custkey": "string", "o_orderpriority": "string"}
    target = scd2.build_full(raw.where("_file_version = 1"), columns, ["o_custkey"], ["o_orderpriority"])
    out = scd2.replay_changes(raw, target, columns, ["o_custkey"], ["o_orderpriority"], 30)
    return out.select(F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderpriority", "effective_from", "effective_to", "is_current")


@query(f"SELECT count(*) AS n_versions, count(*) FILTER (WHERE is_current) AS current_versions, count(*) FILTER (WHERE NOT is_current AND effective_to < DATE '1996-01-01') AS expiring FROM ({CUSTOMER_VERSIONS})")
def retention_scd2_counts(spark, d):
    import datetime

    return maintain.retention_counts(_customer_versions(spark, d), datetime.date(1996, 1, 1)).select(F.col("total").alias("n_versions"), "current_versions", "expiring")


# ---------------------------------------------------------------- marts

TRADES = """(SELECT CAST(o_orderdate AS DATE) AS cob_date, o_custkey AS counterparty_id, l_returnflag AS book, l_linestatus AS product_type, CAST(l_extendedprice AS DECIMAL(18,2)) AS notional,
CASE WHEN l_linenumber % 7 = 0 THEN NULL WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS mtm_value,
CASE WHEN l_linenumber % 5 <> 0 THEN CAST(l_shipdate AS DATE) END AS maturity_date, CASE WHEN l_linenumber % 5 <> 0 THEN CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE) + 20 END AS is_matured
FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""

EXPOSURE = f"""(SELECT cob_date, counterparty_id, count(*) AS trade_count, sum(notional) AS total_notional, sum(mtm_value) AS total_mtm, sum(CASE WHEN mtm_value > 0 THEN mtm_value ELSE 0 END) AS positive_mtm,
count(DISTINCT book) AS book_count, count(DISTINCT product_type) AS product_count, min(maturity_date) AS earliest_maturity, max(maturity_date) AS latest_maturity FROM {TRADES} WHERE NOT coalesce(is_matured, false) GROUP BY 1, 2)"""

REFERENCE = versions_sql("SELECT o_custkey, CAST(o_orderdate AS DATE) AS cob_date, max_by(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2", "o_custkey", "o_orderpriority")


def trades(spark, d, batch: bool = False):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("cob_date"))
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice", "l_shipdate")
    price, line = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_linenumber")
    ship = F.when(line % 5 != 0, F.to_date("l_shipdate"))
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "cob_date", F.col("o_custkey").alias("counterparty_id"), F.col("l_returnflag").alias("book"), F.col("l_linestatus").alias("product_type"), price.alias("notional"),
        F.when(line % 7 == 0, None).when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("mtm_value"), ship.alias("maturity_date"), C.is_matured(ship, F.date_add("cob_date", 20)).alias("is_matured"),
        *([F.concat(F.lit("b"), (F.col("o_orderkey") % 7).cast("string")).alias("source_batch_id")] if batch else []),
    )


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@query(f"""WITH v AS ({REFERENCE}), s AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS cob_date, o_custkey FROM orders WHERE o_orderkey % 3 <> 0)
SELECT e.cob_date, counterparty_id, trade_count, CAST(total_notional AS DOUBLE) AS total_notional, CAST(total_mtm AS DOUBLE) AS total_mtm, CAST(positive_mtm AS DOUBLE) AS positive_mtm, book_count, product_count, earliest_maturity, latest_maturity,
o_orderpriority, effective_from AS reference_effective_from, s.o_custkey IS NULL AS reference_carried_forward
FROM {EXPOSURE} e LEFT JOIN v ON v.o_custkey = counterparty_id AND e.cob_date BETWEEN effective_from AND effective_to LEFT JOIN s ON s.cob_date = e.cob_date AND s.o_custkey = counterparty_id""")
def as_of_join_exposure(spark, d):
    o = t(spark, d, "orders").where("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_custkey").alias("counterparty_id"), F.to_date("o_orderdate").alias("cob_date"), "o_orderpriority")
    daily = o.groupBy("counterparty_id", "cob_date").agg(F.max_by("o_orderpriority", "o_orderkey").alias("o_orderpriority"))
    reference = scd2.versions(daily, ["counterparty_id"], ["o_orderpriority"])
    out = marts.counterparty_exposure(trades(spark, d), reference, daily, carry=["o_orderpriority"])
    return _doubles(out, "total_notional", "total_mtm", "positive_mtm")


GRADE = "CASE o_orderkey % 23 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(C.RATINGS)) + " ELSE 'WR' END"
RATED = versions_sql(f"SELECT o_custkey, o_orderkey % 3 AS agency, CAST(o_orderdate AS DATE) AS cob_date, max_by({GRADE}, o_orderkey) AS rating FROM orders GROUP BY 1, 2, 3", "o_custkey, agency", "rating")
BATCHES = TRADES.replace("CASE WHEN l_linenumber % 7 = 0 THEN NULL", "'b' || CAST(o_orderkey % 7 AS VARCHAR) AS source_batch_id, CASE WHEN l_linenumber % 7 = 0 THEN NULL", 1)


@query(f"""WITH x AS (SELECT cob_date, counterparty_id, count(*) AS trade_count, max(source_batch_id) AS source_batch_id FROM {BATCHES} WHERE NOT coalesce(is_matured, false) GROUP BY 1, 2), r AS (SELECT *, CAST({RANK_SQL} AS INTEGER) AS rk, {IG_SQL} AS band FROM ({RATED})),
w AS (SELECT x.cob_date, counterparty_id, max(rk) AS worst, min(CASE WHEN band = 'INVESTMENT_GRADE' THEN 1 ELSE 0 END) AS ig, max(effective_from) AS since FROM x JOIN r ON o_custkey = counterparty_id AND x.cob_date BETWEEN effective_from AND effective_to GROUP BY 1, 2)
SELECT x.cob_date, x.counterparty_id, trade_count, source_batch_id, worst AS worst_rating_rank, since AS rating_effective_from, ig = 1 AS is_investment_grade FROM x LEFT JOIN w ON w.cob_date = x.cob_date AND w.counterparty_id = x.counterparty_id""")
def worst_rating(spark, d):
    """The exposure mart with ratings of three agencies as they were on the date, some unranked."""
    o = t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("counterparty_id"), F.to_date("o_orderdate").alias("cob_date"), "o_orderpriority")
    rating = F.element_at(F.array(*map(F.lit, (*C.RATINGS, "WR"))), (F.col("o_orderkey") % 23 + 1).cast("int"))
    daily = o.groupBy("counterparty_id", (F.col("o_orderkey") % 3).alias("agency"), "cob_date").agg(F.max_by(rating, "o_orderkey").alias("rating"))
    ratings = scd2.versions(daily, ["counterparty_id", "agency"], ["rating"]).withColumns({"rating_rank": C.rating_rank("rating"), "grade_band": C.grade_band("rating")})
    days = o.groupBy("counterparty_id", "cob_date").agg(F.max_by("o_orderpriority", "o_orderkey").alias("o_orderpriority"))
    out = marts.counterparty_exposure(trades(spark, d, batch=True), scd2.versions(days, ["counterparty_id"], ["o_orderpriority"]), days, ratings, carry=["o_orderpriority"])
    return out.select("cob_date", "counterparty_id", "trade_count", "source_batch_id", "worst_rating_rank", "rating_effective_from", "is_investment_grade")


@query(f"""WITH s AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS cob_date, o_custkey FROM orders WHERE o_orderkey % 3 <> 0)
SELECT e.cob_date, count(*) AS n_rows, count(*) FILTER (WHERE s.o_custkey IS NULL) AS carried FROM {EXPOSURE} e LEFT JOIN s ON s.cob_date = e.cob_date AND s.o_custkey = e.counterparty_id GROUP BY 1""")
def carried_forward_flag(spark, d):
    seen = t(spark, d, "orders").where("o_orderkey % 3 <> 0").select(F.to_date("o_orderdate").alias("cob_date"), F.col("o_custkey").alias("counterparty_id")).dropDuplicates().withColumn("seen", F.lit(True))
    e = marts.exposure(trades(spark, d)).select("cob_date", "counterparty_id")
    return e.join(seen, ["cob_date", "counterparty_id"], "left").groupBy("cob_date").agg(F.count("*").alias("n_rows"), F.count_if(F.col("seen").isNull()).alias("carried"))


@query(f"""SELECT cob_date, country_code, count(DISTINCT counterparty_id) AS counterparty_count, CAST(sum(trade_count) AS BIGINT) AS trade_count, CAST(sum(total_notional) AS DOUBLE) AS total_notional, CAST(sum(total_mtm) AS DOUBLE) AS total_mtm, CAST(sum(positive_mtm) AS DOUBLE) AS positive_mtm,
CAST(sum(CASE WHEN total_mtm < 0 THEN total_mtm ELSE 0 END) AS DOUBLE) AS negative_mtm, count(DISTINCT CASE WHEN total_mtm > 0 THEN counterparty_id END) AS positive_counterparties FROM (
SELECT e.*, coalesce(CASE WHEN n_nationkey % 5 <> 0 THEN n_name END, 'UNKNOWN') AS country_code FROM {EXPOSURE} e JOIN customer ON c_custkey = counterparty_id LEFT JOIN nation ON n_nationkey = c_nationkey) GROUP BY 1, 2""")
def exposure_by_nation(spark, d):
    n = t(spark, d, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name")).alias("country_code"))
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("counterparty_id"), "c_nationkey").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left")  # nations are some hundred rows at any scale
    e = marts.exposure(trades(spark, d)).join(c.select("counterparty_id", "country_code"), "counterparty_id")
    return _doubles(marts.by_country(e), "total_notional", "total_mtm", "positive_mtm", "negative_mtm")


@query("SELECT o_orderpriority AS currency, count(*) AS position_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS active_position_count FROM orders GROUP BY 1")
def position_summary(spark, d):
    p = t(spark, d, "orders").select(F.col("o_orderpriority").alias("currency"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), (F.col("o_orderstatus") == "O").alias("is_active"))
    return _doubles(marts.summary(p), "total_amount")


NATION_DAYS = """e AS (SELECT CAST(o_orderdate AS DATE) AS cob_date, c_nationkey AS k, sum(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS mtm, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS notional, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
d AS (SELECT DISTINCT cob_date FROM e), me AS (SELECT max(cob_date) AS m FROM d GROUP BY date_trunc('month', cob_date)), pr AS (SELECT cob_date, lag(cob_date) OVER (ORDER BY cob_date) AS prior, (SELECT max(m) FROM me WHERE m < d.cob_date) AS month_end FROM d),
ks AS (SELECT pr.cob_date, prior, month_end, k FROM e JOIN pr USING (cob_date) UNION ALL SELECT pr.cob_date, prior, month_end, e.k FROM e JOIN pr ON e.cob_date = pr.prior WHERE NOT EXISTS (SELECT 1 FROM e x WHERE x.cob_date = pr.cob_date AND x.k = e.k))"""


def nation_days(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("cob_date"))
    c = t(spark, d, "customer").select("c_custkey", "c_nationkey")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    e = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("cob_date", F.col("c_nationkey").alias("counterparty_id"))
    return e.agg(F.sum(F.when(F.col("o_orderkey") % 11 != 0, price)).alias("total_mtm"), F.sum(price).alias("total_notional"), F.count("*").alias("trade_count"))


@query(f"""WITH {NATION_DAYS} SELECT ks.cob_date, ks.k AS counterparty_id, ks.prior AS prior_cob_date, ks.month_end AS prior_month_end, CAST(c.mtm AS DOUBLE) AS total_mtm, CAST(p.mtm AS DOUBLE) AS prior_total_mtm,
CAST((CASE WHEN c.k IS NULL THEN 0 ELSE c.mtm END) - coalesce(p.mtm, 0) AS DOUBLE) AS mtm_change,
CAST((CASE WHEN c.k IS NULL THEN 0 ELSE c.notional END) - coalesce(p.notional, 0) AS DOUBLE) AS notional_change, CAST((CASE WHEN c.k IS NULL THEN 0 ELSE c.n END) - coalesce(p.n, 0) AS BIGINT) AS trade_count_change, CAST(m.mtm AS DOUBLE) AS month_end_mtm,
CASE WHEN p.mtm <> 0 THEN CAST((CASE WHEN c.k IS NULL THEN 0 ELSE c.mtm END) - p.mtm AS DOUBLE) / CAST(abs(p.mtm) AS DOUBLE) END AS mtm_change_pct, CAST((CASE WHEN c.k IS NULL THEN 0 ELSE c.mtm END) - coalesce(m.mtm, 0) AS DOUBLE) AS month_end_change,
CASE WHEN p.k IS NULL THEN 'NEW' WHEN c.k IS NULL THEN 'REMOVED' WHEN abs(coalesce(c.mtm, 0) - coalesce(p.mtm, 0)) > 200000 THEN 'MATERIAL_CHANGE' WHEN c.mtm IS DISTINCT FROM p.mtm THEN 'CHANGED' ELSE 'UNCHANGED' END AS change_category
FROM ks LEFT JOIN e c ON c.cob_date = ks.cob_date AND c.k = ks.k LEFT JOIN e p ON p.cob_date = ks.prior AND p.k = ks.k LEFT JOIN e m ON m.cob_date = ks.month_end AND m.k = ks.k""")
def exposure_change_daily(spark, d):
    out = marts.exposure_change(nation_days(spark, d), threshold=200_000)
    return _doubles(out, "total_mtm", "prior_total_mtm", "mtm_change", "notional_change", "month_end_mtm", "month_end_change").withColumn("trade_count_change", F.col("trade_count_change").cast("long"))


NULL_DAYS = NATION_DAYS.replace("c_nationkey AS k", "CASE WHEN c_nationkey % 6 <> 0 THEN c_nationkey END AS k").replace("x.k = e.k", "x.k IS NOT DISTINCT FROM e.k")


@query(f"""WITH {NULL_DAYS} SELECT ks.cob_date, ks.k AS counterparty_id, CAST(c.mtm AS DOUBLE) AS total_mtm, CAST(p.mtm AS DOUBLE) AS prior_total_mtm,
CASE WHEN p.cob_date IS NULL THEN 'NEW' WHEN c.cob_date IS NULL THEN 'REMOVED' WHEN abs(coalesce(c.mtm, 0) - coalesce(p.mtm, 0)) > 200000 THEN 'MATERIAL_CHANGE' WHEN c.mtm IS DISTINCT FROM p.mtm THEN 'CHANGED' ELSE 'UNCHANGED' END AS change_category
FROM ks LEFT JOIN e c ON c.cob_date = ks.cob_date AND c.k IS NOT DISTINCT FROM ks.k LEFT JOIN e p ON p.cob_date = ks.prior AND p.k IS NOT DISTINCT FROM ks.k""")
def exposure_change_null_keys(spark, d):
    """The change mart where counterparties may be NULL: they are one key like any other."""
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("cob_date"))
    c = t(spark, d, "customer").select("c_custkey", F.when(F.col("c_nationkey") % 6 != 0, F.col("c_nationkey")).alias("counterparty_id"))
    price = F.col("o_totalprice").cast("decimal(18,2)")
    e = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("cob_date", "counterparty_id").agg(F.sum(F.when(F.col("o_orderkey") % 11 != 0, price)).alias("total_mtm"), F.sum(price).alias("total_notional"), F.count("*").alias("trade_count"))
    return _doubles(marts.exposure_change(e, threshold=200_000).select("cob_date", "counterparty_id", "total_mtm", "prior_total_mtm", "change_category"), "total_mtm", "prior_total_mtm")


@query(f"""WITH {NATION_DAYS} SELECT ks.cob_date, ks.k AS counterparty_id FROM ks WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.cob_date = ks.cob_date AND e.k = ks.k)""")
def exposure_removed(spark, d):
    return marts.exposure_change(nation_days(spark, d)).where("change_category = 'REMOVED'").select("cob_date", "counterparty_id")


@query(f"""WITH {NATION_DAYS} SELECT cob_date, prior AS prior_cob_date, month_end AS prior_month_end FROM pr""")
def date_pairs(spark, d):
    return marts.date_pairs(nation_days(spark, d).select("cob_date"))


# ---------------------------------------------------------------- quality

CHECKS = ["not_null", "not_empty", "accepted_values", "accepted_range", "relationships", "unique_combination"]


@query("""SELECT 'not_null' AS check_name, (SELECT count(*) FROM orders WHERE nullif(o_orderstatus, 'P') IS NULL) AS failures, 'warn' AS outcome
UNION ALL SELECT 'accepted_values', (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')), CASE WHEN (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')) = 0 THEN 'pass' ELSE 'fail' END
UNION ALL SELECT 'relationships', (SELECT count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderkey % 50 <> 0)), 'fail'
UNION ALL SELECT 'unique', (SELECT count(*) FROM (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)), CASE WHEN (SELECT count(*) FROM (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)) = 0 THEN 'pass' ELSE 'fail' END
UNION ALL SELECT 'range', (SELECT count(*) FROM lineitem WHERE l_quantity < 2 OR l_quantity > 49), 'fail'
UNION ALL SELECT 'not_empty', (SELECT count(*) FROM customer WHERE trim(c_name) = ''), 'pass'""")
def dq_checks(spark, d):
    o, li, c = t(spark, d, "orders"), t(spark, d, "lineitem"), t(spark, d, "customer")
    found = quality.run_checks([
        quality.Check("not_null", lambda: quality.not_null(o.withColumn("s", F.nullif("o_orderstatus", F.lit("P"))), "s"), "warn"),
        quality.Check("accepted_values", lambda: quality.accepted_values(o, "o_orderstatus", ["O", "F"])),
        quality.Check("relationships", lambda: quality.relationships(li, "l_orderkey", o.where("o_orderkey % 50 <> 0"), "o_orderkey")),
        quality.Check("unique", lambda: quality.unique_combination(li, ["l_orderkey", "l_partkey"])),
        quality.Check("range", lambda: quality.accepted_range(li, "l_quantity", 2, 49)),
        quality.Check("not_empty", lambda: quality.not_empty(c, "c_name")),
    ])
    return found.select("check_name", "failures", "outcome")


@query(f"""WITH v AS ({CUSTOMER_VERSIONS}), w AS (SELECT o_custkey, effective_from, CASE WHEN o_custkey % 13 = 0 THEN effective_to + 1 WHEN o_custkey % 17 = 0 THEN effective_to - 1 ELSE effective_to END AS effective_to, is_current FROM v WHERE effective_to < DATE '9999-12-31'),
x AS (SELECT *, lead(effective_from) OVER (PARTITION BY o_custkey ORDER BY effective_from) AS nxt FROM w) SELECT o_custkey, effective_from, CASE WHEN effective_to < effective_from THEN 'inverted' WHEN nxt <= effective_to THEN 'overlap' WHEN nxt > effective_to + 1 THEN 'gap' END AS flaw FROM x
WHERE effective_to < effective_from OR nxt <= effective_to OR nxt > effective_to + 1
UNION ALL SELECT o_custkey, max(effective_from), 'not one current' FROM w GROUP BY o_custkey HAVING count(*) FILTER (WHERE is_current) <> 1""")
def dq_mutually_exclusive(spark, d):
    v = _customer_versions(spark, d).where("effective_to < DATE '9999-12-31'")
    k = F.col("o_custkey")
    moved = v.withColumn("effective_to", F.when(k % 13 == 0, F.date_add("effective_to", 1)).when(k % 17 == 0, F.date_sub("effective_to", 1)).otherwise(F.col("effective_to")))
    return quality.mutually_exclusive(moved, ["o_custkey"])


@query("SELECT p_brand, p_size, side FROM (SELECT p_brand, p_size, 'left' AS side FROM (SELECT p_brand, p_size FROM part EXCEPT ALL SELECT p_brand, CASE WHEN p_partkey % 9 = 0 THEN p_size + 1 ELSE p_size END FROM part) UNION ALL SELECT p_brand, p_size, 'right' FROM (SELECT p_brand, CASE WHEN p_partkey % 9 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM part EXCEPT ALL SELECT p_brand, p_size FROM part))")
def dq_equality(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    return quality.equality(p, p.withColumn("p_size", F.when(F.col("p_partkey") % 9 == 0, F.col("p_size") + 1).otherwise(F.col("p_size"))), ["p_brand", "p_size"])


@query(f"""WITH {NATION_DAYS}, gone AS (SELECT cob_date, k FROM ks WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.cob_date = ks.cob_date AND e.k = ks.k))
SELECT flaw, count(*) AS n_flaws FROM (SELECT 'still there' AS flaw FROM e WHERE k % 7 = 1 UNION ALL SELECT 'not reported' FROM gone WHERE k % 5 = 0 AND k % 7 <> 1) GROUP BY flaw""")
def dq_removed_matches(spark, d):
    """A change mart that was tampered with: some removals are missing, some are told that aren't."""
    e, k = nation_days(spark, d), F.col("counterparty_id")
    wrong = F.when(k % 7 == 1, "REMOVED").when((F.col("change_category") == "REMOVED") & (k % 5 == 0), "CHANGED").otherwise(F.col("change_category"))
    changed = marts.exposure_change(e).withColumn("change_category", wrong)
    return quality.removed_matches_disappearance(changed, e, marts.date_pairs(e), "counterparty_id").groupBy("flaw").agg(F.count("*").alias("n_flaws"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_totalprice IS NULL OR o_totalprice < 0) AS bad_amounts, count(*) FILTER (WHERE o_orderstatus = 'P') AS pending, CAST(count(*) - count(DISTINCT o_custkey) AS BIGINT) AS repeated FROM orders")
def audit_gate(spark, d):
    return t(spark, d, "orders").agg(F.count("*").alias("n_rows"), F.count_if(F.col("o_totalprice").isNull() | (F.col("o_totalprice") < 0)).alias("bad_amounts"), F.count_if(F.col("o_orderstatus") == "P").alias("pending"), (F.count("*") - F.count_distinct("o_custkey")).alias("repeated"))


# ---------------------------------------------------------------- reconciliation


def _both_sides(spark, d):
    """Ours, and a legacy side that lacks some keys, has others more, and differs in some values."""
    new = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    k = F.col("o_orderkey")
    legacy = new.where(k % 23 != 0).withColumn("o_totalprice", F.when(k % 19 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return legacy, new.where(k % 29 != 0)


LEGACY = "(SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END AS o_totalprice FROM orders WHERE o_orderkey % 23 <> 0)"
OURS = "(SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders WHERE o_orderkey % 29 <> 0)"


@query(f"SELECT (SELECT count(*) FROM {LEGACY}) AS legacy_rows, (SELECT count(*) FROM {OURS}) AS new_rows, CASE WHEN (SELECT count(*) FROM {LEGACY}) = (SELECT count(*) FROM {OURS}) THEN 'PASS' ELSE 'FAIL' END AS outcome")
def recon_row_count(spark, d):
    return reconcile.row_count(*_both_sides(spark, d))


@query(f"SELECT count(*) FILTER (WHERE n.o_orderkey IS NULL) AS legacy_only, count(*) FILTER (WHERE l.o_orderkey IS NULL) AS new_only, 'FAIL' AS outcome FROM {LEGACY} l FULL JOIN {OURS} n ON l.o_orderkey = n.o_orderkey")
def recon_key_set(spark, d):
    return reconcile.key_set(reconcile.compare_rows(*_both_sides(spark, d), ["o_orderkey"], ["o_orderstatus", "o_totalprice"]))


@query(f"SELECT coalesce(l.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN n.o_orderkey IS NULL THEN 'legacy_only' WHEN l.o_orderkey IS NULL THEN 'new_only' WHEN l.o_orderstatus <> n.o_orderstatus OR l.o_totalprice <> n.o_totalprice THEN 'changed' ELSE 'equal' END AS status FROM {LEGACY} l FULL JOIN {OURS} n ON l.o_orderkey = n.o_orderkey")
def recon_row_hash(spark, d):
    return reconcile.compare_rows(*_both_sides(spark, d), ["o_orderkey"], ["o_orderstatus", "o_totalprice"]).select(F.col("o_orderkey").try_cast("double").cast("long").alias("o_orderkey"), "status")


@query(f"""SELECT f AS function, c AS column_name, l AS legacy_value, n AS new_value, CASE WHEN l = n OR abs(l - n) <= 5 OR abs(l - n) / (CASE WHEN l = 0 THEN 1 ELSE abs(l) END) <= 0.005 THEN 'PASS' ELSE 'FAIL' END AS outcome FROM (
SELECT 'count_distinct' AS f, 'o_orderstatus' AS c, CAST((SELECT count(DISTINCT o_orderstatus) FROM {LEGACY}) AS DOUBLE) AS l, CAST((SELECT count(DISTINCT o_orderstatus) FROM {OURS}) AS DOUBLE) AS n
UNION ALL SELECT 'max', 'o_totalprice', (SELECT CAST(max(o_totalprice) AS DOUBLE) FROM {LEGACY}), (SELECT CAST(max(o_totalprice) AS DOUBLE) FROM {OURS})
UNION ALL SELECT 'count', 'o_orderkey', (SELECT CAST(count(o_orderkey) AS DOUBLE) FROM {LEGACY}), (SELECT CAST(count(o_orderkey) AS DOUBLE) FROM {OURS}))""")
def recon_aggregate(spark, d):
    return reconcile.aggregate_pairs(*_both_sides(spark, d), [("count_distinct", "o_orderstatus"), ("max", "o_totalprice"), ("count", "o_orderkey")], 5.0, 0.005)


OUTCOME = "CASE WHEN event_id % 97 = 0 THEN 'FAIL' WHEN event_id % 11 = 0 THEN 'WARN' ELSE 'PASS' END"


@query(f"SELECT coalesce(max_by(o, CASE o WHEN 'FAIL' THEN 4 WHEN 'ERROR' THEN 3 WHEN 'WARN' THEN 2 ELSE 1 END), 'ERROR') AS outcome FROM (SELECT {OUTCOME} AS o FROM events)")
def worst_outcome(spark, d):
    return reconcile.worst_outcome(t(spark, d, "events").select(F.expr(OUTCOME).alias("outcome")))


@query(f"""WITH l AS (SELECT CAST(ts AS DATE) AS b, max_by({OUTCOME}, event_id) AS o FROM events GROUP BY 1), r AS (SELECT *, sum(CASE WHEN o IN ('PASS', 'WARN') THEN 0 ELSE 1 END) OVER (ORDER BY b DESC) AS bad FROM l)
SELECT count(*) FILTER (WHERE bad = 0) AS streak, max(b) AS latest_date, CASE WHEN max(b) IS NULL THEN 'NOT_STARTED' WHEN count(*) FILTER (WHERE bad = 0) >= 10 THEN 'READY' ELSE 'NOT_READY' END AS status FROM r""")
def acceptance_streak(spark, d):
    e = t(spark, d, "events").select(F.to_date("ts").alias("business_date"), F.expr(OUTCOME).alias("outcome"), F.col("event_id").alias("executed_at"))
    return reconcile.acceptance(e, 10, allow_warn=True)


@query(f"SELECT coalesce(r.cob_date, p.cob_date) AS cob_date, coalesce(raw_rows, 0) AS raw_rows, coalesce(prepared_rows, 0) AS prepared_rows FROM (SELECT _cob_date AS cob_date, count(*) AS raw_rows FROM {RAW} GROUP BY 1) r FULL JOIN (SELECT _cob_date AS cob_date, count(*) AS prepared_rows FROM ({DEDUPE}) WHERE o_custkey % 2 = 0 GROUP BY 1) p ON r.cob_date = p.cob_date")
def full_outer_recon(spark, d):
    raw = _raw_orders(spark, d)
    a = raw.groupBy(F.col("_cob_date").alias("cob_date")).agg(F.count("*").alias("raw_rows"))
    b = snapshot.dedupe_latest(raw, ["o_custkey"]).where("o_custkey % 2 = 0").groupBy(F.col("_cob_date").alias("cob_date")).agg(F.count("*").alias("prepared_rows"))
    return a.join(b, "cob_date", "full").select("cob_date", F.coalesce("raw_rows", F.lit(0)).alias("raw_rows"), F.coalesce("prepared_rows", F.lit(0)).alias("prepared_rows"))


# ---------------------------------------------------------------- calendar

DATES = "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS cob_date FROM orders)"
MONTH_ENDS = f"(SELECT m AS cob_date FROM (SELECT max(cob_date) AS m, date_trunc('month', cob_date) AS mo FROM {DATES} GROUP BY 2) WHERE mo < (SELECT max(date_trunc('month', cob_date)) FROM {DATES}))"
KEEP = f"(SELECT * FROM (SELECT cob_date FROM {DATES} ORDER BY cob_date DESC LIMIT 10) UNION SELECT * FROM (SELECT cob_date FROM {MONTH_ENDS} ORDER BY cob_date DESC LIMIT 24))"


def _dates(spark, d):
    return t(spark, d, "orders").select(F.to_date("o_orderdate").alias("cob_date")).distinct()


@query(f"SELECT cob_date FROM {MONTH_ENDS}")
def month_end_dates(spark, d):
    return calendar.month_end_dates(_dates(spark, d))


@query(f"SELECT cob_date FROM {KEEP}")
def keep_set(spark, d):
    return calendar.keep_set(_dates(spark, d), 10, 12, 2)


@query(f"SELECT cob_date FROM {DATES} WHERE cob_date NOT IN (SELECT cob_date FROM {KEEP})")
def expire_set(spark, d):
    return calendar.expire_set(_dates(spark, d), 10, 12, 2)


# A feed is a user's events of one type here, so that all events count and feeds have gaps.
FEEDS = "(SELECT DISTINCT CAST(user_id AS VARCHAR) || '-' || event_type AS feed, CAST(ts AS DATE) AS cob_date FROM events)"


def _feeds(spark, d):
    return t(spark, d, "events").select(F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("feed"), F.to_date("ts").alias("cob_date")).distinct()


EXPECTED = f"x AS (SELECT feed, c.cob_date FROM (SELECT DISTINCT cob_date FROM {FEEDS}) c JOIN (SELECT feed, min(cob_date) AS lo, max(cob_date) AS hi FROM {FEEDS} GROUP BY 1) b ON c.cob_date BETWEEN lo AND hi)"


@query(f"WITH {EXPECTED} SELECT x.feed, CAST(x.cob_date AS VARCHAR) AS missing FROM x ANTI JOIN {FEEDS} f ON f.feed = x.feed AND f.cob_date = x.cob_date")
def gaps_daily(spark, d):
    return calendar.find_gaps(_feeds(spark, d))


@query(f"WITH {EXPECTED}, w AS (SELECT DISTINCT feed, printf('%04d-W%02d', CAST(isoyear(cob_date) AS INTEGER), CAST(weekofyear(cob_date) AS INTEGER)) AS missing FROM x) SELECT w.feed, w.missing FROM w ANTI JOIN (SELECT feed, printf('%04d-W%02d', CAST(isoyear(cob_date) AS INTEGER), CAST(weekofyear(cob_date) AS INTEGER)) AS missing FROM {FEEDS}) f ON f.feed = w.feed AND f.missing = w.missing")
def gaps_weekly(spark, d):
    return calendar.find_gaps(_feeds(spark, d), weekly=F.col("feed").isNotNull())


ARRIVALS = "(SELECT event_type AS feed, CAST(ts AS DATE) AS cob_date, ts + INTERVAL 26 HOUR AS arrived_at FROM events)"


def _arrivals(spark, d):
    return t(spark, d, "events").select(F.col("event_type").alias("feed"), F.to_date("ts").alias("cob_date"), (F.col("ts") + F.expr("INTERVAL 26 HOURS")).alias("arrived_at"))


@query(f"SELECT feed, cob_date, min(arrived_at) AS first_arrival, CAST(cob_date + 1 AS TIMESTAMP) + INTERVAL 6 HOUR AS deadline, min(arrived_at) > CAST(cob_date + 1 AS TIMESTAMP) + INTERVAL 6 HOUR AS is_late FROM {ARRIVALS} GROUP BY 1, 2")
def lateness(spark, d):
    return calendar.lateness(_arrivals(spark, d)).drop("is_bulk")


BULK = "(SELECT CAST(user_id AS VARCHAR) AS feed, CAST(ts AS DATE) AS cob_date, CASE WHEN user_id % 3 = 0 THEN TIMESTAMP '2030-01-01 00:00:00' + INTERVAL (event_id % 600) MINUTE ELSE ts + INTERVAL 26 HOUR END AS arrived_at FROM events)"
LATE = f"(SELECT feed, cob_date, min(arrived_at) AS first_arrival, CAST(cob_date + 1 AS TIMESTAMP) + INTERVAL 6 HOUR AS deadline, min(arrived_at) > CAST(cob_date + 1 AS TIMESTAMP) + INTERVAL 6 HOUR AS is_late FROM {BULK} GROUP BY 1, 2)"


def _bulk_arrivals(spark, d):
    minutes = F.timestamp_add("MINUTE", (F.col("event_id") % 600).cast("int"), F.lit("2030-01-01 00:00:00").cast("timestamp"))
    return t(spark, d, "events").select(F.col("user_id").cast("string").alias("feed"), F.to_date("ts").alias("cob_date"), F.when(F.col("user_id") % 3 == 0, minutes).otherwise(F.col("ts") + F.expr("INTERVAL 26 HOURS")).alias("arrived_at"))


@query(f"SELECT l.*, is_late AND coalesce(n > 1 AND days = 1, false) AS is_bulk FROM {LATE} l LEFT JOIN (SELECT feed AS f, count(*) AS n, count(DISTINCT CAST(first_arrival AS DATE)) AS days FROM {LATE} WHERE is_late GROUP BY 1) b ON f = feed")
def lateness_bulk(spark, d):
    """Every third user's history was loaded at once, late; the others arrive day by day."""
    return calendar.lateness(_bulk_arrivals(spark, d))


@query(f"SELECT feed, cob_date, first_arrival FROM (SELECT *, row_number() OVER (PARTITION BY feed ORDER BY cob_date DESC) AS n FROM {LATE}) WHERE n <= 3")
def first_arrivals(spark, d):
    return calendar.first_arrivals(_bulk_arrivals(spark, d), 3)


STATUS = """(WITH f AS (SELECT CAST(user_id AS VARCHAR) AS feed, CAST(ts AS DATE) AS cob_date, bool_or(event_id % 5 = 0) AS c, bool_or(event_id % 3 = 0) AS dl, bool_or(event_id % 7 = 0) AS fl, bool_or(event_id % 2 = 0) AS r FROM events GROUP BY 1, 2)
SELECT feed, cob_date, CASE WHEN day(cob_date) % 6 = 0 THEN 'NOT_EXPECTED' WHEN c THEN 'COMPLETE' WHEN dl THEN 'PROCESSING' WHEN fl THEN 'FAILED' WHEN r THEN 'RECEIVED' WHEN TIMESTAMP '2024-01-15 00:00:00' > CAST(cob_date + 1 AS TIMESTAMP) + INTERVAL 6 HOUR THEN 'MISSING' ELSE 'WAITING' END AS status FROM f)"""


@query(f"SELECT feed, cob_date, status FROM {STATUS}")
def feed_status(spark, d):
    e = t(spark, d, "events").select("event_id", F.col("user_id").cast("string").alias("feed"), F.to_date("ts").alias("cob_date"))
    part = lambda n: e.where(F.col("event_id") % n == 0)
    expected = e.select("feed", "cob_date", (F.dayofmonth("cob_date") % 6 != 0).alias("is_expected")).distinct()
    return calendar.feed_status(expected, part(2), part(3), part(5), part(7), "2024-01-15 00:00:00")


@query(f"SELECT cob_date, status, count(*) AS feeds FROM {STATUS} GROUP BY 1, 2")
def status_summary(spark, d):
    return calendar.status_summary(feed_status(spark, d))


@query("""SELECT source, newest, date_diff('microsecond', newest, TIMESTAMP '2024-02-01 00:00:00') / 3.6e9::DOUBLE AS age_hours, CASE WHEN date_diff('microsecond', newest, TIMESTAMP '2024-02-01 00:00:00') / 3.6e9::DOUBLE > CASE WHEN source = 'view' THEN 240 ELSE 50 END THEN 'error'
WHEN date_diff('microsecond', newest, TIMESTAMP '2024-02-01 00:00:00') / 3.6e9::DOUBLE > CASE WHEN source = 'view' THEN 72 ELSE 26 END THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT source, max(ts) AS newest FROM (SELECT event_type AS source, ts FROM events UNION ALL SELECT 'old-' || event_type, ts - INTERVAL 30 DAY FROM events) GROUP BY 1)""")
def source_freshness(spark, d):
    e = t(spark, d, "events").select(F.col("event_type").alias("source"), "ts")
    both = e.unionByName(e.select(F.concat(F.lit("old-"), "source").alias("source"), (F.col("ts") - F.expr("INTERVAL 30 DAYS")).alias("ts")))
    return calendar.freshness(both, "ts", "2024-02-01 00:00:00", {"view": (72, 240)})


# The same over all events: a feed is an event type and a bucket of users, so no event is left out.

ALL_FEEDS = "(SELECT DISTINCT event_type || '-' || CAST(user_id % 40 AS VARCHAR) AS feed, CAST(ts AS DATE) AS cob_date FROM events)"
ALL_EXPECTED = f"x AS (SELECT feed, c.cob_date FROM (SELECT DISTINCT cob_date FROM {ALL_FEEDS}) c JOIN (SELECT feed, min(cob_date) AS lo, max(cob_date) AS hi FROM {ALL_FEEDS} GROUP BY 1) b ON c.cob_date BETWEEN lo AND hi)"


def _all_events(spark, d):
    return t(spark, d, "events").select("event_id", F.concat_ws("-", "event_type", (F.col("user_id") % 40).cast("string")).alias("feed"), F.to_date("ts").alias("cob_date"))


@query(f"WITH {ALL_EXPECTED} SELECT feed, CAST(cob_date AS VARCHAR) AS missing FROM x WHERE NOT EXISTS (SELECT 1 FROM {ALL_FEEDS} f WHERE f.feed = x.feed AND f.cob_date = x.cob_date)")
def gaps_daily_all(spark, d):
    return calendar.find_gaps(_all_events(spark, d))


@query(f"WITH {ALL_EXPECTED}, w AS (SELECT DISTINCT feed, printf('%04d-W%02d', CAST(isoyear(cob_date) AS INTEGER), CAST(weekofyear(cob_date) AS INTEGER)) AS missing FROM x) SELECT feed, missing FROM w WHERE (feed, missing) NOT IN (SELECT feed, printf('%04d-W%02d', CAST(isoyear(cob_date) AS INTEGER), CAST(weekofyear(cob_date) AS INTEGER)) FROM {ALL_FEEDS})")
def gaps_weekly_all(spark, d):
    feeds = _all_events(spark, d).select("feed", "cob_date").distinct()
    return calendar.find_gaps(feeds, weekly=tuple(sorted(r[0] for r in feeds.select("feed").distinct().collect())))


@query("""WITH f AS (SELECT event_type || '-' || CAST(user_id % 40 AS VARCHAR) AS feed, CAST(ts AS DATE) AS cob_date, bool_or(event_id % 5 = 0) AS c, bool_or(event_id % 3 = 0) AS dl, bool_or(event_id % 7 = 0) AS fl, bool_or(event_id % 2 = 0) AS r FROM events GROUP BY 1, 2)
SELECT feed, cob_date, CASE WHEN day(cob_date) % 6 = 0 THEN 'NOT_EXPECTED' WHEN c THEN 'COMPLETE' WHEN dl THEN 'PROCESSING' WHEN fl THEN 'FAILED' WHEN r THEN 'RECEIVED' WHEN TIMESTAMP '2024-01-15 00:00:00' > CAST(cob_date + 1 AS TIMESTAMP) + INTERVAL 6 HOUR THEN 'MISSING' ELSE 'WAITING' END AS status FROM f""")
def feed_status_all(spark, d):
    e = _all_events(spark, d)
    part = lambda n: e.where(F.col("event_id") % n == 0)
    expected = e.select("feed", "cob_date", (F.dayofmonth("cob_date") % 6 != 0).alias("is_expected")).distinct()
    return calendar.feed_status(expected, part(2), part(3), part(5), part(7), "2024-01-15 00:00:00")


@query("SELECT CAST(o_orderdate AS DATE) AS cob_date, o_orderkey AS delivery_id FROM orders WHERE o_orderkey % 3 <> 0 AND CAST(o_orderdate AS DATE) IN (SELECT cob_date FROM " + KEEP + ")")
def pending_manifests(spark, d):
    m = t(spark, d, "orders").select(F.to_date("o_orderdate").alias("cob_date"), F.col("o_orderkey").alias("delivery_id"))
    return calendar.pending(m, m.where("delivery_id % 3 = 0"), calendar.keep_set(m.select("cob_date").distinct(), 10, 12, 2)).select("cob_date", "delivery_id")


# ---------------------------------------------------------------- registry-like operators


@query("SELECT user_id, event_type, ts, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_state_per_key(spark, d):
    return calendar.latest_per_key(t(spark, d, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "ts", "event_id")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20")
def topk_recent(spark, d):
    return t(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(20)


@query("SELECT coalesce(a.k, b.k) AS delivery_id, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'unchanged' END AS status FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderkey % 3 <> 0) a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderkey % 4 <> 0) b ON a.k = b.k")
def input_diff(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("delivery_id"))
    return publish.input_diff(o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 4 <> 0"), ["delivery_id"])


@query("SELECT 'orders' AS model, o_custkey AS delivery_id, max(CAST(o_orderdate AS DATE)) AS max_cob_date FROM orders GROUP BY 2 UNION ALL SELECT 'shipments', l_suppkey, max(CAST(l_shipdate AS DATE)) FROM lineitem GROUP BY 2")
def input_sets(spark, d):
    return publish.input_set({"orders": t(spark, d, "orders").select(F.col("o_custkey").alias("delivery_id"), F.to_date("o_orderdate").alias("cob_date")), "shipments": t(spark, d, "lineitem").select(F.col("l_suppkey").alias("delivery_id"), F.to_date("l_shipdate").alias("cob_date"))})


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, count(*) AS n_rows, count(DISTINCT {c}) = count(*) AS is_key FROM part" for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")))
def key_candidates(spark, d):
    return delivery.key_statistics(t(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))


@query("SELECT o_orderkey, count(l_orderkey) AS part_count FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber > 1 GROUP BY 1")
def parts_per_delivery(spark, d):
    n = t(spark, d, "lineitem").where("l_linenumber > 1").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return t(spark, d, "orders").select("o_orderkey").join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("n", F.lit(0)).alias("part_count"))


@query("""WITH r AS (SELECT user_id AS transport_id, event_type AS s, event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 0 END AS k FROM events)
SELECT transport_id, arg_max(s, CAST(k AS BIGINT) * 1000000000 + event_id) AS status FROM r GROUP BY 1""")
def receipt_stage(spark, d):
    e = t(spark, d, "events").select(F.col("user_id").alias("transport_id"), F.col("event_type").alias("status"), F.col("event_id").alias("occurred_at"))
    ranks = {"view": 1, "click": 2, "purchase": 3}
    others = {r[0]: 0 for r in e.select("status").distinct().collect() if r[0] not in ranks}  # event types are a handful
    return calendar.receipt_state(e, ranks | others)


RECEIPTS = "(SELECT user_id AS transport_id, event_id, CASE WHEN event_id % 5 = 0 THEN 'FAILED' WHEN event_id % 3 = 0 THEN 'DISCOVERED' WHEN event_id % 3 = 1 THEN 'LANDED' ELSE 'INGESTED' END AS s, CASE WHEN event_id % 5 = 0 THEN -1 ELSE event_id % 3 END AS k FROM events)"


@query(f"""WITH r AS {RECEIPTS}, f AS (SELECT transport_id, max(event_id) FILTER (WHERE s = 'FAILED') AS f FROM r GROUP BY 1)
SELECT transport_id, coalesce(arg_max(s, k * 1000000000 + event_id) FILTER (WHERE s <> 'FAILED' AND event_id > coalesce(f, -1)), 'FAILED') AS status FROM r JOIN f USING (transport_id) GROUP BY 1""")
def receipt_after_failure(spark, d):
    """Receipts with failures between: the last failure starts the stages anew."""
    e = F.col("event_id")
    status = F.when(e % 5 == 0, "FAILED").when(e % 3 == 0, "DISCOVERED").when(e % 3 == 1, "LANDED").otherwise("INGESTED")
    events = t(spark, d, "events").select(F.col("user_id").alias("transport_id"), status.alias("status"), e.alias("occurred_at"))
    return calendar.receipt_state(events, {"DISCOVERED": 0, "LANDED": 1, "INGESTED": 2})


@query("SELECT o_custkey AS delivery_id, max(CAST(o_orderdate AS DATE)) AS cob_date, max(1 + o_orderkey % 2) AS version, count(*) AS n_rows FROM orders GROUP BY 1")
def committed_rows(spark, d):
    return raw_ingest.committed(_raw_orders(spark, d).withColumn("_delivery_id", F.col("o_custkey")))


@query(f"SELECT _row_number, o_totalprice FROM {RAW} WHERE _cob_date = (SELECT max(_cob_date) FROM {RAW}) AND o_custkey % 2 = 0")
def checkpoint_filter(spark, d):
    raw = _raw_orders(spark, d)
    newest = raw.agg(F.max("_cob_date")).first()[0]
    tagged = raw.withColumn("_delivery_id", F.when(F.col("o_custkey") % 2 == 0, "even").otherwise("odd"))
    return raw_ingest.checkpoint(tagged, newest, "even").select("_row_number", "o_totalprice")


@query("SELECT 'orders' AS model, o_custkey AS delivery_id, c_mktsegment AS feed, CAST(c_custkey % 28 + 1 AS INTEGER) AS cob_date FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 <> 0) ON c_custkey = o_custkey")
def registered_inputs(spark, d):
    """Inputs with their delivery, where some aren't registered."""
    inputs = t(spark, d, "orders").select(F.lit("orders").alias("model"), F.col("o_custkey").alias("delivery_id")).distinct()
    known = t(spark, d, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("delivery_id"), F.col("c_mktsegment").alias("feed"), (F.col("c_custkey") % 28 + 1).cast("int").alias("cob_date"))
    return registry.registered(inputs, known)


@query("SELECT o_custkey AS delivery_id, CASE WHEN c_custkey IS NULL THEN 'unregistered' WHEN c_custkey % 28 = 3 THEN 'on_date' ELSE 'off_date' END AS standing FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 <> 0) ON c_custkey = o_custkey")
def changed_input_standing(spark, d):
    moved = t(spark, d, "orders").select(F.col("o_custkey").alias("delivery_id")).distinct()
    known = t(spark, d, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("delivery_id"), (F.col("c_custkey") % 28).alias("cob_date"))
    return registry.standing(moved, known, 3)


@query("SELECT o_orderpriority AS report, CAST(o_orderdate AS DATE) AS as_at, CAST(1 + o_orderkey % 3 AS INTEGER) AS version, 'lines' AS model, l_suppkey AS delivery_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def behind_versions(spark, d):
    """The deliveries behind each version, through the run that made it."""
    versions = t(spark, d, "orders").select(F.col("o_orderpriority").alias("report"), F.to_date("o_orderdate").alias("as_at"), (1 + F.col("o_orderkey") % 3).cast("int").alias("version"), F.col("o_orderkey").alias("run"))
    inputs = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("run"), F.lit("lines").alias("model"), F.col("l_suppkey").alias("delivery_id"))
    return registry.behind_versions(versions, inputs)


@query("SELECT count(*) AS partitions, CAST(max(n) AS BIGINT) AS max_files_per_partition, CAST(sum(n) AS BIGINT) AS total_files, CAST(sum(b) AS DOUBLE) / CAST(sum(n) AS DOUBLE) / 1048576 AS avg_file_size_mb FROM (SELECT CAST(o_orderdate AS DATE) AS p, count(*) AS n, sum(o_orderkey) AS b FROM orders GROUP BY 1)")
def file_metrics(spark, d):
    files = t(spark, d, "orders").select(F.to_date("o_orderdate").alias("partition"), F.col("o_orderkey").alias("size"))
    return maintain.file_metrics(files).select("partitions", "max_files_per_partition", "total_files", "avg_file_size_mb")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0)")
def semi_and_anti(spark, d):
    o = t(spark, d, "orders")
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return li.join(o.where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").join(o.where("o_orderkey % 10 = 0"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")


@query("SELECT _row_number, n_rows FROM (SELECT row_number() OVER (ORDER BY o_orderkey) AS _row_number, count(*) OVER () AS n_rows FROM orders)")
def file_row_numbers(spark, d):
    """Row numbers in file order, from counts of read partitions and places inside them."""
    from ..sources.raw_ingest import numbered

    o = t(spark, d, "orders").select("o_orderkey").withColumns({"_part": F.lit(0), "_order": F.monotonically_increasing_id()})
    n = o.count()
    return numbered(o).select("_row_number", F.lit(n).cast("long").alias("n_rows"))
