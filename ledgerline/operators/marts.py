"""Report marts: exposure, its roll-up, and day-on-day and month-end changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conform import MATERIAL, change_category, change_pct, removed_as_zero
from .scd2 import as_of_join


def exposure(trades: DataFrame, key: str = "counterparty_id") -> DataFrame:
    """Measures per date and counterparty over live trades. A NULL mark adds nothing anywhere. The
    latest batch is told if trades name theirs. Books and products are a handful for each
    counterparty, so they are counted as sets, without a row for each distinct column."""
    batch = [F.max("source_batch_id").alias("source_batch_id")] if "source_batch_id" in trades.columns else []
    live = trades.where(~F.coalesce("is_matured", F.lit(False)))
    return live.groupBy("cob_date", key).agg(
        F.count("*").alias("trade_count"),
        F.sum("notional").alias("total_notional"),
        F.sum("mtm_value").alias("total_mtm"),
        F.sum(F.when(F.col("mtm_value") > 0, F.col("mtm_value")).otherwise(0)).alias("positive_mtm"),
        F.size(F.collect_set("book")).cast("long").alias("book_count"),
        F.size(F.collect_set("product_type")).cast("long").alias("product_count"),
        F.min("maturity_date").alias("earliest_maturity"),
        F.max("maturity_date").alias("latest_maturity"),
        *batch,
    )


def worst_rating(days: DataFrame, ratings: DataFrame, key: str = "counterparty_id") -> DataFrame:
    """Per date and counterparty, the worst rank over agencies (unranked ratings don't count), a
    flag that all are investment grade, and the latest rating's start; only for given days."""
    r = ratings.select(F.col(key).alias("_k"), "rating_rank", "grade_band", "effective_from", "effective_to")
    rated = days.select("cob_date", key).distinct().join(r, (F.col(key) == F.col("_k")) & F.col("cob_date").between(F.col("effective_from"), F.col("effective_to")))
    return rated.groupBy("cob_date", key).agg(F.max("rating_rank").alias("worst_rating_rank"), F.min(F.when(F.col("grade_band") == "INVESTMENT_GRADE", 1).otherwise(0)).alias("_ig"), F.max("effective_from").alias("rating_effective_from"))


def counterparty_exposure(trades: DataFrame, reference: DataFrame, delivered: DataFrame, ratings: DataFrame | None = None, key: str = "counterparty_id", carry: list[str] | None = None) -> DataFrame:
    """The spine mart: exposure, reference attributes in force on the date, whether they were
    carried forward (not delivered on the date), and the worst rating."""
    out = as_of_join(exposure(trades, key), reference, [key], "cob_date", "left", carry)
    seen = delivered.select(F.col("cob_date").alias("_d"), F.col(key).alias("_k")).distinct()
    out = out.join(seen, (F.col("cob_date") == F.col("_d")) & (F.col(key) == F.col("_k")), "left")
    out = out.withColumn("reference_carried_forward", F.col("_k").isNull()).drop("_d", "_k")
    if ratings is not None:
        worst = worst_rating(out, ratings, key).withColumnsRenamed({"cob_date": "_d", key: "_k"})
        out = out.join(worst, (F.col("cob_date") == F.col("_d")) & (F.col(key) == F.col("_k")), "left")
        out = out.withColumn("is_investment_grade", F.when(F.col("_k").isNotNull(), F.col("_ig") == 1)).drop("_d", "_k", "_ig")
    return out


def by_country(exposures: DataFrame, country: str = "country_code", key: str = "counterparty_id") -> DataFrame:
    """Roll-up by date and country; counterparties without one are UNKNOWN."""
    return exposures.groupBy("cob_date", F.coalesce(country, F.lit("UNKNOWN")).alias("country_code")).agg(
        F.count_distinct(key).alias("counterparty_count"),
        F.sum("trade_count").alias("trade_count"),
        F.sum("total_notional").alias("total_notional"),
        F.sum("total_mtm").alias("total_mtm"),
        F.sum("positive_mtm").alias("positive_mtm"),
        F.sum(F.when(F.col("total_mtm") < 0, F.col("total_mtm")).otherwise(0)).alias("negative_mtm"),
        F.count_distinct(F.when(F.col("total_mtm") > 0, F.col(key))).alias("positive_counterparties"),
    )


def summary(positions: DataFrame) -> DataFrame:
    return positions.groupBy("currency").agg(F.count("*").alias("position_count"), F.sum("amount").alias("total_amount"), F.sum(F.when(F.col("is_active"), 1).otherwise(0)).alias("active_position_count"))


def date_pairs(exposures: DataFrame) -> DataFrame:
    """(cob_date, prior_cob_date, prior_month_end) over the distinct dates: the retained date
    before, and the last month-end before. Windows over distinct dates only, some thousand rows at
    most however large the mart; the theta join m < d is a running maximum of month-ends."""
    dates = exposures.select("cob_date").distinct()
    order = Window.orderBy("cob_date")
    month = Window.partitionBy(F.trunc("cob_date", "MM"))
    ends = dates.withColumn("_end", F.when(F.col("cob_date") == F.max("cob_date").over(month), F.col("cob_date")))
    return ends.select("cob_date", F.lag("cob_date").over(order).alias("prior_cob_date"), F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("prior_month_end"))


def restated_pairs(pairs: DataFrame, before: DataFrame, restated: DataFrame) -> DataFrame:
    """The date pairs whose rows of the change mart have to be made again: those of restated dates
    (one column), those that look back to one as the date before or as a month-end, and those that
    look back to other dates than ``before`` (the pairs of the mart as it is), as dates came or went."""
    told = restated.select(F.col(restated.columns[0]).alias("_r")).distinct()
    columns = ["cob_date", "prior_cob_date", "prior_month_end"]
    hit = None
    for c in columns:
        own = pairs.join(told, pairs[c] == told["_r"], "left_semi")
        hit = own if hit is None else hit.union(own)
    return hit.union(pairs.select(*columns).exceptAll(before.select(*columns))).distinct()


def rebuild_changes(store, exposures: str, mart: str, branch: str, restated: list, key: str = "counterparty_id", attributes: tuple[str, ...] = (), threshold: int = MATERIAL) -> dict[str, list]:
    """Brings a change mart on a branch up to date with re-delivered dates of its exposures: only
    partitions that a restated date reaches are made and replaced, those of dates that are gone are
    dropped, all others keep their files. Without a mart it is built whole. Returns the dates."""
    source = store.read(exposures, branch)
    pairs = date_pairs(source)
    if not store.has(mart, branch):
        store.write(exposure_change(source, key, attributes, threshold), mart, branch, ["cob_date"])
        return {"rebuilt": sorted(r[0] for r in pairs.select("cob_date").collect()), "dropped": []}
    before = store.read(mart, branch).select("cob_date", "prior_cob_date", "prior_month_end").distinct()
    spark = store.spark
    days = spark.createDataFrame([(x,) for x in restated], "d date")
    todo = restated_pairs(pairs, before, days).collect()  # some dates
    have = {r[0] for r in before.select("cob_date").collect()}
    gone = sorted(have - {r[0] for r in pairs.select("cob_date").collect()})
    if todo:
        read = sorted({d for r in todo for d in r if d is not None})
        some = store.read(exposures, branch, {f"cob_date={d}" for d in read}) if store.ref(branch)["tables"][exposures]["column"] == "cob_date" else source
        made = exposure_change(some.where(F.col("cob_date").isin(read)), key, attributes, threshold, spark.createDataFrame(todo, pairs.schema))
        store.replace_partitions(made, mart, branch, "cob_date")
    if gone:
        store.drop_partitions(mart, branch, {f"cob_date={d}" for d in gone})
    return {"rebuilt": sorted(r["cob_date"] for r in todo), "dropped": gone}


def exposure_change(exposures: DataFrame, key: str = "counterparty_id", attributes: tuple[str, ...] = (), threshold: int = MATERIAL, pairs: DataFrame | None = None) -> DataFrame:
    """One row per date and counterparty that is there or was on the retained date before, of all
    dates or of some ``pairs`` (whose three dates the exposures must hold)."""
    pairs = date_pairs(exposures) if pairs is None else pairs
    measures = ["total_mtm", "total_notional", "trade_count"]
    base = exposures.select("cob_date", key, *attributes, *measures)
    dated = base.join(F.broadcast(pairs), "cob_date")
    following = pairs.where("prior_cob_date is not null").select(F.col("cob_date").alias("_next"), F.col("prior_cob_date").alias("_was"), F.col("prior_month_end").alias("_month"))
    before = base.join(F.broadcast(following), F.col("cob_date") == F.col("_was"))
    gone = before.select(F.col("_next").alias("cob_date"), F.col("_was").alias("prior_cob_date"), F.col("_month").alias("prior_month_end"), key)
    here = dated.select(F.col("cob_date").alias("_d"), F.col(key).alias("_k"))
    gone = gone.join(here, (F.col("cob_date") == F.col("_d")) & F.col(key).eqNullSafe(F.col("_k")), "left_anti")
    keys = dated.select("cob_date", "prior_cob_date", "prior_month_end", key).unionByName(gone)

    def side(name: str) -> DataFrame:
        return base.select(F.struct("*").alias(name), F.col("cob_date").alias(f"_{name}_d"), F.col(key).alias(f"_{name}_k"))

    out = keys
    for name, at in (("c", "cob_date"), ("p", "prior_cob_date"), ("m", "prior_month_end")):
        out = out.join(side(name), (F.col(at) == F.col(f"_{name}_d")) & F.col(key).eqNullSafe(F.col(f"_{name}_k")), "left")
    here, was = F.col("c.cob_date"), F.col("p.cob_date")
    delta = lambda m: (removed_as_zero(here, F.col(f"c.{m}")) - F.coalesce(f"p.{m}", F.lit(0)))
    return out.select(
        "cob_date", key, "prior_cob_date", "prior_month_end", *[F.coalesce(f"c.{a}", f"p.{a}").alias(a) for a in attributes],
        F.col("c.total_mtm").alias("total_mtm"), F.col("p.total_mtm").alias("prior_total_mtm"), delta("total_mtm").alias("mtm_change"),
        change_pct(removed_as_zero(here, F.col("c.total_mtm")), F.col("p.total_mtm")).alias("mtm_change_pct"),
        delta("total_notional").alias("notional_change"), delta("trade_count").alias("trade_count_change"),
        F.col("m.total_mtm").alias("month_end_mtm"), (removed_as_zero(here, F.col("c.total_mtm")) - F.coalesce("m.total_mtm", F.lit(0))).alias("month_end_change"),
        change_category(here, was, F.col("c.total_mtm"), F.col("p.total_mtm"), threshold).alias("change_category"),
    )
