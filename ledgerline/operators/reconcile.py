"""Dual-run comparison of a legacy result and ours, and acceptance over business dates."""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conform import canonical_row_hash, canonical_value

SEVERITY = {"FAIL": 4, "ERROR": 3, "WARN": 2, "PASS": 1}
FUNCTIONS = {"sum": F.sum, "count": F.count, "count_distinct": F.count_distinct, "min": F.min, "max": F.max}


class NotComparable(RuntimeError):
    """No evidence, or two candidates of one strength."""


def row_count(legacy: DataFrame, new: DataFrame) -> DataFrame:
    """One row (legacy_rows, new_rows, outcome)."""
    a, b = legacy.agg(F.count("*").alias("legacy_rows")), new.agg(F.count("*").alias("new_rows"))
    return a.crossJoin(b).withColumn("outcome", F.when(F.col("legacy_rows") == F.col("new_rows"), "PASS").otherwise("FAIL"))


def compare_rows(legacy: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys..., status): legacy_only, new_only, changed or equal, by one full join on the
    canonical key, with the row hashes made and compared in Spark."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[canonical_value(F.col(k), df.schema[k].dataType).alias(k) for k in keys], canonical_row_hash(df, columns).alias(name))

    both = side(legacy, "legacy_hash").join(side(new, "new_hash"), keys, "full")
    status = F.when(F.col("new_hash").isNull(), "legacy_only").when(F.col("legacy_hash").isNull(), "new_only").when(F.col("legacy_hash") != F.col("new_hash"), "changed").otherwise("equal")
    return both.select(*keys, status.alias("status"))


#: Rows that a bucket of keys is made for, and the least number of buckets. With a share of the keys
#: changed, few buckets differ only as long as a bucket has few keys, whatever the number of rows.
BUCKET_ROWS = 64
BUCKETS = 1 << 16
#: Nodes of a level that are named in a filter on the next one.
NAMED = 1000


def _hashes(df: DataFrame, columns: list[str], *before: Column) -> list[Column]:
    """Two hashes of a row's canonical values."""
    values = [*before, *[canonical_value(F.col(c), df.schema[c].dataType) for c in columns]]
    return [F.xxhash64(F.lit(seed), *values).alias(n) for seed, n in ((1, "one"), (2, "two"))]


def _halves(name: str) -> list[Column]:
    """The sum of a hash as two longs, high and low (of a group of up to 2^31 rows)."""
    return [F.sum(F.shiftright(name, 32)).alias(f"{name}_high"), F.sum(F.col(name).bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"{name}_low")]


def bucket_digests(df: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, one, two): for each bucket of keys, the number of its rows and two sums of hashes of
    whole rows. Order doesn't matter, repeated rows count each, and the sums of several buckets are
    the digest of all of them. One small row for each bucket leaves a task, however many it reads."""
    key = F.concat_ws("\x1f", *[canonical_value(F.col(k), df.schema[k].dataType) for k in keys])
    named = df.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), *_hashes(df, columns, key))
    sums = named.groupBy("bucket").agg(F.count("*").alias("n"), *_halves("one"), *_halves("two"))
    return sums.select("bucket", "n", *[F.expr(f"cast({c}_high as decimal(28,0)) * 4294967296BD + {c}_low").cast("decimal(38,0)").alias(c) for c in ("one", "two")])


def differing(legacy: DataFrame, new: DataFrame, buckets: int = BUCKETS, fanout: int = 256) -> DataFrame:
    """(bucket) of two sets of digests that differ, found level by level: equal roots end it, and of
    each level only the children of nodes that differ are compared, or all buckets at once where too
    many nodes differ for that. The digests may be stored ones; where both sides are made for this,
    ``legacy`` and ``new`` should be written before."""
    depth, size = 0, 1
    while size < buckets:
        size, depth = size * fanout, depth + 1

    def nodes(width: int, inside: str | None) -> DataFrame:
        def level(side: DataFrame, name: str) -> DataFrame:
            out = (side if inside is None else side.where(inside)).withColumn("node", F.expr(f"bucket div {width}"))
            return out.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("n", "one", "two")]).select("node", F.struct("n", "one", "two").alias(name))

        return level(legacy, "a").join(level(new, "b"), "node", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("node")

    inside = None
    for k in range(depth, 0, -1):
        wanted = sorted(r[0] for r in nodes(fanout**k, inside).collect())
        inside = f"bucket div {fanout**k} in ({', '.join(map(str, wanted))})" if wanted else "false"
        if not wanted:
            break
        if len(wanted) > NAMED:
            inside = None
            break
    return nodes(1, inside).select(F.col("node").alias("bucket"))


def differing_buckets(legacy: DataFrame, new: DataFrame, buckets: int = BUCKETS, fanout: int = 256) -> list[int]:
    """Those of ``differing``, in order, for few."""
    return sorted(r[0] for r in differing(legacy, new, buckets, fanout).collect())


def compare_by_tree(legacy: DataFrame, new: DataFrame, keys: list[str], columns: list[str], digests: tuple[DataFrame, DataFrame] | None = None, buckets: int | None = None) -> DataFrame:
    """(keys..., status, legacy_rows, new_rows) of the keys that differ: legacy_only, new_only or
    changed. Only rows of differing buckets are hashed by key and joined; equal sides shuffle digests
    alone. A key with several rows is one key, equal if both sides have the same rows, in any order,
    as often. ``digests``: those of both sides, where they are known already. ``buckets``: by the
    number of rows, or those that ``digests`` have."""
    if buckets is None:
        buckets = BUCKETS if digests else max(BUCKETS, 1 << (new.count() // BUCKET_ROWS).bit_length())
    # a row for each bucket, read once for each level
    told = digests or tuple(bucket_digests(df, keys, columns, buckets).persist(StorageLevel.DISK_ONLY) for df in (legacy, new))
    wanted = differing(*told, buckets).persist(StorageLevel.DISK_ONLY)
    found = wanted.count()
    for own in () if digests else told:
        own.unpersist()
    if found <= 1_000_000:
        wanted = F.broadcast(wanted)

    def side(df: DataFrame, name: str) -> DataFrame:
        texts = [canonical_value(F.col(k), df.schema[k].dataType) for k in keys]
        inside = df.select(*{*keys, *columns})
        if not found:
            inside = inside.where(F.lit(False))
        elif 2 * found < buckets:
            inside = inside.withColumn("_bucket", F.pmod(F.xxhash64(F.concat_ws("\x1f", *texts)), F.lit(buckets)))
            inside = inside.join(wanted, inside["_bucket"] == wanted["bucket"], "left_semi")
        named = inside.select(*[t.alias(k) for t, k in zip(texts, keys, strict=True)], *_hashes(df, columns))
        return named.groupBy(*keys).agg(F.count("*").alias("rows"), *_halves("one"), *_halves("two")).select(*keys, F.struct("rows", "one_high", "one_low", "two_high", "two_low").alias(name))

    both = side(legacy, "_legacy").join(side(new, "_new"), keys, "full").where(~F.col("_legacy").eqNullSafe(F.col("_new")))
    status = F.when(F.col("_new").isNull(), "legacy_only").when(F.col("_legacy").isNull(), "new_only").otherwise("changed")
    rows = lambda c: F.coalesce(F.col(c)["rows"], F.lit(0)).cast("long")
    return both.select(*keys, status.alias("status"), rows("_legacy").alias("legacy_rows"), rows("_new").alias("new_rows"))


def key_set(compared: DataFrame) -> DataFrame:
    return compared.agg(F.count_if(F.col("status") == "legacy_only").alias("legacy_only"), F.count_if(F.col("status") == "new_only").alias("new_only")).withColumn("outcome", F.when(F.col("legacy_only") + F.col("new_only") == 0, "PASS").otherwise("FAIL"))


def aggregate_pairs(legacy: DataFrame, new: DataFrame, wanted: list[tuple[str, str]], absolute: float = 0.0, relative: float = 0.0) -> DataFrame:
    """(function, column_name, legacy_value, new_value, outcome), every aggregate of a side in one
    pass; a pair passes at no difference, within the absolute, or within the relative tolerance."""

    def side(df: DataFrame, name: str) -> DataFrame:
        made = df.agg(*[FUNCTIONS[f](F.col(c).cast("double") if f not in ("count", "count_distinct") else F.col(c)).cast("double").alias(f"{f}:{c}") for f, c in wanted])
        pairs = F.array(*[F.struct(F.lit(f).alias("function"), F.lit(c).alias("column_name"), F.col(f"`{f}:{c}`").alias(name)) for f, c in wanted])
        return made.select(F.inline(pairs))

    both = side(legacy, "legacy_value").join(side(new, "new_value"), ["function", "column_name"])
    gap = F.abs(F.col("legacy_value") - F.col("new_value"))
    scale = F.when(F.col("legacy_value") == 0, 1.0).otherwise(F.abs("legacy_value"))
    good = F.col("legacy_value").eqNullSafe(F.col("new_value")) | (gap <= absolute) | (gap / scale <= relative)
    return both.withColumn("outcome", F.when(F.coalesce(good, F.lit(False)), "PASS").otherwise("FAIL"))


def worst_outcome(outcomes: DataFrame) -> DataFrame:
    """FAIL over ERROR over WARN over PASS; nothing at all is an ERROR."""
    rank = F.create_map(*[F.lit(x) for k, v in SEVERITY.items() for x in (k, v)])
    return outcomes.agg(F.coalesce(F.max_by("outcome", rank[F.col("outcome")]), F.lit("ERROR")).alias("outcome"))


def compare_business_date(legacy: DataFrame, new: DataFrame, keys: list[str], columns: list[str], aggregates: list[tuple[str, str]], absolute: float = 0.0, relative: float = 0.0) -> DataFrame:
    """(comparator, outcome) of all comparators."""
    compared = compare_rows(legacy, new, keys, columns)
    changed = compared.agg(F.when(F.count_if(F.col("status") == "changed") == 0, "PASS").otherwise("FAIL").alias("outcome"))
    parts = [row_count(legacy, new).select(F.lit("row_count").alias("comparator"), "outcome"), key_set(compared).select(F.lit("key_set").alias("comparator"), "outcome"), changed.select(F.lit("row_hash").alias("comparator"), "outcome")]
    if aggregates:
        parts.append(worst_outcome(aggregate_pairs(legacy, new, aggregates, absolute, relative)).select(F.lit("aggregate").alias("comparator"), "outcome"))
    return reduce(DataFrame.unionByName, parts)


def diff_artifact(compared: DataFrame, path: str, most: int = 10_000) -> None:
    """Three lists of differences for people to read, as JSON in folders by status: legacy_only,
    new_only and changed, each capped; counts are never taken from them."""
    for status in ("legacy_only", "new_only", "changed"):
        compared.where(F.col("status") == status).limit(most).write.mode("overwrite").json(f"{path}/{status}")


def contract_hash(keys: list[str], columns: list[str], settings: dict) -> str:
    """Twelve hex digits; key order counts, column order doesn't."""
    text = json.dumps([keys, sorted(columns), settings], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:12]


def comparison_id(contract: str, business_date, legacy_digest: str, new_ref: str) -> str:
    """Twelve hex digits that name one comparison: equal evidence under an equal contract has an
    equal id, so it is recorded once."""
    return hashlib.sha256("\x1f".join(map(str, (contract, business_date, legacy_digest, new_ref))).encode()).hexdigest()[:12]


def correlate(ours: dict, candidates: list[dict], date_only: bool = False) -> dict:
    """The candidate that is evidence for our result: by producer run, else content digest, else
    system and file name, else (opted into) date alone. Candidates that agree on a weaker property
    but contradict a stronger known one are refused."""
    tiers = [("producer_run_id",), ("source_sha256",), ("source_system", "source_filename")] + ([("business_date",)] if date_only else [])
    for n, fields in enumerate(tiers):
        found = [c for c in candidates if all(c.get(f) is not None and c.get(f) == ours.get(f) for f in fields)]
        found = [c for c in found if not any(c.get(f) is not None and ours.get(f) is not None and c[f] != ours[f] for t in tiers[:n] for f in t)]
        if len(found) > 1:
            raise NotComparable(f"{len(found)} candidates by {fields}")
        if found:
            return found[0]
    raise NotComparable("no evidence")


def acceptance(comparisons: DataFrame, required: int = 10, allow_warn: bool = False) -> DataFrame:
    """One row (streak, latest_date, status) from (business_date, outcome, executed_at): the latest
    comparison of each date counts; the streak runs back from the newest date."""
    latest = comparisons.groupBy("business_date").agg(F.max_by("outcome", "executed_at").alias("outcome"))
    good = F.col("outcome").isin("PASS", "WARN") if allow_warn else F.col("outcome") == "PASS"
    back = Window.orderBy(F.desc("business_date")).rowsBetween(Window.unboundedPreceding, 0)
    run = latest.withColumn("_bad", F.sum(F.when(good, 0).otherwise(1)).over(back))
    out = run.agg(F.count_if(F.col("_bad") == 0).alias("streak"), F.max("business_date").alias("latest_date"))
    return out.withColumn("status", F.when(F.col("latest_date").isNull(), "NOT_STARTED").when(F.col("streak") >= required, "READY").otherwise("NOT_READY"))
