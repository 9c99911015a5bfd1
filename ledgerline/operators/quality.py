"""Declarative checks. Each gives the failing rows; ``run_checks`` turns them into outcomes, in one
job if all can run. Who runs them records PASS as durably as FAIL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scd2 import broken_ranges


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_empty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.trim(column) == "")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """NULL passes."""
    return df.where(~F.col(column).isin(*values))


def accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return df.where(bad)


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    return child.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias("_parent")), F.col(column) == F.col("_parent"), "left_anti")


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).count().where("count > 1")


def equality(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of either side that the other lacks, with multiplicity."""
    a, b = left.select(*columns), right.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def mutually_exclusive(df: DataFrame, keys: list[str]) -> DataFrame:
    return broken_ranges(df, keys)


def one_current(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if("is_current").alias("n")).where("n <> 1")


def removed_matches_disappearance(changed: DataFrame, exposures: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """REMOVED rows still present on their date, and keys that disappeared without one."""
    here = exposures.select("cob_date", key)
    removed = changed.where("change_category = 'REMOVED'").select("cob_date", key)
    wrong = removed.join(here, ["cob_date", key], "left_semi").withColumn("flaw", F.lit("still there"))
    was = here.withColumnRenamed("cob_date", "prior_cob_date").join(pairs.select("cob_date", "prior_cob_date"), "prior_cob_date").select("cob_date", key)
    missed = was.join(here, ["cob_date", key], "left_anti").join(removed, ["cob_date", key], "left_anti").withColumn("flaw", F.lit("not reported"))
    return wrong.unionByName(missed)


@dataclass(frozen=True)
class Check:
    name: str
    failing: Callable[[], DataFrame]
    severity: str = "error"


def outcome(failures: int | None, severity: str) -> str:
    """pass, warn, fail, or error if the check could not be run."""
    return "error" if failures is None else "pass" if failures == 0 else "warn" if severity == "warn" else "fail"


def evidence_id(run: str, check: str) -> str:
    return hashlib.sha256(f"{run}\x1f{check}".encode()).hexdigest()[:32]


def run_checks(checks: list[Check], run: str = "") -> DataFrame:
    """(evidence_id, check_name, severity, failures, outcome) of all checks, as one plan. A check
    that can't be planned has no failures and the outcome error."""
    spark = SparkSession.active()
    parts = []
    for c in checks:
        try:
            counted = c.failing().agg(F.count("*").alias("failures"))
        except Exception:  # whatever a check raises, the others are still run
            counted = spark.range(1).select(F.lit(None).cast("long").alias("failures"))
        parts.append(counted.select(F.lit(evidence_id(run, c.name)).alias("evidence_id"), F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "failures"))
    every = reduce(DataFrame.unionByName, parts)
    told = F.when(F.col("failures").isNull(), outcome(None, "")).when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return every.withColumn("outcome", told)


def settled_checks(checks: list[Check], run: str = "") -> DataFrame:
    """The same with the counts made, so a check that breaks while it runs is an error by itself:
    first all as one job, and one by one only if that job fails."""
    spark = SparkSession.active()
    try:
        found = run_checks(checks, run).collect()
    except Exception:
        found = []
        for c in checks:
            try:
                found += run_checks([c], run).collect()
            except Exception:
                found.append((evidence_id(run, c.name), c.name, c.severity, None, outcome(None, c.severity)))
    return spark.createDataFrame(found, "evidence_id string, check_name string, severity string, failures long, outcome string")
