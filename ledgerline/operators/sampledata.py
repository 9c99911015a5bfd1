"""Deterministic sample data from feed contracts, on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import Feed
from ..functions.conform import stable_draw

# Fixed values to draw from.
CURRENCIES = ("GBP", "USD", "EUR", "JPY")
CODES = ("GB", "US", "FR", "DE", "JP")


def phase(name: str, length: int) -> Column:
    """A stable offset of a name within a period."""
    return stable_draw(F.lit(name), F.lit("phase"), modulus=length)


def epoch(day: Column, name: Column, length: int) -> Column:
    """The number of the period that a day falls into, each name's periods shifted by its phase."""
    shift = stable_draw(name, F.lit("phase"), modulus=length)
    return F.floor((F.unix_date(day) + shift) / length)


def epoch_start(day: Column, name: Column, length: int) -> Column:
    shift = stable_draw(name, F.lit("phase"), modulus=length)
    return F.date_from_unix_date((epoch(day, name, length) * length - shift).cast("int"))


def generate(spark: SparkSession, feed: Feed, rows: int, cob: str, parents: dict[str, int] | None = None) -> DataFrame:
    """``rows`` string rows of a feed for a date. A column in ``parents`` draws its values from so
    many keys of another feed, so that references hold."""
    base = spark.range(rows).withColumnRenamed("id", "_i")
    day = F.lit(cob).cast("date")

    def value(column: str) -> Column:
        draw = lambda n: stable_draw(F.lit(feed.name), F.lit(column), F.col("_i"), modulus=n)
        if parents and column in parents:
            return F.format_string(f"{column[:2].upper()}%06d", draw(parents[column]))
        if column in feed.keys:
            return F.format_string(f"{column[:2].upper()}%06d", F.col("_i"))
        kind = feed.kind(column)
        if kind == "decimal":
            return F.format_string("%d.%02d", draw(1_000_000) - 300_000, stable_draw(F.lit(column), F.col("_i"), F.lit("c"), modulus=100))
        if kind == "integer":
            return draw(1000).cast("string")
        if kind == "date":
            return F.date_add(day, draw(365)).cast("string")
        if kind == "boolean":
            return F.element_at(F.array(*map(F.lit, ("Y", "no", "TRUE", "0"))), draw(4) + 1)
        if kind == "upper":
            names = CURRENCIES if "currency" in column else CODES
            return F.element_at(F.array(*map(F.lit, names)), draw(len(names)) + 1)
        return F.format_string(f"{column} %d", draw(100))

    return base.select(*[value(c).alias(source) for c, source in feed.columns.items()])
