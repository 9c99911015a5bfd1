"""Column -> Column: cleaning, casting, classification and hashing. A value that can't be read
becomes NULL and fails a test later, never the load."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN_END = date(9999, 12, 31)
RETRACTED = date(1, 1, 1)
WINDOW_FLOOR = date(1900, 1, 1)
MATERIAL = 1_000_000

# The rating scale, best to worst, and how many of them are investment grade.
RATINGS = ("AAA", "AA+", "AA", "AA-", "A+", "A", "A-", "BBB+", "BBB", "BBB-", "BB+", "BB", "BB-", "B+", "B", "B-", "CCC+", "CCC", "CCC-", "CC", "C", "D")
INVESTMENT_GRADES = 10
PROVENANCE = {"source_file": "_source_file", "source_file_version": "_file_version", "received_at": "_received_at", "schema_version": "_schema_version", "source_system": "_source_system"}


def ident(name: str) -> str:
    """Backtick-quoted unless the name already has a backtick, dot or parenthesis."""
    return name if any(c in name for c in "`.(") else f"`{name}`"


def _col(c) -> Column:
    return F.col(ident(c)) if isinstance(c, str) else c


def clean_string(c) -> Column:
    """Spaces trimmed (not tabs); '', 'NULL' and 'N/A' are NULL, in that spelling only."""
    out = F.trim(_col(c))
    for token in ("", "NULL", "N/A"):
        out = F.nullif(out, F.lit(token))
    return out


def upper_code(c) -> Column:
    return F.upper(clean_string(c))


def safe_cast(c, kind: str) -> Column:
    return _col(c).try_cast(kind)


def parse_date(c) -> Column:
    """yyyy-MM-dd, else yyyyMMdd, else NULL."""
    c = _col(c)
    return F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "yyyyMMdd"))


def yes_no_flag(c) -> Column:
    up = F.upper(_col(c))
    return F.when(up.isin("Y", "YES", "TRUE", "1"), True).when(up.isin("N", "NO", "FALSE", "0"), False)


def conformed(c, kind: str) -> Column:
    """A raw string column as its kind."""
    if kind == "decimal":
        return safe_cast(clean_string(c), "decimal(18,2)")
    if kind == "integer":
        return safe_cast(clean_string(c), "int")
    if kind == "date":
        return parse_date(clean_string(c))
    if kind == "boolean":
        return yes_no_flag(clean_string(c))
    return upper_code(c) if kind == "upper" else clean_string(c)


def delivery_ref() -> Column:
    """The delivery's id, or for older rows the last part of the source file's path."""
    return F.coalesce(F.col("_delivery_id"), F.element_at(F.split("_source_file", "/"), -1))


def source_provenance() -> list[Column]:
    return [F.col(raw).alias(name) for name, raw in PROVENANCE.items()] + [delivery_ref().alias("delivery_id")]


def audit_columns(batch: Column, invocation: str, ref: str) -> list[Column]:
    return [batch.alias("source_batch_id"), F.lit(invocation).alias("dbt_invocation_id"), F.lit(ref).alias("nessie_ref"), F.current_timestamp().alias("dbt_updated_at")]


def is_matured(maturity, cob) -> Column:
    """NULL without a maturity date."""
    return F.when(_col(maturity).isNotNull(), _col(maturity) < _col(cob))


def rating_rank(c) -> Column:
    """1 (best) to 22, NULL for anything else."""
    ranks = F.create_map(*[F.lit(x) for i, r in enumerate(RATINGS) for x in (r, i + 1)])
    return F.try_element_at(ranks, _col(c))


def grade_band(c) -> Column:
    """NULL stays NULL; whatever isn't an investment grade is below it, even if unranked."""
    c = _col(c)
    return F.when(c.isin(*RATINGS[:INVESTMENT_GRADES]), "INVESTMENT_GRADE").when(c.isNotNull(), "SUB_INVESTMENT_GRADE")


def retracted() -> Column:
    """The effective_to that marks a version to be taken away: a date on which none can end."""
    return F.lit(RETRACTED.isoformat()).cast("date")


def row_hash(*columns) -> Column:
    """sha256 over the columns' texts joined by ||; NULL counts as ''."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns]), 256)


def removed_as_zero(key: Column, value: Column) -> Column:
    """Zero where the row is absent, its own value (NULL too) where it is there."""
    return F.when(key.isNull(), F.lit(0)).otherwise(value)


def change_pct(now: Column, prior: Column) -> Column:
    """NULL where there is no prior value or it is zero."""
    return F.when(prior.isNotNull() & (prior != 0), (now - prior).cast("double") / F.abs(prior).cast("double"))


def change_category(current_key: Column, prior_key: Column, current: Column, prior: Column, threshold: int = MATERIAL) -> Column:
    moved = F.abs(F.coalesce(current, F.lit(0)) - F.coalesce(prior, F.lit(0)))
    return (
        F.when(prior_key.isNull(), "NEW")
        .when(current_key.isNull(), "REMOVED")
        .when(moved > threshold, "MATERIAL_CHANGE")
        .when(~current.eqNullSafe(prior), "CHANGED")
        .otherwise("UNCHANGED")
    )


def effective_month(c) -> Column:
    return F.trunc(_col(c), "MM")


def extra_columns(names: list[str]) -> Column:
    """A map of undeclared columns; empty but typed without any."""
    if not names:
        return F.expr("cast(map() as map<string,string>)")
    return F.create_map(*[x for n in names for x in (F.lit(n), _col(n).cast("string"))])


#: Up to here all whole numbers are doubles.
WHOLE = 10**15


def canonical_value(c: Column, kind: T.DataType) -> Column:
    """One text for a value whatever the engine that made it."""
    if isinstance(kind, T.BooleanType):
        text = F.lower(c.cast("string"))
    elif isinstance(kind, (T.DateType, T.StringType, T.TimestampType)):
        text = F.trim(c.cast("string"))
    elif isinstance(kind, T.NumericType):
        # Whole numbers have the same text without the formatter, which takes most of the time.
        text = F.format_string("%.10f", c.cast("double"))
        if isinstance(kind, T.IntegralType):
            text = F.when(c.between(-WHOLE, WHOLE), F.concat(c.cast("string"), F.lit(".0000000000"))).otherwise(text)
        elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
            x = c.cast("double")
            text = F.when(x.between(-WHOLE, WHOLE) & (x != 0) & (F.rint(x) == x), F.concat(x.cast("long").cast("string"), F.lit(".0000000000"))).otherwise(text)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("\x00NULL"))


def canonical_row_hash(df: DataFrame, columns: list[str]) -> Column:
    return F.sha2(F.concat_ws("\x1f", *[canonical_value(F.col(c), df.schema[c].dataType) for c in columns]), 256)


def parse_filename(c, pattern: str) -> tuple[Column, Column]:
    """(business date, version) from a file name by a pattern with two capture groups."""
    c = _col(c)
    version = F.regexp_extract(c, pattern, 2)
    return F.try_to_date(F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")), "yyyyMMdd"), F.coalesce(F.nullif(version, F.lit("")).try_cast("int"), F.lit(1))


def deadline(cob, clock: str) -> Column:
    """The day after ``cob`` at hh:mm UTC."""
    hours, minutes = map(int, clock.split(":"))
    return F.timestamp_add("MINUTE", F.lit(60 * hours + minutes), F.date_add(_col(cob), 1).cast("timestamp"))


def stable_draw(*parts, modulus: int) -> Column:
    """A deterministic pseudo-random integer below ``modulus`` from the parts' texts."""
    return (F.crc32(F.concat_ws("|", *[_col(p).cast("string") if not isinstance(p, Column) else p.cast("string") for p in parts]).cast("binary")) % modulus).cast("int")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """IS NOT DISTINCT FROM over all keys."""
    return all_of([left[k].eqNullSafe(right[k]) for k in keys])
