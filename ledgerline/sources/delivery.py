"""Reading deliveries: strict validation of bytes, dialects, parts, archives and control files."""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import date
from functools import reduce
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import ContractError, Feed


class Rejected(ContractError):
    """A delivery that can't be read as its contract says."""


def detect_encoding(data: bytes) -> str:
    """UTF-16 by its byte order mark only, then UTF-8, then Latin-1 unless it would hold C1
    control characters, then Windows-1252."""
    if data.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)):
        return "UTF-16"
    try:
        data.decode("utf-8")
        return "UTF-8"
    except UnicodeDecodeError:
        return "windows-1252" if any(0x80 <= b <= 0x9F for b in data) else "ISO-8859-1"


def decoded(data: bytes, encoding: str) -> str:
    """Strict decoding; a UTF-8 mark is dropped, another encoding's mark is refused."""
    if data.startswith(codecs.BOM_UTF8):
        if encoding.upper() not in ("UTF-8", "UTF8"):
            raise Rejected(f"a UTF-8 mark in {encoding}")
        data = data[3:]
    try:
        return data.decode(encoding)
    except UnicodeDecodeError as e:
        raise Rejected(f"not {encoding}: {e}") from e


def csv_rows(data: bytes, feed: Feed) -> list[list[str]]:
    """The data rows of a small file, or Rejected: ragged rows, unclosed quotes, and line breaks
    in values unless the contract has them."""
    text = decoded(data, feed.encoding)
    try:
        rows = list(csv.reader(io.StringIO(text, newline=""), delimiter=feed.separator, quotechar=feed.quote, doublequote=True, strict=True))
    except csv.Error as e:
        raise Rejected(str(e)) from e
    rows = [r for r in rows if r]
    if not feed.multiline and any("\n" in v or "\r" in v for r in rows for v in r):
        raise Rejected("a line break in a value")
    width = len(rows[0]) if feed.header and rows else len(feed.columns)
    for n, r in enumerate(rows, 1):
        if len(r) != width:
            raise Rejected(f"row {n} has {len(r)} values, not {width}")
    return rows[1:] if feed.header else rows


def read_landing(spark: SparkSession, feed: Feed, path: str) -> DataFrame:
    """One delivered CSV with every column a string. Contracts from version 2 on fail on a ragged
    row; version 1 pads and drops."""
    reader = spark.read.option("header", feed.header).option("sep", feed.separator).option("quote", feed.quote).option("escape", feed.escape).option("encoding", feed.encoding).option("multiLine", feed.multiline)
    reader = reader.option("nullValue", "").option("emptyValue", "").option("enforceSchema", False).option("mode", "FAILFAST" if feed.contract_version >= 2 else "PERMISSIVE")
    if feed.header:
        # All-string schema from the header line alone: no inference pass over the data.
        head = spark.read.option("encoding", feed.encoding).text(path).limit(1).collect()
        names = next(csv.reader([head[0][0].lstrip("﻿")], delimiter=feed.separator, quotechar=feed.quote)) if head else list(feed.columns.values())
    else:
        names = list(feed.columns.values())
    return reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(path)


def read_parts(spark: SparkSession, feed: Feed, paths: list[str]) -> DataFrame:
    """All parts of a delivery, tagged with the file each row came from and its order there."""
    parts = []
    for n, path in enumerate(sorted(paths)):
        part = read_landing(spark, feed, path)
        parts.append(part.withColumns({"_source_file": F.lit(path), "_part": F.lit(n), "_order": F.monotonically_increasing_id()}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def opened(data: bytes, member_pattern: str | None) -> Iterator[tuple[str, Iterator[bytes]]]:
    """(name, its bytes in pieces) of an archive's members in order of name; a member's pieces are to
    be read before the next one. Unsafe paths and no match at all are refused."""

    def pieces(z: zipfile.ZipFile, name: str) -> Iterator[bytes]:
        with z.open(name) as f:
            while piece := f.read(1 << 20):
                yield piece

    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            names = sorted(i.filename for i in z.infolist() if not i.is_dir())
            if any(PurePosixPath(n).is_absolute() or ".." in PurePosixPath(n).parts or "\\" in n for n in names):
                raise Rejected("an unsafe path in the archive")
            names = [n for n in names if member_pattern is None or re.fullmatch(member_pattern, PurePosixPath(n).name)]
            if not names:
                raise Rejected("no member matches")
            for n in names:
                yield n, pieces(z, n)
    except zipfile.BadZipFile as e:
        raise Rejected(str(e)) from e


def unpack(data: bytes, member_pattern: str | None) -> list[tuple[str, bytes]]:
    """Members of a small archive in order of name."""
    return [(n, b"".join(pieces)) for n, pieces in opened(data, member_pattern)]


def decoded_pieces(pieces: Iterable[bytes], encoding: str) -> Iterator[str]:
    """Strict decoding, piece by piece, with the rules of ``decoded``."""
    reader, first = codecs.getincrementaldecoder(encoding)(), True
    try:
        for piece in pieces:
            if first and piece.startswith(codecs.BOM_UTF8):
                if encoding.upper() not in ("UTF-8", "UTF8"):
                    raise Rejected(f"a UTF-8 mark in {encoding}")
                piece = piece[3:]
            first = False
            yield reader.decode(piece)
        yield reader.decode(b"", True)
    except UnicodeDecodeError as e:
        raise Rejected(f"not {encoding}: {e}") from e


def text_lines(pieces: Iterable[str]) -> Iterator[list[str]]:
    """Lines of a text that comes in pieces, some at a time, split at line feeds only."""
    rest = ""
    for piece in pieces:
        *whole, rest = (rest + piece).split("\n")
        if whole:
            yield whole
    if rest:
        yield [rest]


def typed(text: str, kind: str):
    """A control file's value: string, integer, date (yyyy-MM-dd or yyyyMMdd) or md5."""
    text = text.strip()
    if kind == "integer":
        if not re.fullmatch(r"\d+", text):
            raise Rejected(f"not a whole number: {text}")
        return int(text)
    if kind == "date":
        m = re.fullmatch(r"(\d{4})-?(\d{2})-?(\d{2})", text)
        if not m:
            raise Rejected(f"not a date: {text}")
        return date(*map(int, m.groups()))
    if kind == "md5":
        if not re.fullmatch(r"[0-9a-fA-F]{32}", text):
            raise Rejected(f"not an md5: {text}")
        return text.lower()
    return text


def read_control(text: str, kind: str, fields: dict[str, tuple[str, str]], pattern: str | None = None, separator: str = "|", header: bool = True) -> dict:
    """Typed fields of a control file. ``fields``: name -> (where, type); where is a group of the
    pattern (regex), a header or position (delimited, exactly one data row), or a key (key_value,
    no key twice)."""
    if kind == "regex":
        m = re.search(pattern or "", text)
        if not m:
            raise Rejected("the control file doesn't match")
        found = m.groupdict()
    elif kind == "delimited":
        rows = [r for r in csv.reader(io.StringIO(text), delimiter=separator) if r]
        names = rows[0] if header and rows else None
        body = rows[1:] if header else rows
        if len(body) != 1:
            raise Rejected(f"{len(body)} data rows in the control file")
        found = dict(zip(names or map(str, range(len(body[0]))), body[0], strict=False))
    elif kind == "key_value":
        found = {}
        for line in filter(str.strip, text.splitlines()):
            key, _, value = line.partition("=")
            if key.strip() in found:
                raise Rejected(f"{key.strip()} twice")
            found[key.strip()] = value
    else:
        raise ContractError(f"control kind {kind}")
    if missing := [w for w, _ in fields.values() if w not in found]:
        raise Rejected(f"the control file lacks {missing}")
    return {name: typed(found[where], t) for name, (where, t) in fields.items()}


def file_evidence(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, length, md5, sha256) of files, digested on the executors."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", "length", F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def logical_md5(members: list[bytes]) -> str:
    """One digest over a delivery's objects in order."""
    digest = hashlib.md5()
    for m in members:
        digest.update(m)
    return digest.hexdigest()


#: Kinds of text values from the narrowest on; each has a test that all values must pass.
KIND_TESTS = {
    "boolean": lambda c: F.lower(c).isin("true", "false"),
    "integer": lambda c: c.try_cast("bigint").isNotNull() & c.rlike(r"^[+-]?[0-9]+$"),
    "decimal": lambda c: c.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
    "date": lambda c: F.try_to_date(c, "yyyy-MM-dd").isNotNull() & c.rlike(r"^\d{4}-\d{2}-\d{2}$"),
}


def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, kind, n_rows, nulls, about_distinct) of all columns by one pass that makes no row
    more: for each column a few flags, which of two parts of the data AND to those of both, and a
    distinct sketch. The kind is the first whose test all values pass, else string; a column
    without values is of kind string."""
    told = []
    for c in df.columns:
        text = F.trim(F.col(f"`{c}`").cast("string"))
        flags = [F.bool_and(F.when(text.isNotNull(), test(text))).alias(kind) for kind, test in KIND_TESTS.items()]
        told.append(F.struct(F.lit(c).alias("column_name"), F.count(F.col(f"`{c}`")).alias("values"), F.hll_sketch_estimate(F.hll_sketch_agg(text, F.lit(14))).alias("about_distinct"), *flags))
    row = df.agg(F.count("*").alias("n_rows"), F.array(*told).alias("each")).select("n_rows", F.inline("each"))
    kind = F.lit("string")
    for name in reversed(KIND_TESTS):
        kind = F.when(F.col(name), name).otherwise(kind)
    return row.select("column_name", F.when(F.col("values") > 0, kind).otherwise("string").alias("kind"), "n_rows", (F.col("n_rows") - F.col("values")).alias("nulls"), F.coalesce("about_distinct", F.lit(0)).alias("about_distinct"))


#: Separators and quotes that a file may have (fixed values).
SEPARATORS, QUOTES = (",", ";", "|", "\t"), ('"', "'")


def dialect_scores(spark: SparkSession, path: str, encoding: str = "UTF-8", lines: int = 500) -> DataFrame:
    """(separator, quote, score, width, rows) of every dialect, best first: the first lines of each
    range that Spark reads a file in are split by each, and a dialect's score is the share of lines
    that have its commonest number of values, if that is more than one, less the share of lines that
    can't be split by it; quotes that stand at the edges of values count a little."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        left = lines
        for batch in batches:
            for body in batch.column(0).slice(0, left).to_pylist():
                left -= 1
                text = body.decode(encoding, "replace").rstrip("\r")
                if not text.strip():
                    continue
                for separator in SEPARATORS:
                    for quote in QUOTES:
                        try:
                            row = next(csv.reader([text], delimiter=separator, quotechar=quote, doublequote=True, strict=True))
                            width = len(row)
                        except csv.Error:
                            width = -1
                        edges = len(re.findall(rf"(?:^|{re.escape(separator)}){re.escape(quote)}", text))
                        key = (separator, quote, width, edges > 0)
                        seen[key] = seen.get(key, 0) + 1
        rows = list(zip(*[(*k, n) for k, n in seen.items()], strict=True)) or [[]] * 5
        kinds = (pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], ["separator", "quote", "width", "edged", "n"])

    lined = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("line"))
    told = lined.mapInArrow(scan, "separator string, quote string, width int, edged boolean, n long")
    each = told.groupBy("separator", "quote", "width").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("edged"), F.col("n")).otherwise(0)).alias("edged"))
    of_all = each.groupBy("separator", "quote").agg(F.sum("n").alias("rows"), F.max_by("width", F.struct(F.when(F.col("width") > 1, F.col("n")).otherwise(0), "width")).alias("width"), F.max(F.when(F.col("width") > 1, F.col("n")).otherwise(0)).alias("top"), F.sum(F.when(F.col("width") < 0, F.col("n")).otherwise(0)).alias("bad"), F.sum("edged").alias("edged"))
    score = (F.col("top") - F.col("bad") + F.col("edged") / 10) / F.col("rows")
    return of_all.select("separator", "quote", score.alias("score"), "width", "rows").orderBy(F.desc("score"), F.desc("width"), "separator", "quote")


def sniff(spark: SparkSession, path: str, sample: bytes) -> dict:
    """Delimiter, quote, header, encoding, column names and kinds, and the columns whose values
    are all different: the encoding from a sample of bytes, the dialect from the first lines of all
    ranges, kinds and keys from the whole file. The first line is a header if its values are all
    different and of no kind but string, and some column below has another kind, or none of its
    values stands in its column below."""
    encoding = detect_encoding(sample)
    best = dialect_scores(spark, path, encoding).first()
    separator, quote = (best["separator"], best["quote"]) if best else (",", '"')
    reader = spark.read.option("sep", separator).option("quote", quote).option("encoding", encoding)
    lines = reader.option("header", False).csv(path)
    first = lines.first()
    if first is None:
        return {"delimiter": separator, "quote": quote, "header": False, "encoding": encoding, "columns": [], "kinds": {}, "keys": []}
    body = reader.option("header", True).schema(", ".join(f"`{c}` string" for c in lines.columns)).option("enforceSchema", True).csv(path)
    below = {r["column_name"]: r for r in column_profile(body).collect()}
    top = {r["column_name"]: r["kind"] for r in column_profile(spark.createDataFrame([first], lines.schema)).collect()}
    names = [v for v in first if v is not None]
    told = len(set(names)) == len(first) and all(k == "string" for k in top.values())
    again = body.where(reduce(lambda a, b: a | b, [F.col(c) == F.lit(v) for c, v in zip(lines.columns, first, strict=True)])).limit(1).count() if told else 1
    header = told and (any(r["kind"] != "string" for r in below.values()) or not again)
    found = body.toDF(*first) if header else lines
    profile = {new: below[old] for new, old in zip(first, lines.columns, strict=True)} if header else {r["column_name"]: r for r in column_profile(lines).collect()}
    return {"delimiter": separator, "quote": quote, "header": header, "encoding": encoding, "columns": found.columns, "kinds": {c: r["kind"] for c, r in profile.items()}, "keys": key_candidates(found, profile)}


def key_statistics(df: DataFrame) -> DataFrame:
    """(column_name, distinct_values, n_rows, is_key) of all columns: a key has no NULL and all its
    values differ. Each column is counted by itself, over its own values alone, so together they
    read a column store once and no row is made for each column."""
    n = df.agg(F.count("*").alias("n_rows"))
    parts = []
    for c in df.columns:
        values = df.select(F.col(f"`{c}`").alias("v")).where("v is not null").groupBy("v").agg(F.lit(1).alias("one"))
        parts.append(values.agg(F.count("*").alias("distinct_values")).select(F.lit(c).alias("column_name"), "distinct_values"))
    each = reduce(DataFrame.unionByName, parts).crossJoin(n)  # one row
    return each.select("column_name", "distinct_values", "n_rows", ((F.col("n_rows") > 0) & (F.col("distinct_values") == F.col("n_rows"))).alias("is_key"))


def key_candidates(df: DataFrame, profile: dict | None = None) -> list[str]:
    """Columns without NULL whose values are all different. Only those that a distinct sketch leaves
    as candidates are counted; its error is some parts in a thousand."""
    told = profile or {r["column_name"]: r for r in column_profile(df).collect()}
    likely = [c for c in df.columns if told[c]["n_rows"] and not told[c]["nulls"] and told[c]["about_distinct"] >= 0.9 * told[c]["n_rows"]]
    found = {r["column_name"] for r in key_statistics(df.select(*[F.col(f"`{c}`") for c in likely])).where("is_key").collect()} if likely else set()
    return [c for c in df.columns if c in found]
