"""Strict validation of delimited files by byte ranges.

A row can't be told from a place inside a quoted value without having read what lies before. So each
range is read for every state that it may begin in, which gives a table: the state it ends in, the
rows that it completes, and what it has of the rows at both edges. Tables of neighbouring ranges
compose, so any number of tasks can read one file, and their tables, put together in order, tell
what a reading from the first byte would.
"""

from __future__ import annotations

import codecs
import csv
import io
import sys
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import Feed
from ..files import Files
from .delivery import Rejected, csv_rows, decoded

#: Before a row, before a value, in a plain value, in a quoted value, after a quote in one.
ROW, VALUE, PLAIN, QUOTED, CLOSED = "row", "value", "plain", "quoted", "closed"
STATES = (ROW, VALUE, PLAIN, QUOTED, CLOSED)
#: A line feed ends a row or lies in a quoted value, so ranges that begin after one begin in these.
AFTER_LINE = (ROW, QUOTED)
TABLE = "path string, begin long, end long, states array<struct<start:string,end:string,problem:string,head:int,met:boolean,rows:long,width:int,odd_at:long,odd_width:int,tail:int,breaks:boolean>>"


@dataclass(frozen=True)
class Run:
    """What a range is if it begins in ``start``.

    ``head``: separators up to the end of the row that was begun before, or of the range; ``met``
    tells that this row ends (or that none was begun). ``rows`` are completed inside, the first
    ``width`` values wide; ``odd_at`` is the first of another width, ``odd_width``. ``tail``: the
    separators of the row left unfinished. ``breaks``: a line break in a value.
    """

    start: str
    end: str
    problem: str | None = None
    head: int = 0
    met: bool = False
    rows: int = 0
    width: int | None = None
    odd_at: int | None = None
    odd_width: int | None = None
    tail: int = 0
    breaks: bool = False

    def with_row(self, width: int) -> Run:
        """One more completed row."""
        odd = self.rows and self.odd_at is None and width != self.width
        return replace(self, rows=self.rows + 1, width=width if not self.rows else self.width, odd_at=self.rows if odd else self.odd_at, odd_width=width if odd else self.odd_width)

    def then(self, table: dict[str, Run]) -> Run:
        """This range and the next one, by its table."""
        if self.problem:
            return self
        after = table[self.end]
        if after.problem:
            return Run(self.start, self.start, after.problem)
        out = replace(self, end=after.end, breaks=self.breaks or after.breaks)
        if self.end != ROW:  # a row reaches over the edge
            if not after.met:
                return replace(out, head=self.head + after.head) if not self.met else replace(out, tail=self.tail + after.head)
            out = out.with_row(self.tail + after.head + 1) if self.met else replace(out, head=self.head + after.head, met=True)
        if after.rows:
            if not out.rows:
                out = replace(out, rows=after.rows, width=after.width, odd_at=after.odd_at, odd_width=after.odd_width)
            else:
                before = out.rows
                if out.odd_at is None and after.width != out.width:
                    out = replace(out, odd_at=before, odd_width=after.width)
                elif out.odd_at is None and after.odd_at is not None:
                    out = replace(out, odd_at=before + after.odd_at, odd_width=after.odd_width)
                out = replace(out, rows=before + after.rows)
        return replace(out, tail=after.tail)


def _lead(start: str, feed: Feed) -> str:
    """Text that brings a reader into a state, without a value or row of its own beside it."""
    plain = next(c for c in "xyz" if c not in (feed.separator, feed.quote))
    return {ROW: "", VALUE: feed.separator, PLAIN: plain, QUOTED: feed.quote, CLOSED: feed.quote * 2}[start]


def read_range(text: str, start: str, feed: Feed) -> Run:
    """Reads one range from a state, by the csv module's strict rules."""
    csv.field_size_limit(sys.maxsize)  # a value may be of any length
    lead = _lead(start, feed)
    if not text:
        return Run(start, start, met=start == ROW)
    lines = list(io.StringIO(lead + text, newline=""))
    told = lambda rows: csv.reader(rows, delimiter=feed.separator, quotechar=feed.quote, doublequote=True, strict=True)
    reader, finished, last, quoted = told(lines), [], 0, False
    try:
        for row in reader:
            finished.append(row)
            begun, last = last, reader.line_num
    except csv.Error as e:
        if "unexpected end" not in str(e):
            return Run(start, start, problem=str(e))
        quoted, begun = True, last
    rest: list[str] = []
    if quoted:
        end, rest = QUOTED, next(told([*lines[begun:], feed.quote]))
    elif lines[-1][-1] in "\r\n":
        end = ROW
    else:
        rest, end = finished.pop(), PLAIN
        try:
            probe = next(told([*lines[begun:-1], lines[-1] + _lead(PLAIN, feed)]))
            end = VALUE if rest[-1] == "" and probe[-1] == _lead(PLAIN, feed) else PLAIN
        except csv.Error:
            end = CLOSED
    breaks = any("\n" in v or "\r" in v for row in (*finished, rest) for v in row)
    extra = start == VALUE  # the separator that led here isn't the range's
    if start == ROW:
        out = Run(start, end, met=True, breaks=breaks, tail=max(0, len(rest) - 1))
    elif not finished:
        return Run(start, end, head=len(rest) - 1 - extra, breaks=breaks)
    else:
        out = Run(start, end, head=len(finished[0]) - 1 - extra, met=True, breaks=breaks, tail=max(0, len(rest) - 1))
        finished = finished[1:]
    widths = np.fromiter((len(r) for r in finished if r), np.int64)
    if len(widths):
        odd = np.flatnonzero(widths != widths[0])
        out = replace(out, rows=len(widths), width=int(widths[0]), odd_at=int(odd[0]) if len(odd) else None, odd_width=int(widths[odd[0]]) if len(odd) else None)
    return out


def range_table(text: str, feed: Feed, states: tuple[str, ...] = STATES) -> dict[str, Run]:
    return {s: read_range(text, s, feed) for s in states}


def compose(a: dict[str, Run], b: dict[str, Run]) -> dict[str, Run]:
    """The table of two neighbouring ranges."""
    return {s: r.then(b) for s, r in a.items()}


def settled(run: Run, feed: Feed) -> int:
    """The number of data rows of a whole file, from its run, or Rejected."""
    if run.problem:
        raise Rejected(run.problem)
    if run.end == QUOTED:
        raise Rejected("unexpected end of data")
    if run.end != ROW:
        run = run.with_row(run.tail + 1)
    if run.breaks and not feed.multiline:
        raise Rejected("a line break in a value")
    width = run.width if feed.header and run.rows else len(feed.columns)
    if run.rows and run.width != width:
        raise Rejected(f"row 1 has {run.width} values, not {width}")
    if run.odd_at is not None:
        raise Rejected(f"row {run.odd_at + 1} has {run.odd_width} values, not {width}")
    return max(0, run.rows - 1) if feed.header else run.rows


def by_lines(encoding: str) -> bool:
    """Whether a line feed is one byte, and only that, in an encoding."""
    try:
        return "\n".encode(encoding) == b"\n" and "ab".encode(encoding) == b"ab"
    except LookupError as e:
        raise Rejected(f"no encoding {encoding}") from e


def tables(spark: SparkSession, feed: Feed, paths: list[str], lines: int = 20_000) -> DataFrame:
    """(path, begin, end, states) of the ranges of some files: as many as Spark reads them in, whatever
    their size. A task holds some lines at a time, and a row that reaches over many of them is
    carried by its counts alone. States of a range that doesn't decode have that as their problem."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    cut = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("begin"), F.col("value").cast("binary").alias("line"))
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    fields = [(n, kinds[k]) for n, k in (f.split(":") for f in TABLE.partition("struct<")[2].rstrip(">").split(","))]

    def part(found: list[bytes], first: bool) -> dict[str, Run]:
        body = b"\n".join(found) + b"\n"
        try:
            # only the first bytes of a file can be its mark
            text = decoded(body, feed.encoding) if first else body.decode(feed.encoding)
        except (Rejected, UnicodeDecodeError) as e:
            problem = str(e) if isinstance(e, Rejected) else f"not {feed.encoding}: {e}"
            return {s: Run(s, s, problem=problem) for s in AFTER_LINE}
        return range_table(text, feed, AFTER_LINE)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, state, size = None, None, 0

        def told():
            rows = pa.array([[asdict(state[s]) for s in AFTER_LINE]], pa.list_(pa.struct(fields)))
            return pa.RecordBatch.from_arrays([pa.array([place[0]]), pa.array([place[1]], pa.int64()), pa.array([place[1] + size], pa.int64()), rows], ["path", "begin", "end", "states"])

        for batch in batches:
            path, begin = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            edges = [0, *(i for i in range(1, len(path)) if path[i] != path[i - 1] or begin[i] != begin[i - 1]), len(path)]
            for a, b in zip(edges, edges[1:], strict=False):
                for c in range(a, b, lines):
                    here = (path[c], int(begin[c]))
                    if here != place and place is not None:
                        yield told()
                    fresh = here != place
                    found = batch.column(2).slice(c, min(lines, b - c)).to_pylist()
                    table = part(found, fresh and here[1] == 0)
                    state = table if fresh else compose(state, table)
                    size = sum(len(x) + 1 for x in found) + (0 if fresh else size)
                    place = here
        if place is not None:
            yield told()

    return cut.mapInArrow(scan, TABLE)


def whole_files(spark: SparkSession, feed: Feed, paths: list[str]) -> dict[str, tuple[int | None, str | None]]:
    """As ``validated``, for encodings in which a line feed isn't one byte: a task reads a whole file,
    which must fit in its memory."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, problem = None, None
                try:
                    n = len(csv_rows(content, feed))
                except Rejected as e:
                    problem = str(e)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([problem], pa.string())], ["path", "n", "problem"])

    read = spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(scan, "path string, n long, problem string")
    return {r["path"]: (r["n"], r["problem"]) for r in read.collect()}


def marked(spark: SparkSession, path: str) -> bool:
    """Whether a file begins with a UTF-8 mark, which Spark's reader of lines leaves out."""
    return Files(spark, path).head(3) == codecs.BOM_UTF8


def validated(spark: SparkSession, feed: Feed, paths: list[str]) -> dict[str, tuple[int | None, str | None]]:
    """path -> (data rows, None) or (None, what is wrong), equal to a strict reading from the first
    byte. One small row for each range comes back. Files without any line aren't named."""
    if not by_lines(feed.encoding):
        return whole_files(spark, feed, paths)
    if feed.encoding.upper() not in ("UTF-8", "UTF8") and (odd := [p for p in paths if marked(spark, p)]):
        return {p: (None, f"a UTF-8 mark in {feed.encoding}") for p in odd}
    found: dict[str, list] = {}
    for r in tables(spark, feed, paths).collect():
        found.setdefault(r["path"], []).append((r["begin"], {s["start"]: Run(**s.asDict()) for s in r["states"]}))
    out: dict[str, tuple[int | None, str | None]] = {}
    for path, ranges in found.items():
        whole = reduce(compose, (t for _, t in sorted(ranges, key=lambda x: x[0])))
        try:
            out[path] = (settled(whole[ROW], feed), None)
        except Rejected as e:
            out[path] = (None, str(e))
    return out
