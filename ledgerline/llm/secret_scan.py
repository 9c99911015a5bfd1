"""Secret scan by a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is analysed into a Boolean query over trigrams that every match must
contain. The index holds the postings (trigram, document) of all trigrams that some rule's query
mentions, taken over whole lower-cased texts. Postings are intersected and united as the queries
say, and only the candidates are verified by the expression itself; a rule whose expression has no
mandatory trigram is verified on every document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged

#: An exact set of strings is flushed into the query beyond this size.
SET_LIMIT = 32


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java and Python share; ``group`` and ``least``: that group
    must have so many characters, else the match is dropped (and its characters stay consumed)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
)
MORE = (
    Rule("private_key", r"-----BEGIN (RSA |EC |OPENSSH |DSA |PGP )?PRIVATE KEY( BLOCK)?-----"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("live_key", r"sk_live_[A-Za-z0-9]{16,}"),
)


# ------------------------------------------------------------------ from expressions to queries


@dataclass
class _Part:
    """What must hold of the text matched so far: the clauses (each a set of alternatives, each a
    set of trigrams), and the exact strings that may end it (None: anything)."""

    clauses: list[frozenset[frozenset[str]]] = field(default_factory=list)
    tails: frozenset[str] = frozenset([""])

    def flush(self) -> None:
        options = frozenset(frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in self.tails)
        if options and all(options):
            self.clauses.append(options)
        self.tails = frozenset([""])


def _strings(node) -> frozenset[str] | None:
    """The exact strings of a parsed node if they are few, else None."""
    op, arg = node
    name = str(op)
    if name == "LITERAL":
        return frozenset([chr(arg).lower()])
    if name == "IN":
        found = set()
        for kind, value in arg:
            if str(kind) != "LITERAL" or len(found) > 8:
                return None
            found.add(chr(value).lower())
        return frozenset(found)
    if name == "SUBPATTERN":
        return _sequence_strings(arg[-1])
    if name == "BRANCH":
        parts = [_sequence_strings(x) for x in arg[1]]
        return None if any(p is None for p in parts) else frozenset().union(*parts)
    if name == "MAX_REPEAT" and arg[1] == 1:
        inner = _sequence_strings(arg[2])
        return None if inner is None else inner | {""} if arg[0] == 0 else inner
    return None


def _sequence_strings(nodes) -> frozenset[str] | None:
    now = frozenset([""])
    for node in nodes:
        more = _strings(node)
        if more is None or len(now) * len(more) > SET_LIMIT:
            return None
        now = frozenset(a + b for a in now for b in more)
    return now


def trigram_query(pattern: str) -> list[frozenset[frozenset[str]]]:
    """Clauses, all of which a matching text fulfils: one of a clause's alternatives has all its
    trigrams in the lower-cased text. No clause: the expression has no mandatory trigram."""
    part = _Part()

    def walk(nodes) -> None:
        for node in nodes:
            exact = _strings(node)
            if exact is not None and len(part.tails) * len(exact) <= SET_LIMIT:
                part.tails = frozenset(a + b for a in part.tails for b in exact)
                continue
            part.flush()
            op, arg = node
            if str(op) == "SUBPATTERN":
                walk(arg[-1])
            elif str(op) == "MAX_REPEAT" and arg[0] > 0:
                walk(arg[2])
            part.flush()

    walk(_parser.parse(pattern))
    part.flush()
    return part.clauses


def _bits(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules for c in trigram_query(r.pattern) for alt in c for t in alt})


# ------------------------------------------------------------------ the index and the scan


def postings(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(trigram, doc_id): the inverted index of the trigrams that the rules' queries mention."""
    low = F.lower("text")
    has = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in _bits(rules)]))
    return docs.select("doc_id", low.alias("low")).select("doc_id", F.explode(has).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, may): for each document with postings, whether each rule's query holds."""
    names = _bits(rules)
    place = F.array_position(F.array(*map(F.lit, names)), F.col("trigram")).cast("int") - 1
    words = range(0, len(names), 60)
    sets = index.withColumn("place", place).groupBy("doc_id").agg(*[F.bit_or(F.when((F.col("place") >= w) & (F.col("place") < w + 60), F.expr(f"shiftleft(1L, place - {w})")).otherwise(F.lit(0).cast("long"))).alias(f"m{w}") for w in words])

    def holds(alt: frozenset[str]) -> Column:
        out = F.lit(True)
        for w in words:
            mask = sum(1 << (names.index(t) - w) for t in alt if w <= names.index(t) < w + 60)
            if mask:
                out = out & (F.col(f"m{w}").bitwiseAND(F.lit(mask)) == F.lit(mask))
        return out

    def query(rule: Rule) -> Column:
        out = F.lit(True)
        for clause in trigram_query(rule.pattern):
            either = F.lit(False)
            for alt in sorted(clause, key=sorted):
                either = either | holds(alt)
            out = out & either
        return out

    found = sets.select("doc_id", *[query(r).alias(f"may_{r.kind}") for r in rules if trigram_query(r.pattern)])
    some = F.lit(False)
    for c in found.columns[1:]:
        some = some | F.col(c)
    return found.where(some)


def _spans(rule: Rule, order: int) -> Column:
    """Leftmost matches as structs (start, order, kind, end) in code points: the pieces between
    matches and the matches themselves give the places."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    hits = F.regexp_extract_all(text, pattern, 0)
    sizes = F.zip_with(F.slice(F.split(text, rule.pattern, -1), 1, F.size(hits)), hits, lambda piece, hit: F.struct(F.char_length(piece).alias("before"), F.char_length(hit).alias("size"), (F.char_length(F.regexp_extract(hit, rule.pattern, rule.group)) >= rule.least).alias("good")))
    kind = "array<struct<start:int,ord:int,kind:string,end:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(acc, x):
        start = acc["at"] + x["before"]
        one = F.array(F.struct(start.alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), (start + x["size"]).alias("end")))
        return F.struct((start + x["size"]).alias("at"), F.when(x["good"], F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(sizes, zero, step, lambda acc: acc["out"])


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """(doc_id, found) for every row of ``docs`` (doc_id, text): an array of (start, ord, kind,
    end) by start, then by the rules' order. A null text counts as empty. Rows with one doc_id, or
    a null one, share their candidates and are each verified on their own text."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    may = staged(candidates(postings(docs, rules), rules), "candidates")
    # few documents are candidates, so the texts stay where they are
    rows = docs.join(broadcast_if_small(may.withColumnRenamed("doc_id", "_doc")), F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    empty = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>")
    parts = []
    for order, rule in enumerate(rules):
        able = F.col("text").rlike(rule.pattern)
        if trigram_query(rule.pattern):
            able = F.coalesce(F.col(f"may_{rule.kind}"), F.lit(False)) & able
        parts.append(F.when(able, _spans(rule, order)).otherwise(empty))
    return rows.select("doc_id", F.array_sort(F.concat(*parts)).alias("found"))


def secret_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of ``docs`` (doc_id,
    text). Repeated rows come back each; further columns are ignored; no rows give no rows."""
    told = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    found = find_secrets(docs)
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["ord"] < len(BASE))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), *[count(r.kind) for r in BASE], F.sha2(told(base), 256).alias("base_sha256"), told(F.col("found")).alias("spans"))


def scan_text(text: str, rules: tuple[Rule, ...] = BASE) -> list[tuple[int, int, str]]:
    """The same spans of one text by plain matching, for tests: (start, end, kind)."""
    found = []
    for order, rule in enumerate(rules):
        found += [(m.start(), order, m.end(), rule.kind) for m in re.finditer(rule.pattern, text, re.ASCII) if len(m[rule.group]) >= rule.least]
    return [(s, e, k) for s, _, e, k in sorted(found)]
