"""Feed contracts: what a delivery must look like, and identities derived from that."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field, replace
from datetime import date
from itertools import groupby


class ContractError(ValueError):
    """A contract that can't be honoured; never retried."""


SUPERSESSION = ("full_snapshot",)
KINDS = ("string", "upper", "decimal", "integer", "date", "boolean")


def platform_name(source: str) -> str:
    """Snake case of a source header."""
    name = re.sub(r"[^0-9A-Za-z]+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", source.strip())).strip("_").lower()
    return name or "column"


def platform_names(sources: list[str]) -> dict[str, str]:
    """Platform name -> source header in order; collisions get _2, _3 and so on."""
    out: dict[str, str] = {}
    for source in sources:
        name, n = platform_name(source), 1
        while (name if n == 1 else f"{name}_{n}") in out:
            n += 1
        out[name if n == 1 else f"{name}_{n}"] = source
    return out


@dataclass(frozen=True)
class Feed:
    """``columns`` maps platform names to source headers in declared order; ``kinds`` maps some
    platform names to their conformed kind, others are inferred by name."""

    name: str
    pattern: str
    keys: tuple[str, ...]
    columns: dict[str, str]
    kinds: dict[str, str] = field(default_factory=dict)
    separator: str = ","
    quote: str = '"'
    escape: str = '"'
    header: bool = True
    encoding: str = "UTF-8"
    multiline: bool = False
    contract_version: int = 2
    schema_drift: str = "warn"
    expected_min_rows: int | None = None
    expected_max_rows: int | None = None
    cadence: str = "daily"
    supersession: str = "full_snapshot"
    source_system: str = "unknown"
    deadline: str = "06:00"
    member_pattern: str | None = None

    def __post_init__(self):
        if self.supersession not in SUPERSESSION:
            raise ContractError(f"supersession {self.supersession} is not supported")
        if self.schema_drift not in ("warn", "fail"):
            raise ContractError(f"schema_drift {self.schema_drift}")
        if missing := [k for k in self.keys if k not in self.columns]:
            raise ContractError(f"keys {missing} are not columns of {self.name}")
        if bad := {k for k in self.kinds.values() if k not in KINDS}:
            raise ContractError(f"kinds {bad}")

    @property
    def schema_version(self) -> str:
        """Twelve hex digits over the ordered column mapping; types and dialect don't count."""
        lines = "\n".join(f"{platform}\t{source}" for platform, source in self.columns.items())
        return hashlib.sha1(lines.encode()).hexdigest()[:12]

    def kind(self, column: str) -> str:
        return self.kinds.get(column) or inferred_kind(column)

    def parse_name(self, filename: str) -> tuple[date, int]:
        """Business date and file version (1 if absent) of a delivered file's name."""
        m = re.fullmatch(self.pattern, filename)
        if not m:
            raise ContractError(f"{filename} does not match {self.pattern}")
        d = m["cob_date"].replace("-", "")
        return date(int(d[:4]), int(d[4:6]), int(d[6:8])), int(m.groupdict().get("version") or 1)

    def render_name(self, cob: date, version: int = 1) -> str:
        """The file name of a date and version; the inverse of ``parse_name`` for patterns that
        are literal apart from the two groups."""
        body = re.sub(r"\(\?P<cob_date>[^)]*\)", cob.strftime("%Y%m%d"), self.pattern)
        body = re.sub(r"\(\?:_v\(\?P<version>[^)]*\)\)\?", "" if version == 1 else f"_v{version}", body)
        return body.replace("\\", "")


def derive_pattern(example: str) -> str:
    """A pattern from one file name: its first run of exactly eight digits is the date, a version
    behind that may be there or not, everything else is taken as it stands."""
    out, dated = "", False
    for digits, run in groupby(re.split(r"(\d+)", example), key=str.isdigit):
        for part in run:
            if digits and len(part) == 8 and not dated:
                out, dated = out + r"(?P<cob_date>\d{8})", True
            else:
                out += re.escape(part)
    if not dated:
        raise ContractError(f"{example} has no date of eight digits")
    date_, behind = out.split(r"(?P<cob_date>\d{8})", 1)
    behind = re.sub(r"^_v\d+(?!\d)", "", behind)
    return date_ + r"(?P<cob_date>\d{8})(?:_v(?P<version>\d+))?" + behind


def inferred_kind(column: str) -> str:
    """The kind that a column's name suggests."""
    if re.search(r"(^|_)date$|^date_", column):
        return "date"
    if re.match(r"(is|has)_", column) or column.endswith("_flag"):
        return "boolean"
    if re.search(r"(amount|value|notional|price|pct|rate)$", column):
        return "decimal"
    if re.search(r"(count|quantity|number)$", column):
        return "integer"
    if re.search(r"(currency|_code|_type|country)$", column):
        return "upper"
    return "string"


def resolve(defaults: dict, parents: dict[str, dict], own: dict) -> dict:
    """Layered settings: defaults, then the chain of ``parent`` conventions from the root down,
    then the feed's own; each layer replaces whole keys."""
    chain, seen, name = [], set(), own.get("parent")
    while name:
        if name in seen or name not in parents:
            raise ContractError(f"parent {name} is unknown or repeats")
        seen.add(name)
        chain.append(parents[name])
        name = parents[name].get("parent")
    out = dict(defaults)
    for layer in [*reversed(chain), own]:
        out.update({k: v for k, v in layer.items() if k != "parent"})
    return out


def delivery_id(system: str, feed: str, business: str, digest: str) -> str:
    """An opaque identity: equal hand-offs get equal ids."""
    return "dlv_" + hashlib.sha256("\x1f".join((system, feed, business, digest)).encode()).hexdigest()[:32]


def renamed(feed: Feed, **changes) -> Feed:
    return replace(feed, **changes)
