"""Immutable objects, manifests, quarantine, routing and legacy results."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..contracts import Feed
from ..files import Exists, Files


class Immutable(RuntimeError):
    """An object exists with other bytes."""


class Objects(Files):
    """Create-once objects below a root."""

    def put(self, name: str, data: bytes) -> bool:
        """Whether the object is new; equal bytes again are no error, other bytes are."""
        try:
            self.create(name, data)
        except Exists as e:
            if self.get(name) != data:
                raise Immutable(name) from e
            return False
        return True

    def manifest(self, delivery: str, parts: list[dict], contract: dict) -> str:
        """The rebuildable read plan of a delivery: its parts and the frozen dialect."""
        name = f"manifests/{delivery}.json"
        self.put(name, json.dumps({"delivery_id": delivery, "parts": parts, "contract": contract}, sort_keys=True).encode())
        return name

    def quarantine(self, name: str, data: bytes, reason: str) -> dict:
        """Keeps a refused file beside the reason; returns the fact to record."""
        self.put(f"quarantine/{name}", data)
        fact = {"object": name, "reason": reason, "bytes": len(data)}
        self.put(f"quarantine/{name}.reason.json", json.dumps(fact, sort_keys=True).encode())
        return fact


def route(names: list[str], feeds: list[Feed]) -> dict[str, str | None]:
    """File name -> the feed whose pattern it fits; None if none or several do."""
    out: dict[str, str | None] = {}
    for name in names:
        fit = [f.name for f in feeds if re.fullmatch(f.pattern, name)]
        out[name] = fit[0] if len(fit) == 1 else None
    return out


def stable(polls: list[dict[str, int]], unchanged: int = 2) -> list[str]:
    """Files whose size was the same in the last ``unchanged`` polls."""
    last = polls[-unchanged:]
    return sorted(n for n, s in last[-1].items() if len(last) == unchanged and all(p.get(n) == s for p in last))


@dataclass(frozen=True)
class LegacyResults:
    """Legacy results kept as JSON files: {"reference", "rows": [...], "aggregates": {...}, ...}."""

    spark: SparkSession
    root: str

    def fetch(self, feed: str, cob: str) -> DataFrame:
        files = self.spark.read.option("multiLine", True).json(f"{self.root}/{feed}/{cob}")
        return files.selectExpr("inline(rows)")

    def evidence(self, feed: str, cob: str) -> DataFrame:
        files = self.spark.read.option("multiLine", True).json(f"{self.root}/{feed}/{cob}")
        return files.drop("rows", "aggregates")
