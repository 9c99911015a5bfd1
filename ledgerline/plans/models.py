"""Whole prepared models made from a feed's contract."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame

from ..contracts import ContractError, Feed
from ..operators import scd2, snapshot


def prepared(feed: Feed, derived: dict[str, Column] | None = None) -> Callable[..., DataFrame]:
    """raw -> the date-partitioned prepared table of a feed, restricted by window and knowledge."""
    kinds = {c: feed.kind(c) for c in feed.columns}

    def build(raw: DataFrame, target: DataFrame | None = None, lookback_days: int = 3, knowledge: str | None = None) -> DataFrame:
        rows = snapshot.known_as_of(raw, knowledge, incremental=target is not None)
        rows = snapshot.incremental_window(rows, "_cob_date", target, "cob_date", lookback_days)
        return snapshot.conform(rows, kinds, list(feed.keys), derived)

    return build


def dimension(feed: Feed, hashed: list[str], derived: dict[str, Column] | None = None) -> Callable[..., DataFrame]:
    """raw -> the versions of a feed: full without a target, else by replay. Refused: hashing a
    key, hashing what isn't a column, and deriving a column that exists."""
    derived = derived or {}
    if bad := [c for c in hashed if c in feed.keys]:
        raise ContractError(f"keys are not hashed: {bad}")
    if bad := [c for c in hashed if c not in feed.columns]:
        raise ContractError(f"hashed columns must be columns of the feed: {bad}")
    if bad := [c for c in derived if c in feed.columns]:
        raise ContractError(f"derived columns exist already: {bad}")
    kinds = {c: feed.kind(c) for c in feed.columns}

    def build(raw: DataFrame, target: DataFrame | None = None, lookback_days: int = 3, knowledge: str | None = None, full_refresh: bool = False, lose_pruned: bool = False) -> DataFrame:
        if target is None or full_refresh:
            if target is not None:
                scd2.refuse_pruned(target, raw, lose_pruned)
            return scd2.build_full(raw, kinds, list(feed.keys), hashed, derived, knowledge)
        if knowledge is not None:
            raise ContractError("an as-of build is a full build")
        return scd2.replay(raw, target, kinds, list(feed.keys), hashed, lookback_days, derived)

    return build


def run_in_order(models: dict[str, tuple[list[str], Callable[..., None]]], changed: set[str]) -> list[str]:
    """Runs the models downstream of changed tables, parents first; returns their names. Each model
    is (its inputs, what builds it)."""
    done: list[str] = []
    dirty, left = set(changed), dict(models)
    while left:
        ready = [n for n, (parents, _) in left.items() if not any(p in left for p in parents)]
        if not ready:
            raise ContractError(f"models depend on each other: {sorted(left)}")
        for n in sorted(ready):
            parents, build = left.pop(n)
            if dirty & set(parents):
                build()
                dirty.add(n)
                done.append(n)
    return done


def business_dates(raw: DataFrame) -> list[date]:
    """The distinct dates of a raw table (some thousand at most), oldest first."""
    return [r[0] for r in raw.select("_cob_date").distinct().orderBy("_cob_date").collect()]
