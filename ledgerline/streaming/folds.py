"""State that a stream keeps: files whose size has settled, and the stage of each transport.

Both are processors with state of their own for each key, kept in the query's checkpoint, so a
restarted query goes on where it stopped. The state of a key is a row or a few; keys aren't forgotten,
so each landing folder of its own (say, a month's) should have a query of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keeping_state(spark: SparkSession) -> None:
    """State with several variables and timers needs this store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class Settling(StatefulProcessor):
    """From polls (name, size, polled_at): each file once, when its size was the same in ``polls``
    polls that follow each other. A file that changes later is told again. Polls that come late,
    from before the last one seen, don't count."""

    def __init__(self, polls: int):
        self.polls = polls

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "size long, polled_at double, times int, told boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        size, at, times, told = self.last.get() if self.last.exists() else (None, float("-inf"), 0, False)
        out = []
        polls = sorted((float(t), int(s)) for part in rows for t, s in zip(part["polled_at"], part["size"], strict=True))
        for t, s in polls:
            if t <= at:
                continue
            times, told = (times + 1, told) if s == size else (1, False)
            size, at = s, t
            if times >= self.polls and not told:
                out.append((key[0], size, at))
                told = True
        if size is not None:
            self.last.update((size, at, times, told))
        if out:
            yield pd.DataFrame(out, columns=["name", "size", "settled_at"])


def settled_files(polls: DataFrame, times: int = 2) -> DataFrame:
    """(name, size, settled_at) of a stream of polls (name, size, polled_at in seconds)."""
    keeping_state(polls.sparkSession)
    return polls.groupBy("name").transformWithStateInPandas(Settling(times), "name string, size long, settled_at double", "Append", "None")


class Stages(StatefulProcessor):
    """From events (transport_id, status, occurred_at): the stage of each transport that a batch has
    events of, by the rules of ``receipt_state``. Of each status its newest time is kept, which is all
    that the rules look at, so events may come in any order and more than once."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getMapState("newest", "status string", "occurred_at double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = {s[0]: t[0] for s, t in self.newest.iterator()}
        for part in rows:
            for status, t in zip(part["status"], part["occurred_at"], strict=True):
                if t > seen.get(status, float("-inf")):
                    seen[status] = float(t)
                    self.newest.updateValue((status,), (float(t),))
        failed = seen.get("FAILED", float("-inf"))
        since = [(-2 if s == "FAILED" else self.ranks.get(s, -1), t, s) for s, t in seen.items() if t >= failed]
        yield pd.DataFrame([(key[0], max(since)[2])], columns=["transport_id", "status"])


def stages(events: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """(transport_id, status) for each transport of a batch, as it stands after the batch."""
    keeping_state(events.sparkSession)
    return events.groupBy("transport_id").transformWithStateInPandas(Stages(ranks), "transport_id string, status string", "Update", "None")
