"""Durable facts about deliveries, runs, versions and the states of report dates.

Every fact is a small file that is created once below the registry's folder; the inputs and the
evidence of a run are Parquet, written by Spark as they are. Whatever is derived (the state of a
date, differences between runs, the deliveries behind a version) is a query over these, so nothing
is lost with the driver and no history is held in it.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Exists, Files


class Refused(RuntimeError):
    """A gate said no; a retry won't help."""


SCHEMAS = {
    "deliveries": "delivery_id string, feed string, cob_date string, version int, rows long, md5 string, name string, recorded_at double",
    "runs": "run string, report string, as_at string, status string, code map<string,string>, carried_forward array<string>, recorded_at double",
    "receipts": "transport_id string, status string, detail string, recorded_at double",
    "evidence": "evidence_id string, check_name string, outcome string, severity string, failures long, detail string, subject string, recorded_at double",
    "submissions": "submission_id string, report string, as_at string, version int, recipient string, recorded_at double",
    "deletions": "delivery_id string, reason string, recorded_at double",
    "versions": "report string, as_at string, version int, run string, tag string, recorded_at double",
    "transitions": "report string, as_at string, state string, actor string, reason string, approved_by string, submission_id string, seq int, recorded_at double",
    "intents": "intent string, kind string, branch string, tag string, told map<string,string>, recorded_at double",
    "settled": "intent string, outcome string, recorded_at double",
}
#: States in which a date takes no publication with other inputs, and those that can be written.
CLOSED = ("locked", "submitted")
WRITABLE = (*CLOSED, "reopened")


def _safe(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.:-]+", name):
        raise Refused(f"not a name: {name}")
    return name


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)

    # -- facts

    def record(self, kind: str, **fact) -> None:
        """One more fact; facts are never changed."""
        self._create(kind, f"{time.time_ns():020d}-{uuid.uuid4().hex}", fact)

    def record_once(self, kind: str, name: str, /, **fact) -> bool:
        """A fact that can be there once; whether it is new."""
        try:
            self._create(kind, _safe(name), fact)
        except Exists:
            return False
        return True

    # -- intents: what is about to be published, and whether it came to an end

    def intend(self, intent: str, kind: str, branch: str, tag: str, **told: str) -> None:
        """Recorded before a merge: all that is needed to finish the publication without its maker."""
        self.record_once("intents", intent, intent=intent, kind=kind, branch=branch, tag=tag, told=told)

    def settle(self, intent: str, outcome: str) -> None:
        self.record_once("settled", intent, intent=intent, outcome=outcome)

    def open_intents(self, kind: str) -> list[dict]:
        """Intents that have no outcome, oldest first. Listings of names tell which; only theirs are read."""
        done = set(self.files.list("settled"))
        found = [json.loads(self.files.get(f"intents/{n}")) for n in self.files.list("intents") if n not in done]
        return sorted((f for f in found if f["kind"] == kind), key=lambda f: f["recorded_at"])

    def _create(self, kind: str, name: str, fact: dict) -> None:
        known = {c.split()[0] for c in re.split(r", (?=\w+ )", SCHEMAS[kind])}
        if odd := set(fact) - known:
            raise ValueError(f"{kind} have no {sorted(odd)}")
        self.files.create(f"{kind}/{name}.json", json.dumps({**fact, "recorded_at": time.time()}, sort_keys=True).encode())

    def frame(self, kind: str) -> DataFrame:
        """All facts of a kind, of ``inputs`` too."""
        if kind == "inputs":
            schema = "run string, model string, delivery_id string, max_cob_date date"
            if not self.files.list("inputs"):
                return self.spark.createDataFrame([], schema)
            return self.spark.read.schema(schema).option("basePath", f"{self.files.root}/inputs").parquet(f"{self.files.root}/inputs")
        if not self.files.list(kind):
            return self.spark.createDataFrame([], SCHEMAS[kind])
        return self.spark.read.schema(SCHEMAS[kind]).option("recursiveFileLookup", True).json(f"{self.files.root}/{kind}")

    def record_inputs(self, run: str, inputs: DataFrame) -> None:
        """The input set of a run, as (model, delivery_id, max_cob_date)."""
        inputs.write.parquet(f"{self.files.root}/inputs/run={_safe(run)}")

    # -- numbered facts of one report and date: the next number can be created once only

    def _numbered(self, kind: str, report: str, as_at: str) -> list[dict]:
        folder = f"{kind}/{_safe(report)}/{_safe(as_at)}"
        return [json.loads(self.files.get(f"{folder}/{n}")) for n in self.files.list(folder)]

    def _next(self, kind: str, report: str, as_at: str, number: int, fact: dict) -> bool:
        try:
            self._create(kind, f"{_safe(report)}/{_safe(as_at)}/{number:06d}", {"report": report, "as_at": as_at, **fact})
        except Exists:
            return False
        return True

    def state(self, report: str, as_at: str) -> str:
        """open without a transition, else what the newest one says; reopened dates are open again."""
        own = self._numbered("transitions", report, as_at)
        return own[-1]["state"] if own else "open"

    def move(self, report: str, as_at: str, to: str, actor: str, reason: str, owner: str, approved_by: str | None = None, submission_id: str | None = None) -> None:
        """Adds a transition of a report's date. Each names an actor and a reason. Locking and
        submitting need no approval; reopening needs a closed date and, once it was submitted, the
        approval of the report's owner, as a figure is out that somebody holds."""
        if to not in WRITABLE:
            raise Refused(f"{to} is no state that can be written")
        if not actor.strip() or not reason.strip():
            raise Refused("a transition names an actor and a reason")
        own = self._numbered("transitions", report, as_at)
        now = own[-1]["state"] if own else "open"
        if to == "reopened":
            if now not in CLOSED:
                raise Refused(f"{report} {as_at} is {now}: nothing to reopen")
            if now == "submitted" and (approved_by or "").strip().lower() != owner.strip().lower():
                raise Refused(f"reopening what was submitted needs the approval of {owner}")
        fact = {"state": to, "actor": actor.strip(), "reason": reason.strip(), "approved_by": (approved_by or "").strip() or None, "submission_id": submission_id, "seq": len(own)}
        if not self._next("transitions", report, as_at, len(own), fact):
            raise Refused(f"{report} {as_at} was moved by another meanwhile")

    def versions(self, report: str, as_at: str) -> list[dict]:
        return self._numbered("versions", report, as_at)

    def allocate(self, report: str, as_at: str, run: str, tag: str) -> int:
        """The next version number of a report and date; the same tag keeps its number."""
        while True:
            own = self.versions(report, as_at)
            for v in own:
                if v["tag"] == tag:
                    return v["version"]
            number = max([0, *(v["version"] for v in own)]) + 1
            if self._next("versions", report, as_at, number, {"version": number, "run": run, "tag": tag}):
                return number

    # -- what follows from the facts

    def inputs_of(self, run: str) -> DataFrame:
        return self.frame("inputs").where(F.col("run") == run)

    def input_diff(self, a: str, b: str) -> DataFrame:
        """(model, delivery_id, status) between two runs: added, removed or unchanged."""
        from .publish import input_diff

        return input_diff(self.inputs_of(a), self.inputs_of(b), ["model", "delivery_id"])

    def inputs_changed(self, run: str, before: str, as_at: str) -> DataFrame:
        """(delivery_id, standing) of changed deliveries: on_date, off_date or unregistered."""
        moved = self.input_diff(before, run).where("status <> 'unchanged'").select("delivery_id").distinct()
        return standing(moved, self.frame("deliveries"), as_at)

    def code_diff(self, a: str, b: str) -> DataFrame:
        """(model, status) of the models' code digests between two runs: added, removed, changed or
        unchanged."""
        each = self.frame("runs").where(F.col("run").isin(a, b) & F.col("code").isNotNull()).select("run", F.explode("code").alias("model", "digest")).distinct()
        old, new = (each.where(F.col("run") == r).select("model", F.col("digest").alias(n)) for r, n in ((a, "_a"), (b, "_b")))
        status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed").otherwise("unchanged")
        return old.join(new, "model", "full").select("model", status.alias("status"))

    def trace(self, report: str, as_at: str, version: int) -> DataFrame:
        """(model, delivery_id, feed, cob_date) behind a version; unregistered deliveries are kept."""
        run = next(v["run"] for v in self.versions(report, as_at) if v["version"] == version)
        return registered(self.inputs_of(run), self.frame("deliveries"))

    def submitted(self) -> DataFrame:
        """Submissions with the run and tag of the version that was sent."""
        sent = self.frame("submissions").drop("recorded_at")
        return sent.join(self.frame("versions").drop("recorded_at"), ["report", "as_at", "version"], "left")

    def deleted_live(self) -> DataFrame:
        """(report, as_at, version, delivery_id, reason): deliveries behind some version that were
        deleted."""
        return behind_versions(self.frame("versions"), self.frame("inputs")).join(self.frame("deletions").select("delivery_id", "reason"), "delivery_id").select("report", "as_at", "version", "delivery_id", "reason").distinct()


def registered(inputs: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Inputs with their delivery's feed and date, NULL where it isn't registered."""
    known = deliveries.select("delivery_id", "feed", "cob_date").dropDuplicates(["delivery_id"])
    return inputs.select("model", "delivery_id").join(known, "delivery_id", "left").select("model", "delivery_id", "feed", "cob_date")


def standing(moved: DataFrame, deliveries: DataFrame, as_at) -> DataFrame:
    """(delivery_id, standing) of deliveries: on_date if registered for the date, off_date if for
    another one, unregistered if not at all."""
    known = deliveries.groupBy("delivery_id").agg(F.max(F.when(F.col("cob_date") == F.lit(as_at), 1).otherwise(0)).alias("_on"))
    told = F.when(F.col("_on").isNull(), "unregistered").when(F.col("_on") == 1, "on_date").otherwise("off_date")
    return moved.select("delivery_id").join(known, "delivery_id", "left").select("delivery_id", told.alias("standing"))


def behind_versions(versions: DataFrame, inputs: DataFrame) -> DataFrame:
    """(report, as_at, version, model, delivery_id) of all versions, by their run."""
    return versions.select("report", "as_at", "version", "run").join(inputs.select("run", "model", "delivery_id"), "run").drop("run")
