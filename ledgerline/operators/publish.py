"""Write, audit, publish: builds on a branch, checks, a lifecycle gate, a merge and a version.

What is to be published is written down before the merge. Everything after it (tag, version, facts)
follows from that note and can be done again, so whoever finds it finishes the publication if its
merge was done, and drops it if it wasn't.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import Check, settled_checks
from .refs import Conflict, SnapshotStore
from .registry import CLOSED, Refused, Registry, _safe


def input_set(models: dict[str, DataFrame]) -> DataFrame:
    """(model, delivery_id, max_cob_date) of built tables, in one plan."""
    parts = None
    for name, df in sorted(models.items()):
        part = df.groupBy("delivery_id").agg(F.max("cob_date").alias("max_cob_date")).select(F.lit(name).alias("model"), "delivery_id", "max_cob_date")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def input_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., status): added, removed or unchanged."""
    a, b = before.select(*keys).distinct().withColumn("_a", F.lit(True)), after.select(*keys).distinct().withColumn("_b", F.lit(True))
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("unchanged")
    return a.join(b, keys, "full").select(*keys, status.alias("status"))


def publish(
    store: SnapshotStore, registry: Registry, report: str, as_at: str, build: Callable[[SnapshotStore, str], None], checks: Callable[[SnapshotStore, str], list[Check]], inputs: Callable[[SnapshotStore, str], dict[str, DataFrame]], policy: str = "restate", code: dict[str, str] | None = None
) -> int:
    """Builds on a branch, checks it, records inputs, asks the gate, merges, tags, and returns the
    version number. On failure the branch stays for a look, and so does the evidence. A closed date
    takes no publication whose own deliveries changed, unless the policy carries them forward.
    ``code`` gives a digest for each model's code."""
    _safe(report)
    run = uuid.uuid4().hex[:12]
    branch = store.branch(f"build/{report}/{as_at}/{run}")
    told = {"run": run, "report": report, "as_at": as_at}
    registry.record("runs", **told, status="open", code=code)
    build(store, branch)
    bad = []
    for r in settled_checks(checks(store, branch), run).collect():  # one row for each check
        registry.record("evidence", evidence_id=r["evidence_id"], check_name=r["check_name"], severity=r["severity"], failures=r["failures"], outcome=r["outcome"], subject=run)
        bad += [r["check_name"]] if r["outcome"] in ("fail", "error") else []
    if bad:
        registry.record("runs", **told, status="failed")
        raise Refused(f"checks failed: {bad}; see branch {branch}")
    registry.record_inputs(run, input_set(inputs(store, branch)))
    earlier = registry.versions(report, as_at)
    carried = None
    if earlier and registry.state(report, as_at) in CLOSED:
        changed = registry.inputs_changed(run, earlier[-1]["run"], as_at).where("standing = 'on_date'")
        carried = sorted(r[0] for r in changed.select("delivery_id").limit(1000).collect())  # for people to read
        if carried and policy == "restate":
            registry.record("runs", **told, status="refused")
            raise Refused(f"{report} {as_at} is closed and its inputs changed: {carried}")

    def still_open() -> None:
        if policy == "restate" and carried is None and earlier and registry.state(report, as_at) in CLOSED:
            if registry.inputs_changed(run, earlier[-1]["run"], as_at).where("standing = 'on_date'").limit(1).count():
                raise Refused(f"{report} {as_at} was closed meanwhile")

    intent = f"publish-{report}-{as_at}-{run}"
    registry.intend(intent, "publish", branch, f"published/{report}/{as_at}/{run}", **told, carried=json.dumps(carried))
    try:
        store.merge(branch, guard=still_open)
    except (Conflict, Refused):
        registry.settle(intent, "dropped")  # the branch stays for a look
        registry.record("runs", **told, status="refused")
        raise
    return finished(store, registry, next(i for i in registry.open_intents("publish") if i["intent"] == intent))


def finished(store: SnapshotStore, registry: Registry, intent: dict) -> int:
    """All that follows a merge, each step once: the tag of what was built, the version number, the
    run's fact, the end of the branch. Returns the version."""
    told = intent["told"]
    if store.files_.list(store._folder(intent["branch"])):  # else it was tagged before the branch went
        store.tag(intent["tag"], intent["branch"])
    version = registry.allocate(told["report"], told["as_at"], told["run"], intent["tag"])
    registry.record_once("runs", f"published-{told['run']}", run=told["run"], report=told["report"], as_at=told["as_at"], status="published", carried_forward=json.loads(told["carried"]))
    store.delete(intent["branch"])
    registry.settle(intent["intent"], "done")
    return version


def recover(store: SnapshotStore, registry: Registry) -> dict[str, str]:
    """Brings half-done publications to an end: intent -> done, or dropped if its merge wasn't done.
    To be run when no publication is on its way."""
    out = {}
    for intent in registry.open_intents("publish"):
        branch = intent["branch"]
        if store.files_.list(store._folder(branch)) and not store.merged(branch):
            registry.settle(intent["intent"], "dropped")  # before the branch goes: one without a branch was merged
            registry.record("runs", run=intent["told"]["run"], report=intent["told"]["report"], as_at=intent["told"]["as_at"], status="dropped")
            store.delete(branch)
            out[intent["intent"]] = "dropped"
        else:
            finished(store, registry, intent)
            out[intent["intent"]] = "done"
    return out
