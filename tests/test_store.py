"""The snapshot store under concurrent changes and many parts, and recovery from crashes anywhere."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.contracts import Feed, delivery_id
from ledgerline.files import Files
from ledgerline.operators import maintain, quality
from ledgerline.operators import publish as P
from ledgerline.operators.quality import Check
from ledgerline.operators.refs import FOLD, TAIL, Conflict, SnapshotStore
from ledgerline.operators.registry import Refused, Registry
from ledgerline.sources import raw_ingest
from ledgerline.sources.raw_ingest import Delivery, ingest

FEED = Feed(name="trade", pattern=r"trade_(?P<cob_date>\d{8})\.csv", keys=("k",), columns={"k": "k", "x": "x"}, kinds={"k": "string", "x": "string"}, source_system="q")


def one(spark, d, x):
    return spark.createDataFrame([(date(2026, 1, d), x)], "cob_date date, x int").coalesce(1)


def meanwhile(store, other):
    """``store`` has read and written all it needs when ``other`` happens, before the ref changes."""
    done = []
    for name in ("_apply", "_whole"):

        def late(*args, real=getattr(SnapshotStore, name).__get__(store), **more):
            if not done:
                done.append(1)
                other()
            return real(*args, **more)

        setattr(store, name, late)


def test_changes_side_by_side_count_or_conflict(spark, tmp_path):
    a, b = SnapshotStore(spark, str(tmp_path / "s")), SnapshotStore(spark, str(tmp_path / "s"))
    branch = a.branch("w")
    values = lambda: sorted(r.x for r in a.read("t", branch).collect())
    # two first writers, then two appends: all rows count
    meanwhile(a, lambda: b.append(one(spark, 1, 1), "t", branch, ["cob_date"]))
    a.append(one(spark, 1, 2), "t", branch, ["cob_date"])
    meanwhile(a, lambda: b.append(one(spark, 2, 3), "t", branch))
    a.append(one(spark, 3, 4), "t", branch)
    assert values() == [1, 2, 3, 4]
    # a replaced partition that got rows meanwhile, one that was replaced meanwhile, and a gone part
    meanwhile(a, lambda: b.append(one(spark, 1, 5), "t", branch))
    with pytest.raises(Conflict):
        a.replace_partitions(one(spark, 1, 9), "t", branch, "cob_date")
    meanwhile(a, lambda: b.replace_partitions(one(spark, 2, 6), "t", branch, "cob_date"))
    with pytest.raises(Conflict):
        a.replace_partitions(one(spark, 2, 9), "t", branch, "cob_date")
    assert values() == [1, 2, 4, 5, 6]
    with_two = one(spark, 3, 40).union(one(spark, 3, 41))
    b.append(with_two, "t", branch)
    meanwhile(a, lambda: b.delete_where("t", branch, F.col("x") == 40))
    with pytest.raises(Conflict):
        a.delete_where("t", branch, F.col("x") == 41)
    assert values() == [1, 2, 4, 5, 6, 41]
    # another partition is no conflict, a whole new table is
    meanwhile(a, lambda: b.append(one(spark, 2, 7), "t", branch))
    a.replace_partitions(one(spark, 3, 8), "t", branch, "cob_date")
    assert values() == [1, 2, 5, 6, 7, 8]
    meanwhile(a, lambda: b.append(one(spark, 2, 10), "t", branch))
    with pytest.raises(Conflict):
        a.write(one(spark, 1, 0), "t", branch, ["cob_date"])
    # what those that had to look again left behind goes, the rest stays
    assert a.sweep() > 0 and values() == [1, 2, 5, 6, 7, 8, 10] and a.unreachable() == []


def test_many_parts_stay_in_small_refs(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    b = store.branch("w")
    store.write(one(spark, 1, 0), "t", b, ["cob_date"])
    schema = store.read("t", b).schema
    entry = lambda n: {"folder": f"cob_date=2026-{1 + n % 12:02d}-01", "part": f"p{n}", "files": 1, "bytes": n}
    total = (TAIL + 1) * (FOLD + 3)
    for n in range(total):
        store._apply(b, "t", schema, [entry(n)])
    snapshot = store.ref(b)["tables"]["t"]
    assert len(snapshot["tail"]) <= TAIL and len(snapshot["lists"]) <= 2 * FOLD and max(x["level"] for x in snapshot["lists"]) == 1
    assert len(store.entries("t", b)) == total + 1 == store.holdings([b]).count()
    march = store.entries("t", b, {"cob_date=2026-03-01"})
    assert {e["part"] for e in march} == {f"p{n}" for n in range(2, total, 12)}
    gone = march
    store._apply(b, "t", schema, [], gone)
    assert len(store.entries("t", b)) == total + 1 - len(march)
    with pytest.raises(Conflict):
        store._apply(b, "t", schema, [], gone)
    store.tag("pin", b)
    lists = {x["name"] for x in store.ref(b)["tables"]["t"]["lists"]}
    store.sweep()
    assert {n.removesuffix(".json") for n in store.files_.list("lists/t")} == lists
    lost = maintain.reproducible(store, ["pin"]).first()
    assert (lost.parts, lost.lost, lost.readable) == (total + 1 - len(march), total - len(march), False)


def test_divergence_and_oldest_pins(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    for n in (1, 2, 3):
        b = store.branch(f"b{n}")
        store.replace_partitions(one(spark, 1, n).union(one(spark, 1 + n, n)), "t", b, "cob_date")
        store.merge(b)
        store.delete(b)
        store.tag(f"published/{n}")
    away = maintain.divergence(store.holdings())
    assert sorted((r.ref, r.folder) for r in away.collect()) == [("published/1", "cob_date=2026-01-01"), ("published/2", "cob_date=2026-01-01")]
    oldest = maintain.oldest_pins(away).collect()
    assert [(r.table_name, r.oldest_pin, r.parts) for r in oldest] == [("t", "published/1", 2)] and oldest[0].bytes > 0
    store.delete("published/1")
    assert store.sweep() == 1
    assert {(r.tag, r.diverged, r.readable) for r in maintain.reproducible(store).collect()} == {("published/2", 1, True), ("published/3", 0, True)}


class Crash(RuntimeError):
    pass


def crashing(monkeypatch, after):
    """From now on the ``after``-th change of a small file or folder is the last one that is done."""
    left = [after]
    with_change = {n: getattr(Files, n) for n in ("create", "delete", "move_folder")}
    for name, real in with_change.items():

        def change(self, *args, real=real):
            if not left[0]:
                raise Crash
            left[0] -= 1
            return real(self, *args)

        monkeypatch.setattr(Files, name, change)


def facts(store, registry, kind, *columns):
    return sorted(tuple(r) for r in registry.frame(kind).select(*columns).collect())


def test_an_ingest_that_stops_anywhere_ends_the_same(spark, tmp_path, monkeypatch):
    path = tmp_path / "trade_20260105.csv"
    path.write_text("k,x\na,1\nb,2\n")
    ends = []
    for step in range(60):
        store, registry = SnapshotStore(spark, str(tmp_path / f"s{step}")), Registry(spark, str(tmp_path / f"r{step}"))
        delivery = Delivery(delivery_id("q", "trade", "2026-01-05", "d"), date(2026, 1, 5), (str(path),), datetime(2026, 1, 5, 7))
        with monkeypatch.context() as m:
            crashing(m, step)
            try:
                ingest(store, FEED, delivery, "b1", registry=registry, digest="d", name="n")
                stopped = False
            except Crash:
                stopped = True
        raw_ingest.recover(store, registry)
        assert registry.open_intents("ingest") == []
        had = raw_ingest.ingested(store, FEED, delivery.delivery_id)
        if not had:  # the merge wasn't done, so the delivery comes in again
            ingest(store, FEED, delivery, "b1", registry=registry, digest="d", name="n")
        assert raw_ingest.recover(store, registry) == {}
        left = [n for n in store.refs() if n.startswith("ingest/")]
        if had:
            assert left == []
        ends.append((store.read("raw.trade").count(), facts(store, registry, "deliveries", "delivery_id", "version", "rows", "md5", "name"), [n for n in store.refs() if n.startswith("snapshot/")], store.ref("main").get("merged", {}) == {}))
        if not stopped:
            break
    assert not stopped and step > 6 and all(e == ends[0] for e in ends)
    assert ends[0][0] == 2 and len(ends[0][1]) == 1 and ends[0][2] == ["snapshot/trade/2026-01-05/b1"] and ends[0][3]


def test_a_publication_that_stops_anywhere_ends_the_same(spark, tmp_path, monkeypatch):
    table = lambda: spark.createDataFrame([("d1", date(2026, 1, 1), 5)], "delivery_id string, cob_date date, x int").coalesce(1)
    args = ("r", "2026-01-01", lambda s, b: s.write(table(), "m", b), lambda s, b: [Check("positive", lambda: quality.accepted_range(s.read("m", b), "x", 0))], lambda s, b: {"m": s.read("m", b)})
    dropped = done = 0
    for step in range(60):
        store, registry = SnapshotStore(spark, str(tmp_path / f"s{step}")), Registry(spark, str(tmp_path / f"r{step}"))
        with monkeypatch.context() as m:
            crashing(m, step)
            try:
                P.publish(store, registry, *args)
                stopped = False
            except Crash:
                stopped = True
        found = P.recover(store, registry)
        assert P.recover(store, registry) == {}
        published = store.has("m")
        # data in main, a version, its tag and the run's fact come together or not at all
        versions = registry.versions("r", "2026-01-01")
        tags = [n for n in store.refs() if n.startswith("published/")]
        runs = facts(store, registry, "runs", "status")
        assert len(versions) == len(tags) == int(published) == runs.count(("published",))
        if published:
            assert versions[0]["tag"] == tags[0] and store.read("m", tags[0]).count() == 1 and not [n for n in store.refs() if n.startswith("build/")] and not store.ref("main").get("merged")
        dropped, done = dropped + ("dropped" in found.values()), done + ("done" in found.values())
        if not stopped:
            break
    assert not stopped and dropped >= 1 and done >= 4


def test_a_lock_during_the_build_is_seen_at_the_merge(spark, tmp_path):
    store, registry = SnapshotStore(spark, str(tmp_path / "s")), Registry(spark, str(tmp_path / "r"))
    ids, lock = ["d1"], []
    table = lambda: spark.createDataFrame([(i, date(2026, 1, 1), 5) for i in ids], "delivery_id string, cob_date date, x int").coalesce(1)
    for i in ("d1", "d2"):
        registry.record("deliveries", delivery_id=i, feed="f", cob_date="2026-01-01", version=1)
    args = ("r", "2026-01-01", lambda s, b: s.write(table(), "m", b), lambda s, b: [], lambda s, b: {"m": s.read("m", b)})
    assert P.publish(store, registry, *args) == 1
    ids.append("d2")
    intend = registry.intend

    def late(*a, **k):
        registry.move("r", "2026-01-01", "locked", "ann", "month-end", "bob")
        return intend(*a, **k)

    registry.intend = late
    with pytest.raises(Refused):
        P.publish(store, registry, *args)
    assert store.read("m").count() == 1 and registry.open_intents("publish") == [] and len(registry.versions("r", "2026-01-01")) == 1


def test_rows_are_taken_out_by_their_places(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    b = store.branch("w")
    rows = spark.range(4000).select(F.date_add(F.lit(date(2026, 1, 1)), (F.col("id") % 2).cast("int")).alias("cob_date"), F.col("id").cast("int").alias("k"), F.lit(0).alias("v")).repartition(3)
    store.write(rows, "t", b, ["cob_date"])
    before = {e["part"]: e["bytes"] for e in store.entries("t", b)}
    change = spark.createDataFrame([(date(2026, 1, 1), 10, 1, False), (date(2026, 1, 2), 7001, 1, False), (None, 11, None, True)], "cob_date date, k int, v int, gone boolean")
    store.upsert(change, "t", b, ["k"], F.col("gone"))
    after = store.entries("t", b)
    new = [e for e in after if "deletes" not in e]
    assert {e["part"]: e["bytes"] for e in after if "deletes" in e} == before and sum(e["bytes"] for e in new) < 4000
    table = lambda: {r.k: r.v for r in store.read("t", b).collect()}
    want = {k: 0 for k in range(4000)} | {10: 1, 7001: 1}
    del want[11]
    assert table() == want and store.read("t", b).count() == len(want)
    store.delete_where("t", b, F.col("k").between(100, 199))
    store.tag("pin", b)
    want = {k: v for k, v in want.items() if not 100 <= k <= 199}
    assert table() == want and store.read("t", b, {"cob_date=2026-01-02"}).count() == sum(k % 2 for k in want)
    store.delete_where("t", b, F.col("cob_date") == date(2026, 1, 1))
    assert {e["folder"] for e in store.entries("t", b)} == {"cob_date=2026-01-02"}
    want = {k: v for k, v in want.items() if k % 2}
    assert table() == want
    # two that take rows out of one part: the second has to look again
    other = SnapshotStore(spark, str(tmp_path / "s"))
    apply = store._apply

    def late(*args, **more):
        other.delete_where("t", b, F.col("k") == 1)
        return apply(*args, **more)

    store._apply = late
    with pytest.raises(Conflict):
        store.delete_where("t", b, F.col("k") == 3)
    store._apply = apply
    del want[1]
    assert table() == want
    done = maintain.compact_recent(store, "t", b, date(2026, 1, 2), fold_deletes=1)
    assert done["parts"] >= 1 and table() == want and not any(e.get("deletes") for e in store.entries("t", b))
    assert store.read("t", "pin").count() == 4000 - 100 + 1 - 1
    store.delete("pin")
    store.sweep()
    assert store.files_.list("deletes/t") == [] and table() == want
