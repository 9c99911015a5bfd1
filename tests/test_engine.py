"""The engine's operators: golden path, metamorphic replay, publication, calendar rules, sources."""

import hashlib
import zipfile
from datetime import date, datetime
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from ledgerline.contracts import ContractError, Feed, delivery_id, derive_pattern, platform_names, resolve
from ledgerline.functions import conform as C
from ledgerline.operators import calendar, lineage, maintain, marts, quality, reconcile, sampledata, scd2, snapshot
from ledgerline.operators.publish import publish
from ledgerline.operators.registry import Refused, Registry
from ledgerline.operators.quality import Check
from ledgerline.operators.refs import Conflict, SnapshotStore
from ledgerline.sources import delivery as D
from ledgerline.sources import raw_ingest
from ledgerline.sources.raw_ingest import Delivery, IngestRefused, ingest

POSITION = Feed(
    name="qa_happy_position", pattern=r"qa_happy_position_(?P<cob_date>\d{8})(?:_v(?P<version>\d+))?\.csv", keys=("position_id",),
    columns={"position_id": "position_id", "desk_code": "desk_code", "amount": "amount", "currency": "currency", "is_active": "is_active", "description": "description"},
    kinds={"position_id": "string", "desk_code": "upper", "amount": "decimal", "currency": "upper", "is_active": "boolean", "description": "string"}, separator="|", source_system="qa",
)


def deliver(path, text, cob, n, **more):
    path.write_text(text)
    return Delivery(delivery_id("qa", POSITION.name, str(cob), f"{path.name}{n}"), cob, (str(path),), datetime(2026, 9, 14, 7 + n), **more)


GOLDEN = "position_id|desk_code|amount|currency|is_active|description\nHP001| rates |1250.50|gbp|Y|\"Quoted | pipe\"\nHP002|CREDIT|249.50|GBP|no|plain\nHP003|rates|-100.00|USD|TRUE|N/A\n"


def test_golden_path_from_file_to_summary(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    one = deliver(tmp_path / "qa_happy_position_20260914.csv", GOLDEN, date(2026, 9, 14), 0, declared_rows=3)
    got = ingest(store, POSITION, one, "b1")
    assert (got.rows, got.version, got.status) == (3, 1, "ingested") and {e["outcome"] for e in got.evidence} == {"pass"}
    assert ingest(store, POSITION, one, "b2").status == "already ingested"
    raw = store.read("raw.qa_happy_position")
    rows = raw.orderBy("_row_number").collect()
    assert [r._row_number for r in rows] == [1, 2, 3] and rows[0].desk_code == " rates " and rows[0].description == "Quoted | pipe"
    kinds = {c: POSITION.kind(c) for c in POSITION.columns}
    prepared = snapshot.conform(raw, kinds, ["position_id"])
    assert sorted((r.position_id, r.desk_code, str(r.amount), r.currency, r.is_active, r.description) for r in prepared.collect()) == [
        ("HP001", "RATES", "1250.50", "GBP", True, "Quoted | pipe"), ("HP002", "CREDIT", "249.50", "GBP", False, "plain"), ("HP003", "RATES", "-100.00", "USD", True, None)]
    assert sorted(map(tuple, marts.summary(prepared).select("currency", "position_count", F.col("total_amount").cast("string"), "active_position_count").collect())) == [("GBP", 2, "1500.00", 1), ("USD", 1, "-100.00", 1)]
    # a second delivery of the date restates it whole: HP002 is gone, HP001 twice, a column more
    two = deliver(tmp_path / "qa_happy_position_20260914_v2.csv", "position_id|desk_code|amount|currency|is_active|description|lei\nHP001|a|1|GBP|Y|x|L1\n HP001|b|2|GBP|Y|x|L2\n", date(2026, 9, 14), 1)
    assert ingest(store, POSITION, two, "b3").version == 2
    raw = store.read("raw.qa_happy_position")
    latest = snapshot.conform(raw, kinds, ["position_id"]).collect()
    assert [(r.position_id, str(r.amount), r.source_file_version) for r in latest] == [("HP001", "2.00", 2)]
    assert raw.where("_file_version = 2").select(F.map_values("_extra_columns")[0]).distinct().count() == 2
    early = snapshot.known_as_of(raw, "2026-09-14 07:30:00")
    assert snapshot.conform(early, kinds, ["position_id"]).count() == 3
    with pytest.raises(IngestRefused):
        ingest(store, POSITION, deliver(tmp_path / "x.csv", GOLDEN, date(2026, 9, 15), 2, declared_rows=9), "b4")
    assert store.read("raw.qa_happy_position").where("_cob_date = '2026-09-15'").count() == 0
    with pytest.raises(ValueError):
        snapshot.known_as_of(raw, "yesterday")
    assert {v[0] for k, v in lineage.classify_columns(marts.summary(prepared)).items()} == {"sourced", "row_aggregate"}


def raw_rows(spark, rows):
    """(date, version, key, value) in file order as raw strings."""
    data = [(date.fromisoformat(d), v, n, k, x, "b") for n, (d, v, k, x) in enumerate(rows)]
    return spark.createDataFrame(data, "_cob_date date, _file_version int, _row_number long, k string, x string, _batch_id string")


COLUMNS = {"k": "string", "x": "string"}
STEPS = [
    [("2026-09-01", 1, k, "1") for k in "ABC"] + [("2026-09-02", 1, "A", "1"), ("2026-09-02", 1, "B", "2"), ("2026-09-02", 1, "C", "1"), ("2026-09-02", 1, None, "n")],
    [("2026-09-02", 2, "A", "1")],
    [("2026-09-03", 1, "A", "3"), ("2026-09-03", 1, " B ", "2")],
    [("2026-09-03", 2, "A", "1"), ("2026-09-03", 2, "B", "1"), ("2026-09-03", 2, "D", "4")],
    [("2026-09-04", 1, "A", "5"), ("2026-09-04", 1, "C", "N/A")],
]


def test_replay_equals_a_full_build_after_every_delivery(spark):
    rows, target = [], None
    for step in STEPS:
        rows += step
        raw = raw_rows(spark, rows)
        full = scd2.build_full(raw, COLUMNS, ["k"], ["x"])
        if target is None:
            target = full
        else:
            target = scd2.replay(raw, target, COLUMNS, ["k"], ["x"], 3)
        fields = ["k", "x", *scd2.RANGE]
        got = sorted(map(str, target.select(*fields).collect()))
        assert got == sorted(map(str, full.select(*fields).collect()))
        assert scd2.broken_ranges(target, ["k"]).count() == 0
        target = spark.createDataFrame(target.collect(), target.schema)
    # raw loses its first date: versions of that date stay
    pruned = raw_rows(spark, [r for r in rows if r[0] > "2026-09-01"])
    with pytest.raises(scd2.PrunedHistory):
        scd2.refuse_pruned(target, pruned)
    again = scd2.replay(pruned, target, COLUMNS, ["k"], ["x"], 3)
    assert sorted(map(str, again.select("k", "x", *scd2.RANGE).collect())) == got
    assert scd2.broken_ranges(again, ["k"]).count() == 0


def test_range_flaws(spark):
    make = lambda *r: spark.createDataFrame([("a", date.fromisoformat(f), date.fromisoformat(t), c) for f, t, c in r], "k string, effective_from date, effective_to date, is_current boolean")
    flaws = lambda df: [r.flaw for r in scd2.broken_ranges(df, ["k"]).collect()]
    assert flaws(make(("2026-01-01", "2026-01-05", False), ("2026-01-05", "9999-12-31", True))) == ["overlap"]
    assert flaws(make(("2026-01-01", "2026-01-01", False), ("2026-01-02", "9999-12-31", True))) == []
    assert flaws(make(("2026-01-01", "2026-01-03", False), ("2026-01-05", "9999-12-31", True))) == ["gap"]
    assert flaws(make(("2026-01-01", "9999-12-31", True))) == []


def test_exposure_change_classes(spark):
    d = date.fromisoformat
    rows = [(d("2026-08-31"), "A", 10.0, 1), (d("2026-08-31"), "B", 40.0, 1), (d("2026-09-01"), "A", 10.0, 1), (d("2026-09-01"), "B", 50.0, 3), (d("2026-09-01"), "C", 5.0, 1), (d("2026-09-02"), "A", 10.0, 1), (d("2026-09-02"), "C", None, 1), (d("2026-09-02"), "D", 7.0, 1)]
    e = spark.createDataFrame(rows, "cob_date date, counterparty_id string, total_mtm double, trade_count long").withColumns({c: F.col("total_mtm").cast("decimal(28,4)") for c in ("total_mtm", "total_notional")})
    out = {r.counterparty_id: r for r in marts.exposure_change(e).where("cob_date = '2026-09-02'").collect()}
    assert {k: r.change_category for k, r in out.items()} == {"A": "UNCHANGED", "B": "REMOVED", "C": "CHANGED", "D": "NEW"}
    b = out["B"]
    assert (b.total_mtm, float(b.mtm_change), b.trade_count_change, float(b.month_end_mtm), float(b.month_end_change)) == (None, -50.0, -3, 40.0, -40.0)
    assert quality.removed_matches_disappearance(marts.exposure_change(e), e, marts.date_pairs(e), "counterparty_id").count() == 0


def test_store_branches_conflicts_and_sweeps(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    a, b = store.branch("a"), store.branch("b")
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    store.write(rows, "t", "a")
    store.write(rows.limit(1), "t", "b")
    store.write(rows, "u", "b")
    assert store.merge(a) == ["t"] and not store.has("u")
    with pytest.raises(Conflict):
        store.merge(b)
    store.tag("published/r/1")
    with pytest.raises(Conflict):
        store.write(rows, "t", "main")
    c = store.branch("c")
    change = spark.createDataFrame([(1, "X", False), (None, "Z", False), (2, None, True)], "k int, v string, gone boolean")
    store.upsert(change, "t", c, ["k"], F.col("gone"))
    store.merge(c)
    assert sorted(map(str, store.read("t").select("k", "v").collect())) == sorted(map(str, spark.createDataFrame([(1, "X"), (None, "Z")], "k int, v string").collect()))
    with pytest.raises(ValueError):
        store.upsert(change.union(change), "t", store.branch("d"), ["k"])
    assert store.read("t", "published/r/1").count() == 3
    for name in ("a", "b", "c", "d"):
        store.delete(name)
    assert store.sweep() == 2 and store.read("t", "published/r/1").count() == 3
    assert store.expire_tags(-1) == ["published/r/1"] and store.sweep() == 1
    e = store.branch("e")
    dated = spark.createDataFrame([(date(2026, 1, 1), 1), (date(2026, 1, 2), 2), (date(2026, 2, 3), 3)], "cob_date date, x int")
    store.write(dated, "p", e, ["cob_date"])
    store.replace_partitions(dated.where("x = 2").withColumn("x", F.lit(9)), "p", e, "cob_date")
    assert sorted(r.x for r in store.read("p", e).collect()) == [1, 3, 9]
    assert maintain.file_metrics(store.files("p", e)).first().partitions == 3
    assert maintain.decide({"total_files": 50, "max_files_per_partition": 30, "avg_file_size_mb": 1.0})[0] and not maintain.decide({"total_files": 0})[0]
    maintain.apply_retention(store, "p", e, 1, 1)
    assert sorted(r.x for r in store.read("p", e).collect()) == [3, 9]
    assert store.publish_views("v_") == ["t"] and spark.sql("select count(*) from v_t").first()[0] == 2
    assert store.describe()["t"][0] == ("k", "int")


def test_publication_gate_and_versions(spark, tmp_path):
    store, registry = SnapshotStore(spark, str(tmp_path / "s")), Registry(spark, str(tmp_path / "r"))
    data = {"ids": ["d1"]}
    for i in ("d1", "d2"):
        registry.record("deliveries", delivery_id=i, feed="f", cob_date="2026-01-01", version=1)
    table = lambda: spark.createDataFrame([(i, date(2026, 1, 1), 5) for i in data["ids"]], "delivery_id string, cob_date date, x int")
    args = ("r", "2026-01-01", lambda s, b: s.write(table(), "m", b), lambda s, b: [Check("positive", lambda: quality.accepted_range(s.read("m", b), "x", 0))], lambda s, b: {"m": s.read("m", b)})
    assert publish(store, registry, *args, code={"m": "1"}) == 1 and publish(store, registry, *args, code={"m": "2", "n": "1"}) == 2
    registry.move("r", "2026-01-01", "submitted", "ann", "sent", "bob")
    data["ids"] = ["d1", "d2"]
    with pytest.raises(Refused):
        publish(store, registry, *args)
    assert store.read("m").count() == 1
    assert publish(store, registry, *args, policy="carry_forward") == 3 and store.read("m").count() == 2
    # all of it outlives the process that recorded it
    registry = Registry(spark, str(tmp_path / "r"))
    runs = [v["run"] for v in registry.versions("r", "2026-01-01")]
    assert sorted(map(tuple, registry.input_diff(runs[0], runs[2]).collect())) == [("m", "d1", "unchanged"), ("m", "d2", "added")]
    assert sorted(map(tuple, registry.code_diff(runs[0], runs[1]).collect())) == [("m", "changed"), ("n", "added")]
    data["ids"] = ["d1", "d2", "d9"]
    publish(store, registry, "other", "2026-01-01", *args[2:])
    assert [r.delivery_id for r in registry.trace("r", "2026-01-01", 3).orderBy("delivery_id").collect()] == ["d1", "d2"]
    assert {r.delivery_id: r.feed for r in registry.trace("other", "2026-01-01", 1).collect()} == {"d1": "f", "d2": "f", "d9": None}
    registry.record("submissions", submission_id="s1", report="r", as_at="2026-01-01", version=2, recipient="x")
    assert [r.run for r in registry.submitted().collect()] == [runs[1]]
    registry.record("deletions", delivery_id="d2", reason="old")
    assert {(r.report, r.version) for r in registry.deleted_live().collect()} == {("r", 3), ("other", 1)}
    bad = (*args[:3], lambda s, b: [Check("never", lambda: quality.accepted_range(s.read("m", b), "x", 6)), Check("broken", lambda: quality.not_null(s.read("m", b), "no_such"))], args[4])
    with pytest.raises(Refused):
        publish(store, registry, *bad)
    assert {e["outcome"] for e in registry.frame("evidence").collect()} == {"pass", "fail", "error"}
    with pytest.raises(Refused):
        publish(store, registry, "../r", *args[1:])


def test_lifecycle_moves(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "r"))
    move = lambda to, actor="ann", reason="why", **more: registry.move("r", "2026-01-01", to, actor, reason, "Bob", **more)
    refused = [("open", {}), ("reopened", {}), ("locked", {"actor": " "}), ("submitted", {"reason": ""})]
    for to, more in refused:
        with pytest.raises(Refused):
            move(to, **more)
    assert registry.state("r", "2026-01-01") == "open"
    move("locked")
    move("reopened")  # a lock is undone without approval
    with pytest.raises(Refused):
        move("reopened")
    move("submitted", submission_id="s1")
    for approved in (None, "ann"):
        with pytest.raises(Refused):
            move("reopened", approved_by=approved)
    move("reopened", approved_by="bob")
    assert registry.state("r", "2026-01-01") == "reopened" and registry.state("r", "2026-01-02") == "open"
    assert [r.state for r in registry.frame("transitions").orderBy("seq").collect()] == ["locked", "reopened", "submitted", "reopened"]
    # of two that saw the same state one is refused
    other = Registry(spark, str(tmp_path / "r"))
    seen = other._numbered("transitions", "r", "2026-01-01")
    move("locked")
    other._numbered = lambda *a: seen
    with pytest.raises(Refused):
        other.move("r", "2026-01-01", "submitted", "ann", "why", "Bob")


def test_store_keeps_parts(spark, tmp_path):
    """An append writes its rows alone, a partition's replacement leaves the others' files, merges
    that race conflict or both count, and a crash between steps loses nothing."""
    store = SnapshotStore(spark, str(tmp_path / "s"))
    names = lambda ref: {r.path for r in store.files("t", ref).collect()}
    day = lambda d, x: spark.createDataFrame([(date(2026, 1, d), x)], "cob_date date, x int").coalesce(1)
    a = store.branch("a")
    store.append(day(1, 1), "t", a, ["cob_date"])
    one = names(a)
    store.append(day(2, 2).withColumn("y", F.lit("new")), "t", a)
    two = names(a)
    assert one < two and len(two) == 2
    assert sorted(map(str, store.read("t", a).select("x", "y").collect())) == ["Row(x=1, y=None)", "Row(x=2, y='new')"]
    with pytest.raises(ValueError):
        store.append(day(3, 3).withColumn("x", F.lit("text")), "t", a)
    store.replace_partitions(day(2, 9), "t", a, "cob_date")
    assert one < names(a) and len(names(a)) == 2 and sorted(r.x for r in store.read("t", a).collect()) == [1, 9]
    store.delete_where("t", a, F.col("x") == 9)
    assert names(a) == one
    store.append(day(3, 3), "t", a)
    store.keep_partitions("t", a, spark.createDataFrame([(date(2026, 1, 3),)], "cob_date date"))
    assert [r.x for r in store.read("t", a).collect()] == [3] and dict(store.read("t", a).dtypes)["cob_date"] == "date"
    assert store.read("t", a).where("cob_date = '2026-01-03'").count() == 1
    assert store.merge(a) == ["t"]
    # two branches of one base, two tables: both merges count, even if one reads before the other writes
    b, c = store.branch("b"), store.branch("c")
    store.write(day(1, 5), "u", b)
    store.write(day(1, 6), "v", c)
    create, late = store._create, []

    def slow(name, number, state):
        if name == "main" and not late:
            late.append(name)
            SnapshotStore(spark, store.root).merge(c)
        create(name, number, state)

    store._create = slow
    assert store.merge(b) == ["u"] and store.has("u") and store.has("v") and store.has("t")
    store._create = create
    # the same table: one conflict
    b, c = store.branch("b2"), store.branch("c2")
    store.append(day(1, 7), "u", b)
    store.append(day(1, 8), "u", c)
    store.merge(b)
    with pytest.raises(Conflict):
        store.merge(c)
    # a writer that dies between its steps leaves main as it was
    before = store.ref("main")
    d = store.branch("d")
    store._apply = lambda *x: (_ for _ in ()).throw(OSError("gone"))
    with pytest.raises(OSError):
        store.append(day(4, 4), "t", d)
    assert SnapshotStore(spark, store.root).ref("main") == before and store.read("t", d).count() == 1
    assert {r["ref"] for r in store.history("u").collect()} >= {"main", "b2", "c2"}
    store = SnapshotStore(spark, store.root)
    for n in ("a", "b", "c", "b2", "c2", "d"):
        store.delete(n)
    assert store.sweep() > 0 and store.read("t").count() == 1 and store.read("u").count() == 2 and store.unreachable() == []
    assert {r["readable"] for r in maintain.reproducible(store, [store.tag("published/x")]).collect()} == {True}


def test_front_door_from_archive_to_raw(spark, tmp_path, monkeypatch):
    import io
    import zipfile
    from dataclasses import replace as changed

    from ledgerline.operators import calendar
    from ledgerline.sources import front_door
    from ledgerline.sources.delivery import Rejected
    from ledgerline.sources.objects import Objects

    feed = changed(POSITION, pattern=r"qa_(?P<cob_date>\d{8})\.zip", member_pattern=r"part_\d\.csv", encoding="ISO-8859-1")
    head = "position_id|desk_code|amount|currency|is_active|description\n"
    parts = [(head + "P1|a|1|GBP|Y|caf\u00e9\nP2|a|2|GBP|Y|\"x | y\"\n").encode("latin-1"), (head + "P3|b|3|USD|N|z\n").encode("latin-1")]

    def packed(name, members):
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w") as z:
            for n, data in members:
                z.writestr(n, data)
        (tmp_path / name).write_bytes(body.getvalue())
        return str(tmp_path / name)

    md5_of = lambda p: hashlib.md5(open(p, "rb").read()).hexdigest()  # noqa: E731  the sender's digest is the file's
    path = packed("qa_20260914.zip", [("part_2.csv", parts[1]), ("part_1.csv", parts[0]), ("readme.txt", b"?")])
    control = {"text": f"DATE|ROWS|SUM\n2026-09-14|3|{md5_of(path)}\n", "kind": "delimited", "fields": {"cob_date": ("DATE", "date"), "n_rows": ("ROWS", "integer"), "md5": ("SUM", "md5")}}
    store, registry, objects = SnapshotStore(spark, str(tmp_path / "s")), Registry(spark, str(tmp_path / "r")), Objects(spark, str(tmp_path / "o"))
    args = (store, registry, objects, feed, path, datetime(2026, 9, 14, 7), "b1", control)
    monkeypatch.setattr(front_door, "ingest", lambda *a, **k: (_ for _ in ()).throw(OSError("stopped midway")))
    with pytest.raises(OSError):
        front_door.receive(*args)
    monkeypatch.undo()
    got = front_door.receive(*args)
    assert (got.status, got.rows, got.version) == ("ingested", 3, 1) and {e["outcome"] for e in got.evidence} == {"pass"}
    assert front_door.receive(*args).status == "already ingested"
    raw = store.read(f"raw.{feed.name}")
    assert [(r._row_number, r.position_id, r.description) for r in raw.orderBy("_row_number").collect()] == [(1, "P1", "caf\u00e9"), (2, "P2", "x | y"), (3, "P3", "z")]
    assert [tuple(r) for r in raw_ingest.committed(raw).select("version", "n_rows").collect()] == [(1, 3)]
    assert raw_ingest.checkpoint(raw, date(2026, 9, 14), got.delivery_id).count() == 3 and raw_ingest.checkpoint(raw, date(2026, 9, 15)).count() == 0
    state = lambda: calendar.receipt_state(registry.frame("receipts").withColumnRenamed("recorded_at", "occurred_at"), front_door.STAGES)
    assert [r.status for r in state().collect()] == ["INGESTED"]
    with pytest.raises(IngestRefused):
        front_door.receive(*args[:4], packed("qa_20260915.zip", [("part_1.csv", parts[0])]), *args[5:7], {**control, "text": control["text"].replace("-14|3", "-15|9")})
    ragged = packed("qa_20260916.zip", [("part_1.csv", head.encode() + b"P1|a\n")])
    with pytest.raises(Rejected):
        front_door.receive(*args[:4], ragged, *args[5:7])
    with pytest.raises(Rejected):
        front_door.receive(*args[:4], packed("qa_20260917.zip", [("../part_1.csv", parts[0])]), *args[5:7])
    assert {r.status for r in state().collect()} == {"INGESTED", "FAILED"}
    assert {r.check_name for r in registry.frame("evidence").where("outcome = 'fail'").collect()} == {"declared_row_count", "declared_md5", "strict_parse"}
    assert len([n for n in objects.list("quarantine") if n.endswith(".reason.json")]) == 2
    assert store.read(f"raw.{feed.name}").count() == 3


def test_replay_reads_and_changes_what_it_must(spark):
    """Changes and markers of a re-delivery: equal to a full build once merged, for keys that are
    NULL, vanish, return or are new, and versions whose date raw has lost."""
    columns = {"k": "string", "agency": "string", "v": "string"}
    keys = ["k", "agency"]
    row = lambda d, n, i, k, v, a="x": (date(2026, 9, d), n, i, k, a, v, "b")
    schema = "_cob_date date, _file_version int, _row_number long, k string, agency string, v string, _batch_id string"
    first = [row(1, 1, 1, "A", "1"), row(1, 1, 2, "B", "1"), row(1, 1, 3, None, "1"), row(2, 1, 1, "A", "1"), row(2, 1, 2, "B", "2"), row(2, 1, 3, "C", "1"), row(2, 1, 4, None, "3"), row(8, 1, 1, "A", "2"), row(8, 1, 2, "B", "3"), row(9, 1, 1, "B", "3")]
    more = [row(8, 2, 1, " A ", "1"), row(8, 2, 2, None, "4"), row(9, 2, 1, "D", "1"), row(9, 2, 2, "B", "2")]
    raw = lambda rows: spark.createDataFrame(rows, schema)
    build = lambda rows: scd2.build_full(raw(rows), columns, keys, ["v"])
    fields = [*keys, "v", *scd2.RANGE]
    told = lambda df: sorted(map(str, df.select(*fields).collect()))
    target = spark.createDataFrame(build(first).collect(), build(first).schema)
    changes = scd2.replay_changes(raw(first + more), target, columns, keys, ["v"], 2)
    gone = [r for r in changes.collect() if r.effective_to == date(1, 1, 1)]
    assert {(r.k, r.effective_from) for r in gone} == {("A", date(2026, 9, 8)), ("B", date(2026, 9, 8))} and all(r.v is None for r in gone)
    merged = scd2.merge_versions(target, changes, keys)
    assert told(merged) == told(build(first + more)) and scd2.broken_ranges(merged, keys).count() == 0
    # a second replay changes nothing
    again = scd2.replay(raw(first + more), spark.createDataFrame(merged.collect(), merged.schema), columns, keys, ["v"], 2)
    assert told(again) == told(merged)
    # raw has lost the first date: its versions stay
    lost = [r for r in first + more if r[0] != date(2026, 9, 1)]
    assert told(scd2.replay(raw(lost), target, columns, keys, ["v"], 2)) == told(merged)


def test_receipts_freshness_backlog_and_sweeps(spark, tmp_path):
    from ledgerline.files import Files
    from ledgerline.operators import calendar, reconcile

    ranks = {"DISCOVERED": 0, "LANDED": 1, "INGESTED": 2}
    story = {"a": ["DISCOVERED", "LANDED", "INGESTED", "FAILED", "LANDED"], "b": ["INGESTED", "LANDED"], "c": ["LANDED", "FAILED"], "d": ["FAILED", "INGESTED", "LANDED"], "e": ["DISCOVERED"]}
    events = spark.createDataFrame([(k, s, n) for k, v in story.items() for n, s in enumerate(v)], "transport_id string, status string, occurred_at int")
    assert {r.transport_id: r.status for r in calendar.receipt_state(events, ranks).collect()} == {"a": "LANDED", "b": "INGESTED", "c": "FAILED", "d": "INGESTED", "e": "DISCOVERED"}
    times = spark.createDataFrame([("x", datetime(2026, 1, 1)), ("x", datetime(2026, 1, 9)), ("y", datetime(2026, 1, 8)), ("z", datetime(2026, 1, 8)), ("w", None)], "source string, at timestamp")
    fresh = calendar.freshness(times, "at", "2026-01-10 03:00:00", {"z": (72, 240)})
    assert {r.source: r.status for r in fresh.collect()} == {"x": "warn", "y": "error", "z": "pass", "w": "error"}
    status = spark.createDataFrame([("f", 1, "COMPLETE"), ("g", 1, "COMPLETE"), ("h", 1, "MISSING")], "feed string, cob_date int, status string")
    assert sorted(map(tuple, calendar.status_summary(status).collect())) == [(1, "COMPLETE", 2), (1, "MISSING", 1)]
    waiting = spark.createDataFrame([("compact", "t", date(2026, 1, 1)), ("compact", "u", date(2026, 1, 3)), ("expire", "t", date(2026, 1, 2))], "kind string, item string, deferred_on date")
    assert sorted(map(tuple, maintain.backlog(waiting, waiting.where("item = 't' and kind = 'compact'"), "2026-01-05").collect())) == [("compact", 1, date(2026, 1, 3), 2), ("expire", 1, date(2026, 1, 2), 3)]
    files = Files(spark, str(tmp_path / "f"))
    for n in ("landing/a", "landing/sub/b", "quarantine/c", "ready/d"):
        files.create(n, b"1")
    kept = spark.createDataFrame([("landing/sub/b",)], "path string")
    now = files.walk("landing")[0][2]
    assert maintain.sweep_objects(files, {"landing": 3, "quarantine": 30}, kept, now + 4 * 86400) == 1
    assert [n for f in ("landing", "quarantine", "ready") for n, _, _ in files.walk(f)] == ["landing/sub/b", "quarantine/c", "ready/d"]
    trend = maintain.trend(spark.createDataFrame([("t", date(2026, 1, d), 10 * d) for d in range(1, 9)], "table_name string, measured_on date, bytes long"), 3)
    assert [tuple(r) for r in trend.collect()] == [("t", 60, 80, 20)]
    assert maintain.window_refusal({"f": 10, "g": 40}, {"r": 30}, {"r": {"f", "g"}}) == [("r", "f")]
    assert reconcile.comparison_id("c", date(2026, 1, 1), "a", "b") == reconcile.comparison_id("c", "2026-01-01", "a", "b") != reconcile.comparison_id("c", "2026-01-02", "a", "b")
    taken = {POSITION.render_name(date(2026, 1, 1))}
    assert raw_ingest.next_name(POSITION, date(2026, 1, 1), taken).endswith("_20260101_v2.csv")
    with pytest.raises(IngestRefused):
        raw_ingest.next_name(POSITION, date(2026, 1, 1), {POSITION.render_name(date(2026, 1, 1), n) for n in range(1, 100)})


def test_calendar_rules(spark):
    days = spark.createDataFrame([(date.fromisoformat(x),) for x in ("2026-01-30", "2026-01-29", "2026-02-27", "2026-03-02", "2026-03-03")], "cob_date date")
    got = lambda df: sorted(str(r[0]) for r in df.collect())
    assert got(calendar.month_end_dates(days)) == ["2026-01-30", "2026-02-27"]
    assert got(calendar.keep_set(days, 1, 1)) == ["2026-02-27", "2026-03-03"]
    assert got(calendar.expire_set(days, 1, 1)) == ["2026-01-29", "2026-01-30", "2026-03-02"]
    feeds = spark.createDataFrame([("a", date(2026, 1, 5)), ("a", date(2026, 1, 7)), ("b", date(2026, 1, 5)), ("b", date(2026, 1, 6)), ("b", date(2026, 1, 8)), ("w", date(2026, 1, 2)), ("w", date(2026, 1, 15))], "feed string, cob_date date")
    assert sorted(map(tuple, calendar.find_gaps(feeds, weekly=("w",)).collect())) == [("a", "2026-01-06"), ("b", "2026-01-07"), ("w", "2026-W02")]
    late = spark.createDataFrame([("a", date(2026, 1, 5), datetime(2026, 1, 6, 5)), ("b", date(2026, 1, 5), datetime(2026, 1, 9, 5)), ("b", date(2026, 1, 6), datetime(2026, 1, 9, 6))], "feed string, cob_date date, arrived_at timestamp")
    assert sorted((r.feed, r.is_late, r.is_bulk) for r in calendar.lateness(late).collect()) == [("a", False, False), ("b", True, True), ("b", True, True)]
    events = spark.createDataFrame([("t", "LANDED", 1), ("t", "INGESTED", 2), ("t", "LANDED", 3), ("u", "LANDED", 1), ("u", "FAILED", 2)], "transport_id string, status string, occurred_at int")
    assert dict(map(tuple, calendar.receipt_state(events, {"LANDED": 1, "INGESTED": 2}).collect())) == {"t": "INGESTED", "u": "FAILED"}


def test_reconciliation_and_acceptance(spark):
    a = spark.createDataFrame([(1, "x ", 1.0), (2, "y", 2.0), (3, None, 3.0)], "k int, s string, v double")
    b = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.5), (4, None, 3.0)], "k int, s string, v double")
    got = {r.k: r.status for r in reconcile.compare_rows(a, b, ["k"], ["s", "v"]).collect()}
    assert set(got.values()) == {"equal", "changed", "legacy_only", "new_only"} and len(got) == 4
    outcomes = {r.comparator: r.outcome for r in reconcile.compare_business_date(a, b, ["k"], ["s", "v"], [("sum", "v"), ("count", "v")], relative=0.1).collect()}
    assert outcomes == {"row_count": "PASS", "key_set": "FAIL", "row_hash": "FAIL", "aggregate": "PASS"}
    assert reconcile.worst_outcome(spark.createDataFrame([], "outcome string")).first()[0] == "ERROR"
    runs = spark.createDataFrame([(date(2026, 1, i), o, i) for i, o in enumerate(["FAIL", "PASS", "WARN", "PASS"], 1)], "business_date date, outcome string, executed_at int")
    assert tuple(reconcile.acceptance(runs, 2).first())[::2] == (1, "NOT_READY") and reconcile.acceptance(runs, 3, True).first().status == "READY"
    assert reconcile.acceptance(runs.where("false")).first().status == "NOT_STARTED"
    ours = {"producer_run_id": "r1", "source_sha256": "s", "source_system": "q", "source_filename": "f"}
    assert reconcile.correlate(ours, [{"source_sha256": "s"}]) == {"source_sha256": "s"}
    with pytest.raises(reconcile.NotComparable):
        reconcile.correlate(ours, [{"producer_run_id": "other", "source_sha256": "s"}])


def test_sources_and_contracts(spark, tmp_path):
    assert D.detect_encoding("é".encode()) == "UTF-8" and D.detect_encoding("é".encode("latin-1")) == "ISO-8859-1" and D.detect_encoding(b"\x93x\x94") == "windows-1252" and D.detect_encoding("a".encode("utf-16")) == "UTF-16"
    for bad in (b"position_id|desk_code\na|b|c\n", b'position_id\n"open\n', b"\xff\xfe"):
        with pytest.raises(D.Rejected):
            D.csv_rows(bad, POSITION)
    archive = BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("b.csv", "2")
        z.writestr("a.csv", "1")
        z.writestr("note.txt", "")
    assert [n for n, _ in D.unpack(archive.getvalue(), r".*\.csv")] == ["a.csv", "b.csv"]
    with pytest.raises(D.Rejected):
        D.unpack(archive.getvalue(), r".*\.xml")
    assert D.read_control("BUSINESS_DATE|RECORD_COUNT\n2026-09-14|3\n", "delimited", {"cob": ("BUSINESS_DATE", "date"), "rows": ("RECORD_COUNT", "integer")}) == {"cob": date(2026, 9, 14), "rows": 3}
    with pytest.raises(D.Rejected):
        D.read_control("a=1\na=2\n", "key_value", {"a": ("a", "string")})
    path = tmp_path / "s.csv"
    path.write_text("id;name;amount\n1;x;1.5\n2;y;2.5\n3;x;2.5\n")
    told = D.sniff(spark, str(path), path.read_bytes())
    assert (told["delimiter"], told["header"], told["keys"], told["kinds"]["amount"]) == (";", True, ["id"], "decimal")
    pattern = derive_pattern("TRADE_20260914_v3.csv")
    feed = Feed("t", pattern, ("trade_id",), platform_names(["Trade Id", "trade-id", "IsActive"]))
    assert list(feed.columns) == ["trade_id", "trade_id_2", "is_active"] and feed.kind("is_active") == "boolean" and len(feed.schema_version) == 12
    assert feed.parse_name("TRADE_20260914.csv") == (date(2026, 9, 14), 1) and feed.parse_name(feed.render_name(date(2026, 1, 2), 4)) == (date(2026, 1, 2), 4)
    with pytest.raises(ContractError):
        Feed("t", pattern, ("nope",), {"a": "a"})
    with pytest.raises(ContractError):
        Feed("t", pattern, ("a",), {"a": "a"}, supersession="delta_append")
    assert resolve({"x": 1, "y": 1}, {"p": {"y": 2, "parent": "q"}, "q": {"z": 3, "y": 9}}, {"parent": "p", "w": 4}) == {"x": 1, "y": 2, "z": 3, "w": 4}
    sample = sampledata.generate(spark, POSITION, 50, "2026-09-14")
    assert sample.columns == list(POSITION.columns.values()) and sample.select("position_id").distinct().count() == 50 and sample.collect() == sampledata.generate(spark, POSITION, 50, "2026-09-14").collect()
    day, name = F.lit("2026-09-14").cast("date"), F.lit("n")
    assert spark.range(1).select(sampledata.epoch_start(day, name, 7) <= day).first()[0]


def test_markers_are_ingested_once(spark, tmp_path):
    import json

    from ledgerline.streaming import arrivals

    root = tmp_path / "in"
    for n in ("t1", "t2", "t1copy"):
        (root / n).mkdir(parents=True)
        (root / n / "data.csv").write_text("x")
        for_marker = (json.dumps({"transport_id": n[:2], "feed": "f", "cob_date": "2026-01-01", "files": [{"path": f"file:{root / n / 'data.csv'}", "bytes": 1, "sha256": "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"}], "completed_at": "2026-01-02T00:00:00Z"}))
        (root / n / "COMPLETE.json").write_text(for_marker)
        (root / n / "_COMPLETE.json").write_text(for_marker)
    seen = []
    ledger = lambda s: s.createDataFrame([(t,) for t in seen], "transport_id string") if seen else None
    for _ in range(2):
        q = arrivals.watch(arrivals.unique_markers(arrivals.markers(spark, str(root))), lambda r: seen.append(r["transport_id"]), ledger, str(tmp_path / "cp"))
        q.awaitTermination()
    assert sorted(seen) == ["t1", "t2"]
    batch = arrivals.listed_markers(spark, [str(root)])
    assert batch.count() == 3 and arrivals.unreconciled(batch, batch.where("transport_id = 't1'"), date(2026, 1, 1)).count() == 1
    ok = arrivals.valid_transports(batch.where("transport_id = 't2'"), D.file_evidence(spark, [str(root / "t2" / "data.csv")]))
    assert ok.first().is_valid


def test_value_functions(spark):
    row = spark.createDataFrame([(" N/A ", "null", "\tx", "2026-13-01", "20260105", "WR", None)], "a string, b string, c string, d string, e string, f string, g string")
    got = row.select(C.clean_string("a"), C.clean_string("b"), C.clean_string("c"), C.parse_date("d"), C.parse_date("e"), C.grade_band("f"), C.grade_band("g"), C.rating_rank("f"), C.change_pct(F.lit(5), F.lit(0)), C.yes_no_flag("b")).first()
    assert list(got) == [None, "null", "\tx", None, date(2026, 1, 5), "SUB_INVESTMENT_GRADE", None, None, None, None]
    assert C.ident("a b") == "`a b`" and C.ident("f(x)") == "f(x)"


def test_models_and_objects(spark, tmp_path):
    import json

    from ledgerline.plans import models
    from ledgerline.sources import objects

    feed = Feed("f", r"F_(?P<cob_date>\d{8})\.csv", ("k",), {"k": "k", "x": "x"})
    for bad in (["k"], ["z"]):
        with pytest.raises(ContractError):
            models.dimension(feed, bad)
    raw = raw_rows(spark, STEPS[0])
    full = models.dimension(feed, ["x"])(raw)
    assert models.dimension(feed, ["x"])(raw, full).count() == full.count()
    assert models.prepared(feed)(raw.withColumns({"_received_at": F.lit(None).cast("timestamp"), "_ingest_ts": F.lit("2026-01-01").cast("timestamp")}), knowledge="2026-01-01").count() == 7
    ran = []
    graph = {"b": (["a"], lambda: ran.append("b")), "a": (["raw.x"], lambda: ran.append("a")), "c": (["raw.y"], lambda: ran.append("c"))}
    assert models.run_in_order(graph, {"raw.x"}) == ["a", "b"] == ran
    assert len(models.business_dates(raw)) == 2
    store = objects.Objects(spark, str(tmp_path / "o"))
    assert store.put("a/b", b"1") and not store.put("a/b", b"1") and store.get("a/b") == b"1"
    with pytest.raises(objects.Immutable):
        store.put("a/b", b"2")
    assert json.loads(store.get(store.manifest("d", [{"path": "p"}], {}))) == {"delivery_id": "d", "parts": [{"path": "p"}], "contract": {}}
    assert store.quarantine("x.csv", b"?", "ragged")["bytes"] == 1
    assert objects.route(["F_20260101.csv", "G"], [feed]) == {"F_20260101.csv": "f", "G": None}
    assert objects.stable([{"a": 1}, {"a": 2, "b": 1}, {"a": 2, "b": 2}]) == ["a"]
    place = tmp_path / "legacy" / "f" / "2026-01-01"
    place.mkdir(parents=True)
    (place / "r.json").write_text(json.dumps({"reference": "r1", "rows": [{"k": 1}, {"k": 2}], "aggregates": {}}))
    legacy = objects.LegacyResults(spark, str(tmp_path / "legacy"))
    assert legacy.fetch("f", "2026-01-01").count() == 2 and legacy.evidence("f", "2026-01-01").first().reference == "r1"


def test_gaps_and_statuses_rest_on_all_events(spark, tmp_path):
    import duckdb

    from ledgerline.plans.queries import ORACLE, QUERIES

    # user 7 is in no multiple of 40, and only it shows that 2024-01-02 and a week are missing
    rows = [(1, datetime(2024, 1, 1, 5), 7, "view"), (2, datetime(2024, 1, 16, 5), 7, "view"), (3, datetime(2024, 1, 2, 5), 40, "view"), (4, datetime(2024, 1, 10, 5), 41, "click"), (7, datetime(2024, 1, 11, 5), 7, "view")]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT event_id, ts::TIMESTAMP AS ts, user_id, event_type FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    for name in ("gaps_daily_all", "gaps_weekly_all", "feed_status_all"):
        got = sorted(tuple(map(str, r)) for r in QUERIES[name](spark, str(tmp_path)).collect())
        assert got == sorted(tuple(map(str, r)) for r in con.execute(ORACLE[name]).fetchall()), name
        if name == "gaps_daily_all":
            assert got == [("view-7", "2024-01-02"), ("view-7", "2024-01-10")]
        if name == "feed_status_all":
            assert len(got) == 5
