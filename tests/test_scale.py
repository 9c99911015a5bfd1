"""Operators for hot keys and partial rebuilds, against the plain ones."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import calendar, maintain, marts, reconcile, scd2
from ledgerline.operators.refs import SnapshotStore

DAY = date(2026, 1, 1)


def told(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_spread_join_equals_the_plain_one(spark):
    rng = random.Random(2)
    days = [(k, DAY + timedelta(d), str(rng.randint(0, 2))) for k in "ABC" for d in range(0, 400, 3 if k == "A" else 41) if rng.random() < 0.9]
    dimension = scd2.versions(spark.createDataFrame(days, "k string, cob_date date, v string"), ["k"], ["v"])
    facts = [("A" if rng.random() < 0.5 else rng.choice(["B", "C", "D", None]), DAY + timedelta(rng.randint(-20, 450)), n, {"m": n}) for n in range(3000)] + [("A", None, 5000, None), ("A", DAY, 5001, None), ("A", DAY, 5001, None)]
    facts = spark.createDataFrame(facts, "k string, at date, n long, m map<string,long>")
    columns = ["k", "at", "n", "v", "reference_effective_from"]
    for how in ("left", "inner"):
        plain = scd2.as_of_join(facts, dimension, ["k"], "at", how, ["v"])
        for part in (1_000_000, 20):
            spread = scd2.as_of_join_spread(facts, dimension, ["k"], "at", how, ["v"], part)
            assert spread.columns == plain.columns and told(spread, *columns) == told(plain, *columns)
    assert scd2.as_of_join_spread(facts.where("false"), dimension, ["k"], "at").count() == 0
    assert told(scd2.as_of_join_spread(facts, dimension.where("false"), ["k"], "at"), "n") == told(facts, "n")
    with pytest.raises(ValueError):
        scd2.as_of_join_spread(facts, dimension, ["k"], "at", "full")


def test_a_hot_key_is_read_by_many_tasks(spark):
    """Half of all facts have one key and one month; without adaptive splitting they still spread."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        dimension = scd2.versions(spark.createDataFrame([(k, DAY + timedelta(d), str(d)) for k in "AB" for d in range(0, 300, 2)], "k string, cob_date date, v string"), ["k"], ["v"])
        facts = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("k"), F.when(F.col("id") % 2 == 0, F.lit(DAY)).otherwise(F.date_add(F.lit(DAY), (F.col("id") % 300).cast("int"))).alias("at"), "id")
        largest = {}
        for name, out in (("plain", scd2.as_of_join(facts, dimension, ["k"], "at")), ("spread", scd2.as_of_join_spread(facts, dimension, ["k"], "at", part=500))):
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert sum(sizes) == 20_000
            largest[name] = max(sizes)
        assert largest["plain"] >= 10_000 and largest["spread"] <= 4_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def brute_differences(a, b):
    from collections import Counter

    sides = []
    for rows in (a, b):
        keys = {}
        for k, *v in rows:
            keys.setdefault(k, Counter())[tuple(v)] += 1
        sides.append(keys)
    return sorted((str(k), "legacy_only" if k not in sides[1] else "new_only" if k not in sides[0] else "changed") for k in {*sides[0], *sides[1]} if sides[0].get(k) != sides[1].get(k))


def test_tree_comparison_by_brute_force(spark):
    rng = random.Random(8)
    base = [(f"k{rng.randint(0, 400)}", rng.randint(0, 3), rng.choice(["x", None])) for _ in range(900)]
    other = [r if rng.random() > 0.02 else (r[0], r[1] + 1, r[2]) for r in base if rng.random() > 0.02] + [base[0], base[1], ("new", 1, None)]
    rng.shuffle(other)
    schema = "k string, a int, b string"
    a, b = spark.createDataFrame(base, schema), spark.createDataFrame(other, schema)
    for buckets in (16, 4096):
        got = reconcile.compare_by_tree(a, b, ["k"], ["a", "b"], buckets=buckets)
        assert sorted((r.k, r.status) for r in got.collect()) == brute_differences(base, other)
    twice = reconcile.compare_by_tree(a, a.union(a.where("k = 'k1'")), ["k"], ["a", "b"], buckets=256).collect()
    assert [(r.k, r.status) for r in twice] == [("k1", "changed")] and twice[0].new_rows == 2 * twice[0].legacy_rows


def test_equal_sides_end_at_the_root(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    digests = [reconcile.bucket_digests(df, ["k"], ["v"], 4096) for df in (rows, rows.repartition(7))]
    assert digests[0].exceptAll(digests[1]).count() == 0 and reconcile.differing_buckets(*digests, 4096) == []
    out = reconcile.compare_by_tree(rows, rows.repartition(7), ["k"], ["v"], digests=tuple(digests), buckets=4096)
    assert out.count() == 0 and "Scan" not in out._jdf.queryExecution().optimizedPlan().toString().replace("LocalTableScan", "")
    one = reconcile.bucket_digests(rows.withColumn("v", F.when(F.col("k") == 77, 9).otherwise(F.col("v"))), ["k"], ["v"], 4096)
    assert len(reconcile.differing_buckets(digests[0], one, 4096)) == 1


def exposures(spark, values):
    rows = [(d, k, x) for (d, k), x in values.items()]
    df = spark.createDataFrame(rows, "cob_date date, counterparty_id string, x int")
    return df.select("cob_date", "counterparty_id", F.col("x").cast("decimal(28,4)").alias("total_mtm"), F.col("x").cast("decimal(28,4)").alias("total_notional"), F.lit(1).cast("long").alias("trade_count"))


def test_change_mart_after_any_delivery_equals_a_full_build(spark, tmp_path):
    rng = random.Random(12)
    dates = [DAY + timedelta(n) for n in range(26, 38)]
    values = {(d, k): rng.randint(0, 5) for d in dates for k in "ABC" if rng.random() < 0.8}
    store = SnapshotStore(spark, str(tmp_path / "s"))
    b = store.branch("w")
    store.write(exposures(spark, values), "e", b, ["cob_date"])
    marts.rebuild_changes(store, "e", "c", b, [])
    steps = [
        {(dates[3], "A"): 9},  # an ordinary date: it and the next
        {(dates[4], "B"): 7},  # the last of January: the month-end of all of February
        {(DAY + timedelta(50), "A"): 3},  # a new date at the end
        {(DAY + timedelta(28, 1), "A"): 3},
        "gone",
    ]
    for step in steps:
        before = {e["folder"]: e["part"] for e in store.entries("c", b)}
        if step == "gone":
            lost = dates[6]
            values = {k: v for k, v in values.items() if k[0] != lost}
            store.drop_partitions("e", b, {f"cob_date={lost}"})
            restated = []
        else:
            values.update(step)
            restated = sorted({d for d, _ in step})
            store.replace_partitions(exposures(spark, {k: v for k, v in values.items() if k[0] in restated}), "e", b, "cob_date")
        done = marts.rebuild_changes(store, "e", "c", b, restated)
        full = marts.exposure_change(exposures(spark, values))
        assert told(store.read("c", b), *full.columns) == told(full, *full.columns)
        after = {e["folder"]: e["part"] for e in store.entries("c", b)}
        touched = {f"cob_date={d}" for d in (*done["rebuilt"], *done["dropped"])}
        assert all(after[f] == p for f, p in before.items() if f not in touched)
        if step == steps[0]:
            assert done["rebuilt"] == [dates[3], dates[4]]
        if step == "gone":
            assert done["dropped"] == [dates[6]] and done["rebuilt"] == [dates[7]]


def test_compaction_packs_what_is_small(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    b = store.branch("w")
    day = lambda d, x: spark.createDataFrame([(date(2026, 1, d), x)], "cob_date date, x int").coalesce(1)
    for x in range(7):
        store.append(day(9, x), "t", b, ["cob_date"])
    for x in range(3):
        store.append(day(8, 10 + x), "t", b)
        store.append(day(1, 20 + x), "t", b)
    limits = maintain.Thresholds(max_files_per_partition=5, recent_days=3)
    before = {e["part"]: e["folder"] for e in store.entries("t", b)}
    rows = told(store.read("t", b), "cob_date", "x")
    done = maintain.compact_recent(store, "t", b, date(2026, 1, 9), limits, ["x", "no_such"])
    assert done == {"decision": "many files in a partition", "bins": 1, "parts": 7}
    after = store.entries("t", b)
    assert told(store.read("t", b), "cob_date", "x") == rows
    assert [(e["files"]) for e in after if e["folder"] == "cob_date=2026-01-09"] == [1]
    assert all(before.get(e["part"]) == e["folder"] for e in after if e["folder"] != "cob_date=2026-01-09") and len(after) == 7
    assert [r.x for r in store.read("t", b, {"cob_date=2026-01-09"}).collect()] == list(range(7))
    again = maintain.compact_recent(store, "t", b, date(2026, 1, 9), limits)
    assert again == {"decision": "healthy", "bins": 0, "parts": 0}
    # with a target of less than one file each bin has one file, which is too few to rewrite
    assert maintain.compact_recent(store, "t", b, date(2026, 1, 9), maintain.Thresholds(max_files_per_partition=2, recent_days=3), target_mb=1e-4)["bins"] == 0
    assert maintain.compact_recent(store, "t", b, date(2027, 1, 9), limits)["decision"] == "empty"


def test_bins_are_cut_at_the_target(spark):
    parts = spark.createDataFrame([("a", f"p{n}", 1, 10) for n in range(12)] + [("a", "big", 1, 90), ("b", "q", 1, 10)], "folder string, part string, files long, bytes long")
    got = {}
    for r in maintain.packed_bins(parts, 50, 3).collect():
        got.setdefault(r.bin, set()).add((r.folder, r.part))
    assert [len(got[n]) for n in sorted(got)] == [5, 5] and sorted(got) == [0, 1] and all(f == "a" and p != "big" for own in got.values() for f, p in own)


def brute_gaps(days, lookback, weekly):
    calendar_days = sorted({d for _, d in days})
    calendar_days = calendar_days[-lookback:] if lookback else calendar_days
    name = (lambda d: "%04d-W%02d" % d.isocalendar()[:2]) if weekly else str
    out = set()
    for feed in {f for f, _ in days}:
        own = sorted(d for f, d in days if f == feed)
        out |= {(feed, name(c)) for c in calendar_days if own[0] <= c <= own[-1]} - {(feed, name(d)) for d in own}
    return sorted(out)


def test_gaps_by_brute_force(spark):
    rng = random.Random(4)
    for n in range(6):
        days = sorted({(f"f{rng.randint(0, 5)}", DAY + timedelta(rng.choice([0, 3, 200]) + rng.randint(0, 40))) for _ in range(40)})
        df = spark.createDataFrame(days, "feed string, cob_date date")
        for lookback in (0, 11):
            got = calendar.find_gaps(df, lookback, F.lit(n % 2 == 1))
            assert sorted((r.feed, r.missing) for r in got.collect()) == brute_gaps(days, lookback, n % 2 == 1)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_replay_of_most_keys_equals_replay_of_each(spark, monkeypatch):
    schema = "_cob_date date, _file_version int, _row_number long, k string, x string, _batch_id string"
    rng = random.Random(3)
    rows = [(DAY + timedelta(d), 1, n, k, str(rng.randint(0, 2)), "b") for d in range(8) for n, k in enumerate("ABCDEF") if rng.random() < 0.8]
    more = [(DAY + timedelta(7), 2, n, k, str(rng.randint(0, 2)), "c") for n, k in enumerate("ABCDEG")]
    columns = {"k": "string", "x": "string"}
    target = scd2.build_full(spark.createDataFrame(rows, schema), columns, ["k"], ["x"])
    target = spark.createDataFrame(target.collect(), target.schema)
    for held in (rows + more, [r for r in rows + more if r[0] != DAY]):  # raw may have lost its first date
        raw = spark.createDataFrame(held, schema)
        ends = []
        for most in (0.0, 9.9):
            monkeypatch.setattr(scd2, "MOST", most)
            ends.append(told(scd2.replay(raw, target, columns, ["k"], ["x"], 1), "k", "x", *scd2.RANGE))
        assert ends[0] == ends[1] == told(scd2.build_full(spark.createDataFrame(rows + more, schema), columns, ["k"], ["x"]), "k", "x", *scd2.RANGE)


def test_buckets_grow_with_rows_and_many_differences_need_no_list(spark, monkeypatch):
    """Of many keys of which a share differs, few are opened; whole numbers have the formatter's text."""
    from ledgerline.functions.conform import canonical_value

    monkeypatch.setattr(reconcile, "BUCKETS", 64)
    monkeypatch.setattr(reconcile, "NAMED", 3)
    made, plain = [], reconcile.differing

    def differing(*args):
        made.append((args[2], plain(*args)))
        return made[-1][1]

    monkeypatch.setattr(reconcile, "differing", differing)
    new = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    old = new.withColumn("v", F.when(F.col("k") % 1000 == 5, F.col("v") + 1).otherwise(F.col("v")))
    out = reconcile.compare_by_tree(old, new, ["k"], ["v"]).collect()
    assert sorted(int(float(r["k"])) for r in out) == list(range(5, 20_000, 1000)) and {r["status"] for r in out} == {"changed"}
    assert made[0][0] >= 20_000 // 64 and made[0][1].count() <= 20
    values = spark.sql("select * from values (0D), (-0D), (3D), (-7D), (0.5D), (1e14D), (1e16D), (-1e300D), (double('NaN')), (double('Infinity')), (null) t(x)")
    assert values.where(~canonical_value(F.col("x"), values.schema["x"].dataType).eqNullSafe(F.format_string("%.10f", "x"))).count() == 0
    longs = spark.sql("select * from values (0L), (-3L), (9007199254740993L), (-9223372036854775808L), (null) t(x)")
    assert longs.where(~canonical_value(F.col("x"), longs.schema["x"].dataType).eqNullSafe(F.format_string("%.10f", F.col("x").cast("double")))).count() == 0
