"""Column profiles and dialects, tag windows, orphan tables, and lineage by kinds of expressions."""

import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import lineage, maintain, snapshot
from ledgerline.operators.refs import SnapshotStore
from ledgerline.sources import delivery as D


def test_profiles_of_parts_add_up(spark):
    rows = [("1", "1.5", "2026-01-02", "true", "x", None, " 7 "), ("-20", "2", "2026-12-31", "FALSE", "1", None, "7"), (None, ".5e3", None, "true", "y", None, "")]
    df = spark.createDataFrame(rows, "i string, d string, t string, b string, s string, e string, p string").repartition(3)
    got = {r.column_name: r for r in D.column_profile(df).collect()}
    assert {c: r.kind for c, r in got.items()} == {"i": "integer", "d": "decimal", "t": "date", "b": "boolean", "s": "string", "e": "string", "p": "string"}
    assert (got["i"].nulls, got["e"].nulls, got["i"].n_rows, got["s"].about_distinct) == (1, 3, 3, 3)
    assert "Expand" not in D.column_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in D.key_statistics(df)._jdf.queryExecution().executedPlan().toString()


def test_keys_equal_exact_counts(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 4999).alias("near"), (F.col("id") % 10).alias("few"), F.when(F.col("id") > 0, F.col("id")).alias("gap"))
    assert D.key_candidates(df) == ["k"]
    assert {r.column_name: (r.distinct_values, r.n_rows, r.is_key) for r in D.key_statistics(df).collect()} == {"k": (5000, 5000, True), "near": (4999, 5000, False), "few": (10, 5000, False), "gap": (4999, 5000, False)}
    assert D.key_candidates(df.where("false")) == []


def test_dialects_are_told_from_all_ranges(spark, tmp_path):
    rng = random.Random(1)
    for separator in D.SEPARATORS:
        for quote in D.QUOTES:
            other = "," if separator != "," else ";"
            lines = [separator.join(["id", "name", "amount", "day"])]
            lines += [separator.join([str(n), f"{quote}a{separator} {other}b{quote}" if n % 3 else f"o{other}k", f"{rng.random():.3f}", "2026-01-02"]) for n in range(300)]
            path = tmp_path / f"{ord(separator)}-{ord(quote)}.csv"
            path.write_text("\n".join(lines) + "\n")
            told = D.sniff(spark, str(path), path.read_bytes()[:2000])
            assert (told["delimiter"], told["quote"], told["header"]) == (separator, quote, True), (separator, quote)
            assert told["kinds"] == {"id": "integer", "name": "string", "amount": "decimal", "day": "date"} and "id" in told["keys"]
    path = tmp_path / "plain.csv"
    path.write_text("1,x\n2,y\n")
    told = D.sniff(spark, str(path), b"1,x\n")
    assert told["header"] is False and told["columns"] == ["_c0", "_c1"] and told["kinds"]["_c0"] == "integer"


def test_tags_are_judged_by_their_reports_window(spark, tmp_path):
    at = lambda *d: datetime(*d, 12, tzinfo=timezone.utc).timestamp()
    tags = [
        ("published/fx/2015-01-31/r1", at(2016, 1, 10)),  # taken over ten years ago
        ("published/fx/2015-01-31/r2", at(2026, 1, 10)),  # an old date, restated today
        ("published/fx/2015-01-31/r3", None),  # no time: judged by its date
        ("published/fx/2026-01-31/r4", None),
        ("published/short/2024-01-31/r5", at(2024, 2, 1)),
        ("published/2015-01-31/r6", at(2015, 2, 1)),  # names no report
        ("published/fx/latest", at(2001, 1, 1)),
        ("published/other/2001-01-31/r7", at(2001, 2, 1)),
    ]
    windows = spark.createDataFrame([("fx", 10.0), ("short", 1.0), (None, 5.0)], "report string, keep_years double")
    judged = {r.tag.rpartition("/")[2]: (r.verdict, r.judged_on) for r in maintain.judged_tags(spark.createDataFrame(tags, "ref string, taken_at double"), windows, datetime(2026, 6, 1)).collect()}
    assert judged == {"r1": ("expire", "taken"), "r2": ("keep", "taken"), "r3": ("expire", "date"), "r4": ("keep", "date"), "r5": ("expire", "taken"), "r6": ("expire", "taken"), "latest": ("foreign", None), "r7": ("unresolved", "taken")}
    store = SnapshotStore(spark, str(tmp_path / "s"))
    for n, *_ in tags[:2] + tags[7:]:
        store.tag(n)
    with pytest.raises(maintain.RetentionRefused):
        maintain.sweep_tags(store, {"fx": 10.0}, datetime(2126, 1, 1))
    assert maintain.sweep_tags(store, {"fx": 10.0, "other": 999.0}, datetime(2126, 1, 1)) == ["published/fx/2015-01-31/r1", "published/fx/2015-01-31/r2"]


def test_orphan_tables(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    b = store.branch("w")
    for t in ("known", "unknown", "old"):
        store.write(spark.range(3), t, b)
    store.merge(b)
    store.tag("pin")
    store.delete(b)
    c = store.branch("x")
    store.write(spark.range(3), "lost", c)
    store.delete(c)
    store._change("main", lambda state: {**state, "tables": {t: s for t, s in state["tables"].items() if t != "old"}})
    assert {(r.table_name, r.standing, r.parts) for r in maintain.orphan_tables(store, {"known"}).collect()} == {("unknown", "main", 1), ("old", "pinned", 1), ("lost", "unnamed", 1)}


def test_lineage_is_told_by_kinds_of_expressions(spark):
    rows = spark.createDataFrame([(1, "a", [1, 2], date(2026, 1, 1))], "k int, name string, xs array<int>, _cob_date date")
    rows.createOrReplaceTempView("lineage_rows")
    told = lambda df: lineage.classify_columns(df)
    got = told(rows.select("k", F.lit("max(k) sum(k)").alias("text"), F.upper("name").alias("up"), F.col("_cob_date").alias("day"), F.sum("k").over(Window.partitionBy("name")).alias("running"), F.row_number().over(Window.orderBy("k")).alias("place"), F.explode("xs").alias("x")))
    assert got == {"k": ("sourced", ["k"]), "text": ("literal", []), "up": ("sourced", ["name"]), "day": ("ingest_added", ["_cob_date"]), "running": ("windowed", ["k", "name"]), "place": ("windowed", ["k"]), "x": ("generated", ["xs"])}
    got = told(rows.groupBy("name").agg((F.max("k") + 1).alias("top"), F.count("*").alias("n")).withColumn("twice", F.col("top") * 2))
    assert got == {"name": ("sourced", ["name"]), "top": ("row_aggregate", ["k"]), "n": ("row_aggregate", []), "twice": ("row_aggregate", ["k"])}
    got = told(spark.sql("SELECT (SELECT max(k) FROM lineage_rows) AS top, name FROM lineage_rows"))
    assert got == {"top": ("row_aggregate", ["k"]), "name": ("sourced", ["name"])}
    both = rows.select(F.col("name").alias("v")).union(rows.select(F.col("k").cast("string")))
    assert told(both) == {"v": ("sourced", ["k", "name"])}
    assert told(rows.select(F.col("name").alias("v")).intersect(rows.select(F.col("k").cast("string").alias("w"))))["v"] == ("sourced", ["k", "name"])


def test_columns_stand_in_a_fixed_order(spark):
    df = spark.createDataFrame([(1, "d", date(2026, 1, 1), "f", "a", date(2026, 1, 1), True)], "derived int, b string, cob_date date, source_file string, a string, effective_from date, is_current boolean")
    assert snapshot.in_order(df.drop("effective_from", "is_current"), ["a", "b"]).columns == ["cob_date", "a", "b", "source_file", "derived"]
    assert snapshot.in_order(df.drop("cob_date"), ["a", "b"], scd2=True).columns == ["a", "b", "source_file", "derived", "effective_from", "is_current"]
    assert [(r.cob_date, r.n_rows) for r in snapshot.rows_per_date(df, "cob_date").collect()] == [(date(2026, 1, 1), 1)]
