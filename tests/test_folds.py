"""State kept by streams: equal to the batch operators on all that has come, across restarts."""

import random

from pyspark.sql import functions as F

from ledgerline.operators.calendar import receipt_state
from ledgerline.streaming import folds

RANKS = {"DISCOVERED": 0, "LANDED": 1, "INGESTED": 2}


def run(spark, source, schema, build, checkpoint, out):
    """One start of the query: all batches that are there, each appended to ``out``."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(source)
    query = build(stream)
    keep = lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(out)
    mode = "update" if build.__name__ == "told_stages" else "append"
    query.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination(120)


def test_stages_equal_the_batch_fold_across_restarts(spark, tmp_path):
    rng = random.Random(2)
    schema = "transport_id string, status string, occurred_at double"
    source, events = tmp_path / "in", []
    source.mkdir()

    def told_stages(stream):
        return folds.stages(stream, RANKS)

    for n in range(4):
        batch = [(rng.choice("abcdef"), rng.choice([*RANKS, "FAILED", "ODD"]), rng.uniform(0, 10)) for _ in range(12)] + events[:2]
        events += batch
        spark.createDataFrame(batch, schema).coalesce(1).write.json(str(tmp_path / f"b{n}"))
        part = next((tmp_path / f"b{n}").glob("part-*.json"))
        part.rename(source / f"{n}.json")
        run(spark, str(source), schema, told_stages, str(tmp_path / "check"), str(tmp_path / "out"))  # a new start for each batch
        want = {r.transport_id: r.status for r in receipt_state(spark.createDataFrame(events, schema), RANKS).collect()}
        newest = spark.read.parquet(str(tmp_path / "out")).groupBy("transport_id").agg(F.max_by("status", "batch").alias("status"))
        assert {r.transport_id: r.status for r in newest.collect()} == want


def test_files_settle_once_across_restarts(spark, tmp_path):
    schema = "name string, size long, polled_at double"
    source = tmp_path / "in"
    source.mkdir()

    def told_files(stream):
        return folds.settled_files(stream, 3)

    polls = [[("a", 1, 1.0), ("b", 5, 1.0)], [("a", 2, 2.0), ("b", 5, 2.0)], [("a", 2, 3.0), ("b", 5, 3.0), ("a", 9, 0.5)], [("a", 2, 4.0), ("b", 5, 4.0)], [("b", 6, 5.0)], [("b", 6, 6.0), ("b", 6, 7.0)]]
    for n, batch in enumerate(polls):
        spark.createDataFrame(batch, schema).coalesce(1).write.json(str(tmp_path / f"b{n}"))
        next((tmp_path / f"b{n}").glob("part-*.json")).rename(source / f"{n}.json")
        if n in (1, 3, 5):
            run(spark, str(source), schema, told_files, str(tmp_path / "check"), str(tmp_path / "out"))
    got = sorted((r.name, r.size, r.settled_at) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", 2, 4.0), ("b", 5, 3.0), ("b", 6, 7.0)]
