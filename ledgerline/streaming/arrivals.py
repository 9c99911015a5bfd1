"""The front door as a stream: completion markers arrive, each delivery is ingested once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKER = "transport_id string, feed string, cob_date date, files array<struct<path:string,bytes:bigint,sha256:string>>, completed_at timestamp"


def markers(spark: SparkSession, root: str, name: str = "COMPLETE.json") -> DataFrame:
    """A stream of completion markers, written last by the producer. Spark's file source hides
    names that begin with an underscore; such markers are found by ``listed_markers``."""
    return spark.readStream.schema(MARKER).option("recursiveFileLookup", True).option("pathGlobFilter", name).option("multiLine", True).json(root)


def listed_markers(spark: SparkSession, roots: list[str], name: str = "_COMPLETE.json") -> DataFrame:
    """The markers below some folders (say, those of recent dates), whatever their name: the
    driver lists the folders and reads the small files through Hadoop's file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    texts = []
    for root in roots:
        fs = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
        walk = fs.listFiles(hadoop(root), True)
        while walk.hasNext():
            path = walk.next().getPath()
            if path.getName() == name:
                stream = fs.open(path)
                texts.append((spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"),))
                stream.close()
    return spark.createDataFrame(texts, "body string").select(F.from_json("body", MARKER).alias("m")).select("m.*")


def unique_markers(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """Each transport once within the watermark; the ledger catches later repeats."""
    return stream.withWatermark("completed_at", delay).dropDuplicatesWithinWatermark(["transport_id"])


def watch(stream: DataFrame, ingest: Callable[[dict], None], ledger: Callable[[SparkSession], DataFrame | None], checkpoint: str):
    """Hands each new transport to ``ingest``, oldest date first. ``ledger`` gives the transports
    already ingested (transport_id), so a replayed batch does nothing twice. A batch is as many
    markers as arrived, each one small record."""

    def handle(batch: DataFrame, _: int) -> None:
        known = ledger(batch.sparkSession)
        fresh = batch.dropDuplicates(["transport_id"])
        if known is not None:
            fresh = fresh.join(known.select("transport_id").distinct(), "transport_id", "left_anti")
        for row in fresh.orderBy("cob_date", "completed_at").toLocalIterator():
            ingest(row.asDict(recursive=True))

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def valid_transports(markers: DataFrame, evidence: DataFrame) -> DataFrame:
    """(transport_id, files, wrong, is_valid): each listed file is there with its bytes and digest."""
    listed = markers.select("transport_id", F.explode("files").alias("f")).select("transport_id", "f.path", "f.bytes", "f.sha256")
    found = evidence.select("path", F.col("length").alias("_bytes"), F.col("sha256").alias("_sha"))
    wrong = F.col("_bytes").isNull() | (F.col("_bytes") != F.col("bytes")) | (F.col("_sha") != F.col("sha256"))
    return listed.join(found, "path", "left").groupBy("transport_id").agg(F.count("*").alias("files"), F.count_if(wrong).alias("wrong")).withColumn("is_valid", F.col("wrong") == 0)


def unreconciled(markers: DataFrame, delivered: DataFrame, since) -> DataFrame:
    """Markers of recent dates without a delivery."""
    return markers.where(F.col("cob_date") >= F.lit(since)).join(delivered.select("transport_id").distinct(), "transport_id", "left_anti")


def arrivals_per_window(stream: DataFrame, width: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Arrivals per feed and time window, with late ones up to the delay."""
    return stream.withWatermark("completed_at", delay).groupBy(F.window("completed_at", width), "feed").agg(F.count("*").alias("arrivals"))
