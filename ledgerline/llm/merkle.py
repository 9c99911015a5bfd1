"""A Merkle manifest of a table: every row a leaf, a tree for each source, a tree over the sources.

Levels are DataFrames. The rows of a level have an index, counted over ranges of rows so that no
source is numbered by one task; the index divided by the fanout names the parent, and a parent's
children are gathered in order and hashed. Levels are written, so each is made once. From the root
down, each node then hands its children the siblings that lie on their way up, level by level.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_fold, staged

FANOUT = 16
COLUMNS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
STEP = "array<struct<left:string,right:string>>"


def _part(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*columns: Column) -> Column:
    """sha256 of the columns, each as its length in bytes, a colon and its value, or as a dash."""
    return F.sha2(F.concat(*[_part(c) for c in columns]).cast("binary"), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def leaves(docs: DataFrame) -> DataFrame:
    """(key, doc_id, leaf, altered, tie): ``key`` orders sources bytewise with null first; ``altered`` is the
    leaf of the tampered row where 5 divides the id's crc32, and null elsewhere. Hashes are bytes."""
    rest = [F.col("source"), F.col("lang"), F.col("n_chars")]
    tampered = F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id"), 5) == 0)
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(leaf_hash(F.col("doc_id"), *rest, F.col("text"))).alias("leaf"),
        F.when(tampered, F.unhex(leaf_hash(F.col("doc_id"), *rest, lowered(F.col("text"))))).alias("altered"),
    )
    return rows.withColumn("tie", F.monotonically_increasing_id())


def indexed(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``idx``, their index from 0 within their ``key``, and ``n``, their key's number of
    rows. Ranges of rows by key and ``order`` are numbered side by side and then moved by what lies
    before them, so a key of any size is spread; of ranges there is one small row each."""
    ranged = staged(rows.repartitionByRange("key", *order).withColumn("__range", F.spark_partition_id()), label)
    inside = Window.partitionBy("__range").orderBy("key", *order)
    numbered = ranged.withColumn("__at", F.row_number().over(inside).cast("long") - 1)
    sizes = {r["__range"]: r["count"] for r in ranged.groupBy("__range").count().collect()}
    starts, total = [], 0
    for at in sorted(sizes):
        starts.append((at, total))
        total += sizes[at]
    before = rows.sparkSession.createDataFrame(starts, "__range int, __start long")
    placed = numbered.join(F.broadcast(before), "__range").withColumn("__at", F.col("__at") + F.col("__start")).drop("__range", "__start")
    placed = staged(placed, label)
    keys = staged(placed.groupBy("key").agg(F.min("__at").alias("__first"), F.count("*").alias("n")), "keys")
    return placed.join(keys, "key").withColumn("idx", F.col("__at") - F.col("__first")).drop("__at", "__first")


def _hash_of(children: Column) -> Column:
    told = F.concat_ws("", F.transform(children, lambda c: F.lower(F.hex(c["h"]))))
    return F.unhex(F.sha2(told.cast("binary"), 256))


def levels(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Parents level by level. ``nodes``: (key, n, idx, h, and others that stay with the children).
    Each level: (key, n, idx, children, h), for keys that had several nodes below; ``n`` is the key's
    number of nodes on the level."""
    found = []
    more = [c for c in nodes.columns if c not in ("key", "n", "idx", "h")]
    while True:
        wide = nodes.where("n > 1")
        children = F.array_sort(F.collect_list(F.struct("idx", "h", *more)))
        parents = wide.groupBy("key", F.expr(f"idx div {FANOUT}").alias("parent")).agg(F.first("n").alias("n"), children.alias("children"))
        parents = parents.select("key", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), F.col("parent").alias("idx"), "children", _hash_of(F.col("children")).alias("h"))
        parents = staged(parents, label)
        if parents.isEmpty():
            return found
        found.append(parents)
        nodes, more = parents.select("key", "n", "idx", "h"), []


def _handed_down(parents: DataFrame, ways: DataFrame) -> DataFrame:
    """(key, idx, child, way): what each child of ``parents`` has beside it on its way up: its
    siblings to the left and to the right, then its parent's way. ``ways``: (key, idx, way)."""
    def told(children):
        return F.concat_ws("", F.transform(children, lambda c: F.lower(F.hex(c["h"]))))

    below = parents.select("key", "idx", "children").join(ways, ["key", "idx"])
    below = below.select("key", "children", "way", *[c for c in ways.columns if c not in ("key", "idx", "way")], F.posexplode("children").alias("pos", "child"))
    left = told(F.slice("children", 1, F.col("pos")))
    right = told(F.slice("children", F.col("pos") + 2, FANOUT))
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    return below.withColumn("way", F.concat(step, "way")).withColumn("idx", F.col("child")["idx"]).drop("children", "pos")


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``
    (doc_id, source, lang, n_chars, text).

    Rows of one source are in the order of doc_id (null first), then of their leaves; rows that repeat
    are leaves each. A null doc_id isn't tampered with. A table without rows has no rows; a table of
    one row is its own root, and its proof the hash of nothing. Other columns are ignored.
    """
    spark = docs.sparkSession
    base = staged(leaves(docs), "leaves")
    ranked = staged(indexed(base, ["doc_id", "leaf", "tie"], "ranges").select("key", "n", "idx", F.col("leaf").alias("h"), "doc_id", "altered"), "ranked")
    if ranked.isEmpty():
        return spark.createDataFrame([], COLUMNS)
    inner = levels(ranked, "level")
    tops = ranked.where("n = 1").select("key", "h")
    for level in inner:
        tops = tops.union(level.where("n = 1").select("key", "h"))
    subroots = staged(tops, "subroots")
    # The sources are ranked as rows of one key, which are its nodes in turn.
    over = indexed(subroots.select(F.lit("").alias("key"), F.col("key").alias("source"), "h"), ["source"], "sources")
    over = staged(over.select("key", "n", "idx", "h", "source"), "over")
    outer = levels(over, "outer")
    root = F.lit(bytes((outer[-1] if outer else over).first()["h"]))

    def told(bytes_):
        return F.lower(F.hex(bytes_))

    nothing = F.array().cast(STEP)
    if outer:
        ways = spark.createDataFrame([("", 0)], "key string, idx long").withColumn("way", nothing)
        for level in reversed(outer[1:]):
            ways = staged(_handed_down(level, ways).drop("child"), "ways")
        down = _handed_down(outer[0], ways).select(F.col("child.source").alias("key"), F.col("child.h").alias("subroot"), "way")
    else:
        down = over.select(F.col("source").alias("key"), F.col("h").alias("subroot"), nothing.alias("way"))
    down = staged(down, "down")
    ways = None
    for level in reversed(inner[1:]):
        own = level.where("n = 1").select("key", "idx").join(down, "key")
        every = own if ways is None else own.unionByName(ways)
        ways = staged(_handed_down(level, every).drop("child"), "ways")
    alone = ranked.where("n = 1").select("key", "doc_id", F.col("h").alias("leaf"), "altered").join(down, "key")
    if inner:
        own = inner[0].where("n = 1").select("key", "idx").join(down, "key")
        every = own if ways is None else own.unionByName(ways)
        many = _handed_down(inner[0], every).select("key", F.col("child.doc_id").alias("doc_id"), F.col("child.h").alias("leaf"), F.col("child.altered").alias("altered"), "subroot", "way")
        alone = alone.unionByName(many)
    proof = F.sha2(F.concat_ws("", F.transform("way", lambda s: F.concat(s["left"], s["right"]))).cast("binary"), 256)
    folded = F.aggregate("way", told(F.coalesce("altered", "leaf")), lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]).cast("binary"), 256))
    out = alone.select("doc_id", told(F.col("leaf")).alias("leaf"), told(F.col("subroot")).alias("subroot"), told(root).alias("root"), proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
