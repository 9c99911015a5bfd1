"""The corpus pipeline: from raw documents to packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and works on all that the
stage before kept. ``run`` writes each stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import broadcast_if_small, plain_allocator, settle_heaps, staged, table, vocabulary
from ledgerline.llm.jaccard_join import jaccard_components
from ledgerline.llm.packing import pack
from ledgerline.llm.pii import fit as fit_tagger
from ledgerline.llm.pii import redact
from ledgerline.llm.suffix_dedup import suffix_dedup
from ledgerline.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score is 0.7 or more. Null and empty texts have the score of
    a text without words; rows that repeat, or have no id, are each scored by their own text."""
    return drop_toxic(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each group linked by a similarity of 0.8 over five-word
    shingles. Documents without words, or without an id, are in no group and stay. Of rows that
    repeat a doc_id with equal columns, one stays; other rows of one doc_id are documents of their
    own, each in the group of its own text, and of those in one group one stays."""
    several = staged(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "several")
    if several.isEmpty():
        groups = jaccard_components(docs, 5, 80)
        gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
        return docs.join(staged(gone, "gone"), "doc_id", "left_anti").select(docs.columns)
    several = broadcast_if_small(several)
    single = docs.join(several, "doc_id", "left_anti").select(docs.columns)
    rows = staged(own_ids(docs.join(several, "doc_id", "left_semi").select(docs.columns).distinct(), docs), "rows")
    named = single.select("doc_id", "text").union(rows.select("__own", "text"))
    groups = staged(jaccard_components(named, 5, 80).where("doc_id is not null").toDF("id", "n", "component"), "groups")
    # Own ids have no order. Of a component with any, the row of least doc_id, then own id, stays.
    owned = rows.select(F.col("__own").alias("id"), "doc_id")
    mixed = staged(groups.join(broadcast_if_small(owned), "id", "left_semi").select("component").distinct(), "mixed")
    inside = groups.join(broadcast_if_small(mixed), "component", "left_semi").join(broadcast_if_small(owned), "id", "left")
    first = staged(inside.groupBy("component").agg(F.min(F.struct(F.coalesce("doc_id", "id").alias("doc_id"), "id")).alias("m")).select("component", F.col("m.id").alias("stays")), "first")
    gone = groups.join(broadcast_if_small(first), "component", "left").where(F.col("id") != F.coalesce("stays", "component"))
    gone = staged(gone.select("id"), "gone")
    kept = rows.join(gone, rows["__own"] == gone["id"], "left_anti").select(docs.columns)
    return single.join(gone, single["doc_id"] == gone["id"], "left_anti").select(docs.columns).union(kept)


def own_ids(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` with a column __own of hashes that differ from each other and from all ids of
    ``docs``: a seed with which any meet is given up for the next."""
    ids = docs.select("doc_id")
    rows = staged(rows, "distinct")
    n = rows.count()
    for seed in range(100):
        out = rows.withColumn("__own", F.xxhash64(F.lit(seed), *[F.struct(F.col(c).isNull(), c) for c in rows.columns]))
        told = out.select("__own")
        if told.distinct().count() == n and ids.join(told, ids["doc_id"] == told["__own"], "left_semi").isEmpty():
            return out
    raise ValueError("no seed keeps own ids apart")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 100 bytes or more that an earlier document, or place, already has. Null and
    shorter texts stay as they are, as do rows without an id; rows of one id with different texts
    lose the places that any of them loses."""
    return suffix_dedup(docs, 100)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets. A null text stays null; rows that repeat, or
    have no id, are each rewritten by their own text."""
    return redact(docs, fit_tagger(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the remaining documents into sequences of 2048 tokens. A null or empty text is the
    closing id alone; rows that repeat, or have no id, are packed each."""
    return pack(docs, vocabulary("byte_bpe_50k.json"))


def _rested(stage):
    """``stage`` on executors and a driver that have given back what the stage before needed."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        settle_heaps(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [("toxicity", toxicity), *[(name, _rested(stage)) for name, stage in (("near duplicates", near_duplicates), ("repeated passages", repeated_passages), ("personal data", personal_data), ("packing", packing))]]

#: Learned models, links of unbounded length and tokenizers can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain_allocator()
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
