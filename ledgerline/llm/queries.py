"""The queries of this subpackage and the SQL that checks them, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table, vocabulary


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .multi_index import nearest_neighbours

    return nearest_neighbours(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"), 4, 85)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import suffix_dedup_report

    return suffix_dedup_report(table(spark, sf_dir, "documents", "doc_id", "text"), 100)


def op3_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pivot_index import top_products

    return top_products(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import fit, pii_report

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pii_report(docs, fit(docs))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("byte_bpe_50k.json"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify_languages

    return identify_languages(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import piece_report

    return piece_report(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("piece_bpe_32k.model"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity_report

    return toxicity_report(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import secret_report

    return secret_report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_svm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_report

    return quality_report(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whitening_report

    return whitening_report(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import manifest

    return manifest(table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    """SQL for the exact queries; learned, approximate and tokenizing ones have none."""
    from . import oracle

    return {"op2_jaccard_join": oracle.JACCARD, "op3_pivot_index": oracle.PRODUCTS, "op6_suffix_dedup": oracle.PASSAGES, "op10_secret_scan": oracle.secrets(), "op13_merkle": oracle.merkle()}
