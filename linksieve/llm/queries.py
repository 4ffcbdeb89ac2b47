"""Registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linksieve.llm import (
    bpe,
    byte_bpe,
    collocations,
    embedding_dedup,
    embedding_whitening,
    html_extraction,
    license_scans,
    minmax_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secret_scans,
    sharding,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the line-first rules for every document."""
    return quality_rules.verdicts(_table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, top-grade probability and verdict for every document."""
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, similarity 0.85."""
    return minmax_dedup.deduplicate(_table(spark, sf_dir, "documents"), size=3, percent=85)


def op4_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a bounded-load ring of eight shards."""
    return sharding.shard_rows(_table(spark, sf_dir, "documents"))


def op5_graph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings by search in a pruned graph."""
    return embedding_dedup.deduplicate(_table(spark, sf_dir, "embeddings"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as counts and digests."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"), keep=["doc_id"])


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: fixed patterns and token efficiency."""
    return secret_scans.counts(_table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.extract(_table(spark, sf_dir, "pages"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' tokens in sequences of 4096."""
    return packing.digests(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return license_scans.scan(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their eight leading components, each of variance one."""
    return embedding_whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids and decoded bytes of every document, as counts and digests."""
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), keep=["doc_id"])


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language of all documents."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_quality_classifier,
        op3_minmax_dedup,
        op4_ring_shards,
        op5_graph_dedup,
        op6_bpe,
        op7_secret_scan,
        op8_html_extraction,
        op9_best_fit_packing,
        op10_license_scan,
        op11_whitening,
        op12_byte_bpe,
        op13_collocations,
    )
}

LLM_ORACLES: dict[str, str] = {
    "op1_quality_rules": quality_rules.oracle_sql(),
    "op13_collocations": collocations.oracle_sql(),
}
