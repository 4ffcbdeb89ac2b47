"""From raw documents to packed token sequences, in five stages.

Each stage works on all rows that the one before it kept, and all but the last return the columns of
``documents``: the classifier and the rules drop documents they reject (the rules also remove failing
lines from the texts they keep), near-duplicates leave one document of a group, secrets are replaced
in the text, and the rest is packed. ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linksieve.llm import minmax_dedup, packing, quality_classifier, quality_rules, secret_scans
from linksieve.session import scratch_path


def _with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose grade is likely the top one, by a model of the labelled ones."""
    return quality_classifier.select_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def cleaned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, without their failing lines."""
    return _with_length(quality_rules.clean_documents(docs))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 5-word shingles, similarity 0.8."""
    return minmax_dedup.keep_one(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return _with_length(secret_scans.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece: document, ids, sequence and offset."""
    return packing.pack(docs, keep=[])


STAGES = [
    ("quality classifier", classified),
    ("quality rules", cleaned),
    ("near duplicates", deduplicated),
    ("secrets", redacted),
    ("packing", packed),
]

#: Tokenization, the fitted model and min-max hashing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
