"""The batch jobs, each reading and writing tables under one shared folder.

``corpus -> features -> splits -> train -> evaluate / ablation`` and ``score``.
Jobs hand over written tables only, so each can run on its own cluster and a
failed one is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linksieve.operators.corpus import audit, unanimous, url_groups
from linksieve.operators.models import BUILDERS
from linksieve.operators.scoring import score_urls, verdicts
from linksieve.operators.splits import domain_disjoint_split, make_splits
from linksieve.plans.ablation import ablation, memorisation_gap
from linksieve.plans.evaluate import evaluate_models, write_evaluation
from linksieve.plans.train import train_models
from linksieve.sources.features import load_features
from linksieve.sources.models import DEFAULT_MODEL, load_model
from linksieve.sources.reports import read_best_params, rounded, write_report
from linksieve.sources.urls import load_raw, read_corpus, write_corpus


def corpus_job(spark: SparkSession, folder: str, *raw_paths: str) -> DataFrame:
    """Raw shards to the clean corpus and its audit row.

    The grouped URLs are stored, as both results follow from them: the shards are
    read and shuffled once.
    """
    url_groups(load_raw(spark, *raw_paths)).write.mode("overwrite").parquet(f"{folder}/url_groups")
    groups = spark.read.parquet(f"{folder}/url_groups")
    write_corpus(unanimous(groups), f"{folder}/corpus")
    write_report(rounded(audit(groups)), f"{folder}/reports/corpus_audit", "json")
    return read_corpus(spark, f"{folder}/corpus")


def features_job(spark: SparkSession, folder: str, rebuild: bool = False) -> DataFrame:
    """Corpus to the stored feature table."""
    return load_features(read_corpus(spark, f"{folder}/corpus"), f"{folder}/features", rebuild)


def splits_job(spark: SparkSession, folder: str) -> None:
    """Feature table to both split tables, laid out by split so that a reader of
    the train rows opens no test file."""
    features = features_job(spark, folder)
    for name, cut in (("random", make_splits), ("disjoint", domain_disjoint_split)):
        cut(features).write.mode("overwrite").partitionBy("split").parquet(f"{folder}/splits/{name}")


def split_table(spark: SparkSession, folder: str, name: str = "random") -> DataFrame:
    return spark.read.parquet(f"{folder}/splits/{name}")


def train_job(spark: SparkSession, folder: str, **options) -> list[dict]:
    """Tune, refit and store every model."""
    table = split_table(spark, folder)
    options = {"journal": f"{folder}/journal/search", **options}
    return train_models(table, f"{folder}/models", f"{folder}/reports/best_params", **options)[1]


def evaluate_job(spark: SparkSession, folder: str) -> DataFrame:
    """Reports of all stored models on the test rows."""
    models = {name: load_model(f"{folder}/models", name) for name in BUILDERS}
    result = evaluate_models(models, split_table(spark, folder))
    write_evaluation(result, f"{folder}/reports", list(BUILDERS))
    return result.comparison


def ablation_job(spark: SparkSession, folder: str) -> DataFrame:
    """All ablation studies with the tuned parameters."""
    params = read_best_params(spark, f"{folder}/reports/best_params", BUILDERS)
    tables = split_table(spark, folder), split_table(spark, folder, "disjoint")
    results = ablation(*tables, params, journal=f"{folder}/journal/ablation")
    write_report(rounded(results), f"{folder}/reports/ablation_results")
    write_report(rounded(memorisation_gap(results)), f"{folder}/reports/memorisation_gap")
    return results


def score_job(
    spark: SparkSession,
    folder: str,
    urls: DataFrame,
    output: str,
    model: str = DEFAULT_MODEL,
    url: str = "url",
    threshold: float | None = None,
) -> None:
    """Verdicts for a table of raw URLs, by the model's own threshold if none is given."""
    scored = score_urls(load_model(f"{folder}/models", model), urls, url, threshold)
    verdicts(scored, url).write.mode("overwrite").parquet(output)


JOBS: dict[str, Callable] = {
    "corpus": corpus_job,
    "features": features_job,
    "splits": splits_job,
    "train": train_job,
    "evaluate": evaluate_job,
    "ablation": ablation_job,
}
