"""Evaluate models on the balanced test rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksieve.operators.metrics import (
    accumulate,
    confusion_of,
    corners,
    counted_scores,
    metrics_of,
    outcomes_of,
    rankable,
)
from linksieve.operators.scoring import feature_importance, importance_table, score_features
from linksieve.session import checkpointed
from linksieve.sources.reports import IMPORTANCE_DIGITS, METRIC_DIGITS, rounded, write_report


@dataclass(frozen=True)
class Evaluation:
    test_split: DataFrame
    comparison: DataFrame
    confusion: DataFrame
    roc: DataFrame
    importance: DataFrame


def scored_by_model(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """``model, label, prediction, p_phish`` of every test row under every model."""
    parts = [
        score_features(model, test).select(F.lit(name).alias("model"), "label", "prediction", "p_phish")
        for name, model in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def evaluate_models(models: dict[str, PipelineModel], table: DataFrame) -> Evaluation:
    """E7. Metrics, confusion cells, curves and importances of all models.

    The test rows are scored once per model and counted per score; every result
    follows from the counts.
    """
    spark = table.sparkSession
    test = table.filter("split = 'test'")
    counted = counted_scores(scored_by_model(models, test), ["model"])
    cumulative = checkpointed(accumulate(rankable(counted, ["model"]), ["model"]))
    importance = reduce(
        DataFrame.unionByName,
        [feature_importance(model, name, spark) for name, model in models.items()],
    )
    return Evaluation(
        test.agg(
            F.count(F.lit(1)).alias("n"),
            F.avg((F.col("label") == 1).cast("double")).alias("phishing_fraction"),
        ),
        metrics_of(counted, ["model"], cumulative),
        confusion_of(outcomes_of(counted, ["model"]), ["model"]),
        corners(cumulative, ["model"]),
        importance,
    )


def write_evaluation(result: Evaluation, folder: str, models: list[str]) -> None:
    """S5. The evaluation as report tables under ``folder``."""
    write_report(result.test_split, f"{folder}/test_split", "json")
    write_report(result.comparison, f"{folder}/metrics", "json")
    write_report(rounded(result.comparison, METRIC_DIGITS), f"{folder}/model_comparison")
    write_report(result.confusion, f"{folder}/confusion_matrices", "json")
    table = importance_table(result.importance, models, IMPORTANCE_DIGITS)
    write_report(table, f"{folder}/feature_importance")
    # One point per corner of the curve: this one grows with the test rows.
    result.roc.write.mode("overwrite").parquet(f"{folder}/roc_curve")
