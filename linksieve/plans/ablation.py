"""Ablation studies: feature families, training size, split strategy."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksieve.operators.features import FEATURE_FAMILIES, FEATURE_NAMES
from linksieve.operators.metrics import score_metrics
from linksieve.operators.models import BUILDERS, SEED, VECTOR, with_vector
from linksieve.operators.scoring import score_features
from linksieve.operators.splits import CURVE_FRACTIONS, with_curve_step
from linksieve.session import ensure_checkpoint_dir, scratch_path
from linksieve.sources.journal import Journal, fingerprint

RESULT_SCHEMA = """
study string, config string, model string, n_features int, train_rows long,
accuracy double, precision double, recall double, f1 double, roc_auc double, fit_seconds double
"""


def feature_configs() -> dict[str, tuple[str, ...]]:
    """A1. All features, each family alone, and all but each family."""
    configs = {"all_features": FEATURE_NAMES}
    configs |= {f"only_{family}": names for family, names in FEATURE_FAMILIES.items()}
    configs |= {
        f"without_{family}": tuple(n for n in FEATURE_NAMES if n not in set(names))
        for family, names in FEATURE_FAMILIES.items()
    }
    return configs


def run_config(
    name: str,
    params: dict,
    train: DataFrame,
    train_rows: int,
    test: DataFrame,
    features: Sequence[str] = FEATURE_NAMES,
) -> dict:
    """A2. Fit one model, score the test rows; metrics and wall time of both.

    The features are cut out of the stored vector of :func:`vectors` where the table has one.
    """
    ensure_checkpoint_dir(train.sparkSession)
    started = time.perf_counter()
    vector = VECTOR if VECTOR in train.columns else None
    model = BUILDERS[name](features, vector=vector, **params).fit(train)
    metrics = score_metrics(score_features(model, test)).first().asDict()
    seconds = round(time.perf_counter() - started, 1)
    return {
        "model": name, "n_features": len(features), "train_rows": train_rows, **metrics,
        "fit_seconds": seconds,
    }


def vectors(table: DataFrame) -> DataFrame:
    """A split feature table with all features as one vector, assembled and written once for all fits."""
    if VECTOR in table.columns:
        return table
    path = scratch_path(table.sparkSession, "vectors")
    with_vector(table, ["url", "label", "split"]).write.parquet(path)
    return table.sparkSession.read.parquet(path)


class _Study:
    """Results of one study; those a journal has already are not computed again."""

    def __init__(self, study: str, table: DataFrame, journal: str | None):
        self.study, self.spark = study, table.sparkSession
        self.table = vectors(table)
        self.journal = Journal(self.spark, journal)
        rows = ["url", "label", "split", vector_to_array(VECTOR)]
        self.data = fingerprint(self.table, rows) if journal else ""
        self.rows: list[dict] = []

    def split(self, name: str) -> DataFrame:
        return self.table.filter(F.col("split") == name)

    def run(self, config: str, name: str, params: dict, *args) -> None:
        identity = {"study": self.study, "config": config, "model": name, "params": params, "data": self.data}
        result = self.journal.once(identity, lambda: run_config(name, params, *args))
        self.rows.append({"study": self.study, "config": config, **result})

    def results(self) -> DataFrame:
        names = self.spark.createDataFrame([], RESULT_SCHEMA).columns
        return self.spark.createDataFrame([tuple(r[n] for n in names) for r in self.rows], RESULT_SCHEMA)


def family_ablation(table: DataFrame, params: dict[str, dict], journal: str | None = None) -> DataFrame:
    """A3. Every feature configuration with every model, on the same test rows."""
    study = _Study("feature_group", table, journal)
    train, test = study.split("train"), study.split("test")
    n = train.count()
    for config, columns in feature_configs().items():
        for name in params:
            study.run(config, name, params[name], train, n, test, columns)
    return study.results()


def learning_curve(
    table: DataFrame,
    params: dict[str, dict],
    fractions: tuple[float, ...] = CURVE_FRACTIONS,
    seed: int = SEED,
    journal: str | None = None,
) -> DataFrame:
    """A4. Every model on nested stratified samples of the train rows."""
    study = _Study("training_size", table, journal)
    test = study.split("test")
    stepped = with_curve_step(study.split("train"), fractions, seed)
    for step, fraction in enumerate(fractions):
        sample = stepped.filter(F.col("step") <= step)
        n = sample.count()
        for name in params:
            study.run(f"{round(fraction * 100)}pct", name, params[name], sample, n, test)
    return study.results()


def split_strategy(disjoint: DataFrame, params: dict[str, dict], journal: str | None = None) -> DataFrame:
    """A5. Every model on a domain-disjoint split (column ``split``)."""
    study = _Study("split_strategy", disjoint, journal)
    train, test = study.split("train"), study.split("test")
    n = train.count()
    for name in params:
        study.run("domain_disjoint", name, params[name], train, n, test)
    return study.results()


def memorisation_gap(results: DataFrame) -> DataFrame:
    """A5. F1 on the random split minus F1 on the domain-disjoint one, per model."""
    random = results.filter("study = 'training_size' and config = '100pct'")
    disjoint = results.filter("study = 'split_strategy'")
    return random.select("model", F.col("f1").alias("random_f1")).join(
        disjoint.select("model", F.col("f1").alias("disjoint_f1")), "model"
    ).withColumn("gap", F.col("random_f1") - F.col("disjoint_f1"))


def ablation(
    table: DataFrame, disjoint: DataFrame, params: dict[str, dict], journal: str | None = None
) -> DataFrame:
    """A6. All three studies in one table, 24 rows with two models.

    Vectors are assembled once for each of both splits. ``journal`` names a folder that keeps
    every result, so a broken job does only the fits that are left.
    """
    table = vectors(table)
    return (
        family_ablation(table, params, journal)
        .unionByName(learning_curve(table, params, journal=journal))
        .unionByName(split_strategy(disjoint, params, journal))
    )
