"""Tree ensembles over the feature table (M1-M4).

Parameters carry the names tuned parameter files use (``n_estimators``,
``max_depth``, ...) and are mapped to Spark ML here. No scaling step: trees do
not care about the scale of a feature.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame

from linksieve.operators.features import FEATURE_NAMES

SEED = 42
# Spark ML grows trees to this depth at most; "unbounded" means this.
DEEPEST = 30

# Default parameters.
FOREST_DEFAULTS = {
    "n_estimators": 300,
    "max_depth": None,
    "min_samples_split": 2,
    "min_samples_leaf": 1,
    "max_features": "sqrt",
    "random_state": SEED,
}
BOOSTED_DEFAULTS = {
    "n_estimators": 400,
    "max_depth": 8,
    "learning_rate": 0.2,
    "subsample": 0.9,
    "colsample_bytree": 0.9,
    "min_child_weight": 1,
    "gamma": 0.0,
    "random_state": SEED,
}

# Node statistics of more nodes at once mean fewer passes over the rows.
_TREE_GROWTH = {"checkpointInterval": 10, "maxMemoryInMB": 1024}

# The model's working columns; private names, so that no column of a user's table is hit.
FEATURES, RAW, PROBABILITY, PREDICTION = "__features", "__raw", "__probability", "__prediction"
#: All features of a row as one stored vector.
VECTOR = "feature_vector"
_COLUMNS = {"featuresCol": FEATURES, "predictionCol": PREDICTION}


def _depth(value: int | None) -> int:
    if value is not None and value > DEEPEST:
        raise ValueError(f"max_depth {value}: trees grow to {DEEPEST} levels at most; None means that")
    return DEEPEST if value is None else int(value)


def forest_params(params: dict) -> dict:
    """Spark ML parameters of a random forest.

    Spark bounds the size of children, not of the node to split: children of at
    least half the minimum split size keep smaller nodes from being split.
    """
    smallest = max(params["min_samples_leaf"], math.ceil(params["min_samples_split"] / 2))
    return {
        "numTrees": int(params["n_estimators"]),
        "maxDepth": _depth(params["max_depth"]),
        "minInstancesPerNode": int(smallest),
        "featureSubsetStrategy": str(params["max_features"]),
        "seed": params["random_state"],
    }


def boosted_params(params: dict) -> dict:
    """Spark ML parameters of gradient-boosted trees.

    Columns are drawn per node rather than per tree; ``min_child_weight`` becomes a
    row count and ``gamma`` a minimum gain, the nearest Spark ML has.
    """
    return {
        "maxIter": int(params["n_estimators"]),
        "maxDepth": _depth(params["max_depth"]),
        "stepSize": float(params["learning_rate"]),
        "subsamplingRate": float(params["subsample"]),
        "featureSubsetStrategy": str(float(params["colsample_bytree"])),
        "minInstancesPerNode": int(params["min_child_weight"]),
        "minInfoGain": float(params["gamma"]),
        "seed": params["random_state"],
    }


def with_vector(features: DataFrame, keep: Sequence[str], name: str = VECTOR) -> DataFrame:
    """``keep`` and all feature columns as one vector, in the order of ``FEATURE_NAMES``.

    Pipelines built with ``vector=name`` cut what they need out of it.
    """
    assembler = VectorAssembler(inputCols=list(FEATURE_NAMES), outputCol=name)
    return assembler.transform(features).select(*keep, name)


def _pipeline(classifier, features: Sequence[str], vector: str | None) -> Pipeline:
    classifier.setRawPredictionCol(RAW).setProbabilityCol(PROBABILITY)
    if vector is None:
        inputs = VectorAssembler(inputCols=list(features), outputCol=FEATURES)
    else:
        places = [FEATURE_NAMES.index(f) for f in features]
        inputs = VectorSlicer(inputCol=vector, outputCol=FEATURES, indices=places)
    return Pipeline(stages=[inputs, classifier])


def _merged(defaults: dict, overrides: dict) -> dict:
    unknown = set(overrides) - set(defaults)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    return {**defaults, **overrides}


def build_random_forest(
    features: Sequence[str] = FEATURE_NAMES, vector: str | None = None, **overrides
) -> Pipeline:
    """M1. Random forest; ``max_features`` is ``sqrt``, ``log2`` or a share of the columns."""
    params = forest_params(_merged(FOREST_DEFAULTS, overrides))
    # Many deep trees: node ids are kept with the rows (and checkpointed), so that
    # executors need no copy of the growing trees. Boosting grows one small tree at
    # a time, where shipping it is faster.
    forest = RandomForestClassifier(maxBins=128, cacheNodeIds=True, **_COLUMNS, **_TREE_GROWTH, **params)
    return _pipeline(forest, features, vector)


def build_boosted_trees(
    features: Sequence[str] = FEATURE_NAMES, vector: str | None = None, **overrides
) -> Pipeline:
    """M2. Gradient-boosted trees on histogram splits with log loss."""
    params = boosted_params(_merged(BOOSTED_DEFAULTS, overrides))
    trees = GBTClassifier(maxBins=256, lossType="logistic", **_COLUMNS, **_TREE_GROWTH, **params)
    return _pipeline(trees, features, vector)


BUILDERS: dict[str, Callable[..., Pipeline]] = {
    "random_forest": build_random_forest,
    "boosted_trees": build_boosted_trees,
}
_DEFAULTS = {"random_forest": FOREST_DEFAULTS, "boosted_trees": BOOSTED_DEFAULTS}
_TO_SPARK = {"random_forest": forest_params, "boosted_trees": boosted_params}


def _log_uniform(low: float, high: float) -> Callable[[random.Random], float]:
    return lambda draw: math.exp(draw.uniform(math.log(low), math.log(high)))


def _whole(low: int, high: int) -> Callable[[random.Random], int]:
    return lambda draw: draw.randrange(low, high)


def _real(low: float, high: float) -> Callable[[random.Random], float]:
    return lambda draw: draw.uniform(low, high)


def _one_of(*values) -> Callable[[random.Random], object]:
    return lambda draw: draw.choice(values)


# The ranges a search draws from. Of four depths two are Spark's deepest, which stands
# for 30 and for 40 levels.
SEARCH_SPACES: dict[str, dict[str, Callable[[random.Random], object]]] = {
    "random_forest": {
        "n_estimators": _whole(150, 400),
        "max_depth": _one_of(None, 20, 30, DEEPEST),
        "min_samples_split": _whole(2, 12),
        "min_samples_leaf": _whole(1, 5),
        "max_features": _one_of("sqrt", "log2", 0.4),
    },
    "boosted_trees": {
        "n_estimators": _whole(200, 600),
        "max_depth": _whole(6, 14),
        "learning_rate": _log_uniform(0.03, 0.4),
        "subsample": _real(0.6, 1.0),
        "colsample_bytree": _real(0.6, 1.0),
        "min_child_weight": _whole(1, 10),
        "gamma": _real(0.0, 0.4),
    },
}


def draw_params(name: str, draws: int, seed: int = SEED, fixed: dict | None = None) -> list[dict]:
    """M4. Seeded random draws from a model's search space; ``fixed`` pins entries."""
    source = random.Random(seed)
    return [
        {key: pick(source) for key, pick in SEARCH_SPACES[name].items()} | (fixed or {})
        for _ in range(draws)
    ]


def fitted_as(model: PipelineModel, name: str, params: dict) -> bool:
    """Whether ``model`` was fitted with exactly these parameters (defaults for the rest)."""
    fitted = model.stages[-1]
    wanted = _TO_SPARK[name](_merged(_DEFAULTS[name], params))
    return all(fitted.getOrDefault(key) == value for key, value in wanted.items())


def param_map(name: str, pipeline: Pipeline, params: dict) -> dict:
    """The same parameters as a Spark ML param map for the pipeline's classifier."""
    classifier = pipeline.getStages()[-1]
    spark_params = _TO_SPARK[name](_merged(_DEFAULTS[name], params))
    return {classifier.getParam(key): value for key, value in spark_params.items()}
