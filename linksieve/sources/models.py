"""Fitted models on storage, with what they expect of their input."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from linksieve.functions.lexicons import DEFAULT_LEXICONS, Lexicons
from linksieve.operators.features import FEATURE_VERSION
from linksieve.operators.scoring import THRESHOLD, check_contract
from linksieve.sources.versions import read_if_there

DEFAULT_MODEL = "boosted_trees"


def model_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def contract_of(
    model: PipelineModel, lexicons: Lexicons = DEFAULT_LEXICONS, threshold: float = THRESHOLD
) -> dict:
    """What a model was fitted on: its columns in order, the version and lists they were made with."""
    return {
        "columns": list(model.stages[0].getInputCols()),
        "feature_version": FEATURE_VERSION,
        "lexicons": lexicons.fingerprint(),
        "threshold": threshold,
    }


def save_model(
    model: PipelineModel,
    folder: str,
    name: str,
    lexicons: Lexicons = DEFAULT_LEXICONS,
    threshold: float = THRESHOLD,
) -> str:
    """Store a model and its contract beside it; ``lexicons`` are those its features were made with."""
    path = model_path(folder, name)
    model.contract = contract_of(model, lexicons, threshold)
    model.write().overwrite().save(path)
    spark = SparkSession.active()
    row = spark.createDataFrame([(json.dumps(model.contract),)], "contract string")
    row.coalesce(1).write.mode("overwrite").json(f"{path}.contract")
    return path


def load_model(
    folder: str, name: str = DEFAULT_MODEL, lexicons: Lexicons | None = DEFAULT_LEXICONS
) -> PipelineModel:
    """The stored model, with its contract as ``contract``.

    Raises where the model was fitted on features of another version, other lists than
    ``lexicons`` or other columns than its contract says. None checks nothing.
    """
    path = model_path(folder, name)
    try:
        model = PipelineModel.load(path)
    except (AnalysisException, Py4JJavaError) as error:
        if "PATH_NOT_FOUND" in str(error) or "does not exist" in str(error):
            raise FileNotFoundError(f"no model at {path}: run the train plan first") from error
        raise
    spark = SparkSession.active()
    stored = read_if_there(lambda: spark.read.schema("contract string").json(f"{path}.contract"))
    row = stored.first() if stored is not None else None
    if row is not None:
        model.contract = json.loads(row.contract)
    if lexicons is not None:
        if row is None:
            raise ValueError(f"the model at {path} has no contract: fit and save it again")
        if model.contract["columns"] != list(model.stages[0].getInputCols()):
            raise ValueError(f"the model at {path} reads other columns than its contract says")
        check_contract(model, lexicons)
    return model
