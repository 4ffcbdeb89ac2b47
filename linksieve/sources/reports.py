"""Small result tables and tuned parameters on storage."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRIC_DIGITS = 5
IMPORTANCE_DIGITS = 6

_BEST_PARAMS = """
model string, best_params string, best_f1 double, fit_seconds double, artifact string,
accuracy double, precision double, recall double, f1 double, roc_auc double,
n_train long, n_val long, n_test long, n_features int, random_state int
"""


def rounded(df: DataFrame, digits: int = METRIC_DIGITS) -> DataFrame:
    """Every real-valued column rounded."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_report(df: DataFrame, path: str, form: str = "csv") -> None:
    """S5. A report of metric rows as a single CSV (with header), JSON or Parquet file.

    For tables of models, metrics or features, whose size does not depend on the data.
    """
    writer = df.coalesce(1).write.mode("overwrite")
    if form == "csv":
        writer = writer.option("header", True)
    writer.format(form).save(path)


def write_best_params(spark: SparkSession, rows: Iterable[dict], path: str) -> None:
    """S5. One row per model: tuned parameters, fit time, validation metrics, counts."""
    names = T.StructType.fromDDL(_BEST_PARAMS).names
    flat = [
        tuple(json.dumps(r[n], sort_keys=True) if n == "best_params" else r.get(n) for n in names)
        for r in rows
    ]
    write_report(spark.createDataFrame(flat, _BEST_PARAMS), path, "json")


def read_best_params(spark: SparkSession, path: str, models: Iterable[str]) -> dict[str, dict]:
    """S6. Tuned parameters per model; no entry (builder defaults) where none are stored."""
    try:
        rows = spark.read.schema(_BEST_PARAMS).json(path).select("model", "best_params").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    stored = {r["model"]: json.loads(r["best_params"]) for r in rows}
    return {name: stored.get(name, {}) for name in models}
