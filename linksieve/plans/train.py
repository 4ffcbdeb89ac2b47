"""Tune, refit, validate and store every model (M6)."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from linksieve.operators.metrics import score_metrics
from linksieve.operators.models import BUILDERS, SEED
from linksieve.operators.scoring import score_features
from linksieve.operators.tuning import tune
from linksieve.session import ensure_checkpoint_dir
from linksieve.sources.models import save_model
from linksieve.sources.reports import write_best_params


def train_models(
    table: DataFrame,
    model_folder: str,
    report_path: str,
    models: Iterable[str] = tuple(BUILDERS),
    seed: int = SEED,
    fixed: dict[str, dict] | None = None,
    **search,
) -> tuple[dict[str, PipelineModel], list[dict]]:
    """M6. Fit each model on all train rows with its best searched parameters.

    ``table`` is a stored feature table with ``url``, ``label`` and ``split``.
    ``search`` is passed to :func:`tune`; ``fixed`` pins parameters per model.
    Returns the models and one summary per model, which is also written.
    """
    spark = table.sparkSession
    ensure_checkpoint_dir(spark)
    train = table.filter("split = 'train'")
    validation = table.filter("split = 'val'")
    sizes = {r["split"]: r["count"] for r in table.groupBy("split").count().collect()}
    fitted, summaries = {}, []
    for name in models:
        pinned = (fixed or {}).get(name, {})
        tuning = tune(name, train, seed=seed, fixed=pinned, **search)
        started = time.perf_counter()
        fitted[name] = BUILDERS[name](**tuning.best).fit(train)
        seconds = round(time.perf_counter() - started, 1)
        metrics = score_metrics(score_features(fitted[name], validation)).first().asDict()
        summaries.append(
            {
                "model": name, "best_params": tuning.best, "best_f1": tuning.best_f1,
                "fit_seconds": seconds, "artifact": save_model(fitted[name], model_folder, name),
                **metrics,
                "n_train": sizes.get("train", 0), "n_val": sizes.get("val", 0),
                "n_test": sizes.get("test", 0),
                "n_features": len(fitted[name].stages[0].getInputCols()), "random_state": seed,
            }
        )
    write_best_params(spark, summaries, report_path)
    return fitted, summaries
