"""Apply a fitted model to URLs (M7, M9) and read it (E5)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linksieve.functions.canonical import canonicalize
from linksieve.functions.lexicons import DEFAULT_LEXICONS, Lexicons
from linksieve.operators.features import FEATURE_VERSION, require_free, with_features
from linksieve.operators.models import FEATURES, PREDICTION, PROBABILITY, RAW
from linksieve.session import checkpointed

THRESHOLD = 0.5
#: URLs joined by broadcast where a table repeats them: a row of two numbers each.
COMMON_URLS = 1000


def featurize(
    df: DataFrame, url: str = "url", lexicons: Lexicons = DEFAULT_LEXICONS
) -> DataFrame:
    """S7. Feature columns of raw URLs, in the form the models were trained on.

    Canonicalises first: a raw ``https://`` would set features no training row had.
    The canonical URL is added as ``canonical_url``.
    """
    require_free(df, ["canonical_url"])
    canonical = F.coalesce(canonicalize(F.col(f"`{url}`")), F.lit(""))
    return with_features(df.withColumn("canonical_url", canonical), "canonical_url", lexicons=lexicons)


def score_features(model: PipelineModel, features: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``p_phish`` and ``prediction`` to a feature table, drop the model's own columns.

    A freshly fitted forest would take its training summary, and the session that
    is in it, along to every task. Its copy has none.
    """
    require_free(features, ["p_phish", "prediction"])
    p = F.element_at(vector_to_array(PROBABILITY), 2)
    scored = model.copy().transform(features).withColumn("p_phish", p)
    return scored.withColumn("prediction", (F.col("p_phish") >= threshold).cast("int")).drop(
        FEATURES, RAW, PROBABILITY, PREDICTION
    )


def check_contract(model: PipelineModel, lexicons: Lexicons = DEFAULT_LEXICONS) -> None:
    """Raise if a model with a contract was fitted on features made in another way."""
    contract = getattr(model, "contract", None)
    if contract is None:
        return
    if contract["feature_version"] != FEATURE_VERSION:
        raise ValueError(
            f"the model was fitted on features of version {contract['feature_version']}, not {FEATURE_VERSION}"
        )
    if contract["lexicons"] != lexicons.fingerprint():
        raise ValueError("the model was fitted on features made with other lists; pass those, or fit it again")


def _threshold(model: PipelineModel, threshold: float | None) -> float:
    """The given threshold, else that of the model's contract, else one half."""
    if threshold is not None:
        return threshold
    return (getattr(model, "contract", None) or {}).get("threshold", THRESHOLD)


def score_urls(
    model: PipelineModel,
    df: DataFrame,
    url: str = "url",
    threshold: float | None = None,
    lexicons: Lexicons = DEFAULT_LEXICONS,
) -> DataFrame:
    """M7. Score raw URLs: ``df`` plus ``canonical_url, p_phish, prediction``.

    One map-only stage; the same call works on a streaming frame. A model with a contract
    is refused if its lists or its feature version are others than those used here.
    """
    check_contract(model, lexicons)
    scored = score_features(model, featurize(df, url, lexicons), _threshold(model, threshold))
    return scored.select(
        *[F.col(f"`{c}`") for c in df.columns], "canonical_url", "p_phish", "prediction"
    )


def score_repeated_urls(
    model: PipelineModel,
    df: DataFrame,
    url: str = "url",
    threshold: float | None = None,
    lexicons: Lexicons = DEFAULT_LEXICONS,
) -> DataFrame:
    """M7. The rows of :func:`score_urls` for a table in which URLs repeat, such as a log.

    Every canonical URL is scored once and joined back. The ``COMMON_URLS`` commonest, whose
    rows may be any share of the table, are joined by broadcast where their rows stand;
    without them no URL has more than that share of the rows that are shuffled.
    """
    check_contract(model, lexicons)
    require_free(df, ["canonical_url", "p_phish", "prediction", "__hot"])
    canonical = F.coalesce(canonicalize(F.col(f"`{url}`")), F.lit(""))
    rows = df.withColumn("canonical_url", canonical)
    # a table on storage, as three reads of it follow
    counted = checkpointed(rows.groupBy("canonical_url").agg(F.count(F.lit(1)).alias("rows")))
    features = with_features(counted.select("canonical_url"), "canonical_url", lexicons=lexicons)
    scored = score_features(model, features, _threshold(model, threshold))
    scored = checkpointed(scored.select("canonical_url", "p_phish", "prediction"))
    common = counted.orderBy(F.desc("rows"), "canonical_url").limit(COMMON_URLS).select("canonical_url")
    hot = scored.join(F.broadcast(common), "canonical_url", "left_semi").withColumn("__hot", F.lit(True))
    looked_up = rows.join(F.broadcast(hot), "canonical_url", "left")
    names = [*[F.col(f"`{c}`") for c in df.columns], "canonical_url", "p_phish", "prediction"]
    found = looked_up.filter("__hot").select(*names)
    rest = looked_up.filter("__hot IS NULL").drop("p_phish", "prediction").join(scored, "canonical_url")
    return found.unionByName(rest.select(*names))


def verdicts(scored: DataFrame, url: str = "url") -> DataFrame:
    """M9. ``verdict, p, url`` with p to four places."""
    return scored.select(
        F.when(F.col("prediction") == 1, "PHISHING").otherwise("legitimate").alias("verdict"),
        F.round("p_phish", 4).alias("p"),
        F.col(f"`{url}`").alias("url"),
    )


def feature_importance(model: PipelineModel, name: str, spark) -> DataFrame:
    """E5. ``model, feature, importance``; sums to 1. One row per feature column."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, feature, float(weight)) for feature, weight in zip(names, weights)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def importance_table(importance: DataFrame, models: list[str], digits: int = 6) -> DataFrame:
    """E5. One row per feature, one rounded column per model."""
    wide = importance.groupBy("feature").pivot("model", models).agg(F.first("importance"))
    return wide.select("feature", *[F.round(m, digits).alias(m) for m in models])


def top_features(importance: DataFrame, k: int = 20) -> DataFrame:
    """E5. The ``k`` strongest features of each model with their place."""
    strongest = Window.partitionBy("model").orderBy(F.col("importance").desc(), "feature")
    return importance.withColumn("place", F.row_number().over(strongest)).filter(F.col("place") <= k)
