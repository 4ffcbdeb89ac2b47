"""Quality classifier: ordinal cumulative-link regression on graded ratings.

``P(grade <= k) = sigmoid(threshold_k - w . x)``: one vector of weights over hashed text features is
shared by all grades, and the thresholds are kept in order. The model gives the expected grade and
the probability of the top grade, by which documents are selected.

Features are the distinct words of the whole text, ASCII letters in lower case, the stems of words
(their first ``STEM`` bytes) and, of words with other letters, all runs of ``GRAM`` characters, hashed
into ``BUCKETS``, and a few measures of its form: symbols, exclamation marks, capitals, repetition. The
model is fitted in one task on ``FIT_ROWS`` labelled documents at most, those whose ids hash lowest. A
lasso keeps rare features out: it is a share of the rows, so it acts alike at every number of them.
Scoring is one pass without a shuffle.

Null and empty texts have no words. Labels that lack a rating are left out; of several for one id the
lowest grade counts, and of several documents the text whose digest is lowest. Without labels of two grades nothing can be told apart: all documents are kept
and the figures are null. Rows are scored each for itself.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructField

from linksieve.llm.texts import column, remembered, text_columns

BUCKETS = 1 << 18
FIT_ROWS = 16_000
STEM = 4
GRAM = 3
LEAST_TAIL = 0.5

STEPS = 200
RATE = 0.2
LASSO = 1e-3

_AS_WORDS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#*$%&|<>"


def grade(quality: Column, toxic: Column) -> Column:
    """0 poor and toxic, 1 poor or toxic, 2 neither."""
    return F.when(quality == 0, 0).otherwise(1) + F.when(toxic == 1, 0).otherwise(1)


def _grams(word: bytes) -> list[bytes]:
    """The runs of ``GRAM`` characters of a word with the blanks around it."""
    text = f" {word.decode('utf-8', 'replace')} "
    return [b"*" + text[i : i + GRAM].encode() for i in range(len(text) - GRAM + 1)]


def features(text: str | None) -> set[bytes]:
    """Distinct words, stems and grams, and measures of form in steps; no word holds a sign of the others."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().translate(_AS_WORDS).split()
    whole = set(words)
    found = whole | {b"^" + word[:STEM] for word in whole if word.isascii()}
    for word in whole:
        if not word.isascii():
            found.update(_grams(word))

    def measure(name: bytes, share: float) -> None:
        found.add(b"%s=%d" % (name, max(0, round(2 * math.log2(share * 256))) if share else -1))

    size = max(1, len(raw))
    distinct = len(whole) / max(1, len(words))
    measure(b"symbols", (len(raw) - len(raw.translate(None, _SYMBOLS))) / size)
    measure(b"exclaims", raw.count(b"!") / size)
    measure(b"capitals", (len(raw) - len(raw.translate(None, _CAPITALS))) / size)
    measure(b"distinct", distinct)
    return found


def bucket(feature: bytes) -> int:
    return zlib.crc32(feature) & (BUCKETS - 1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def negative_log_likelihood(
    parameters: np.ndarray, ids: np.ndarray, of: np.ndarray, grades: np.ndarray, top: int
) -> tuple[float, np.ndarray]:
    """Mean over the rows, and its gradient.

    ``parameters`` are the weights, the first threshold, and logarithms of the steps to the next
    ones. Row ``of[i]`` has the feature ``ids[i]``.
    """
    count, known = len(grades), len(parameters) - top
    weights, free = parameters[:known], parameters[known:]
    thresholds = free[0] + np.r_[0, np.cumsum(np.exp(free[1:]))]
    lower, upper = grades - 1, grades  # the grade lies between these thresholds
    score = np.bincount(of, weights[ids], minlength=count)
    below = np.where(lower < 0, 0.0, sigmoid(thresholds[np.maximum(lower, 0)] - score))
    above = np.where(upper >= top, 1.0, sigmoid(thresholds[np.minimum(upper, top - 1)] - score))
    chance = np.maximum(above - below, 1e-12)
    slope_above, slope_below = above * (1 - above) / chance, below * (1 - below) / chance
    by_score = (slope_above - slope_below) / count
    gradient = np.empty_like(parameters)
    gradient[:known] = np.bincount(ids, by_score[of], minlength=known)
    by_threshold = np.zeros(top)
    np.subtract.at(by_threshold, np.minimum(upper, top - 1), np.where(upper < top, slope_above, 0) / count)
    np.add.at(by_threshold, np.maximum(lower, 0), np.where(lower >= 0, slope_below, 0) / count)
    gradient[known] = by_threshold.sum()
    for k in range(1, top):
        gradient[known + k] = by_threshold[k:].sum() * math.exp(free[k])
    return float(-np.log(chance).mean()), gradient


def fit(rows: list[np.ndarray], grades: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds, by gradient steps on the penalised likelihood."""
    ids = np.concatenate(rows) if rows else np.empty(0, np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    # the slope of a weight is at most its feature's share of the rows: up to the lasso it stays zero
    common = np.bincount(ids, minlength=BUCKETS) > LASSO * len(rows)
    known = np.flatnonzero(common)
    place = np.cumsum(common) - 1
    of, ids = of[common[ids]], place[ids[common[ids]]]
    shares = np.clip(np.cumsum(np.bincount(grades, minlength=top + 1))[:-1] / len(rows), 1e-3, 1 - 1e-3)
    levels = np.log(shares / (1 - shares))
    free = np.r_[levels[0], np.log(np.maximum(np.diff(levels), 1e-2))]
    parameters = np.r_[np.zeros(len(known)), free]
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        _, gradient = negative_log_likelihood(parameters, ids, of, grades, top)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        scale = RATE * min(1.0, 4 * (1 - (step - 1) / STEPS)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        parameters -= scale * (first / (1 - 0.9**step))
        shrunk = parameters[: len(known)]  # a view: the lasso's step
        np.copyto(shrunk, np.sign(shrunk) * np.maximum(np.abs(shrunk) - LASSO * scale[: len(known)], 0))
    weights = np.zeros(BUCKETS)
    weights[known] = parameters[: len(known)]
    free = parameters[len(known) :]
    return weights, free[0] + np.r_[0, np.cumsum(np.exp(free[1:]))]


def train(documents: DataFrame, ratings: DataFrame, text: str = "text", key: str = "doc_id", top: int = 2):
    """Weights and thresholds from ``ratings`` (``key``, ``grade`` from 0 to ``top``); None without two grades."""
    sample = (
        ratings.filter("grade IS NOT NULL")
        .select(column(key).alias("\x00id"), F.col("grade").cast("int").alias("\x00grade"))
        .filter(column("\x00id").isNotNull())
        .groupBy("\x00id")
        .agg(F.min("\x00grade").alias("\x00grade"))
        .orderBy(F.xxhash64("\x00id"), "\x00id")
        .limit(FIT_ROWS)
    )
    rated = (
        documents.select(column(key), column(text))
        .join(F.broadcast(sample), column(key) == column("\x00id"))  # FIT_ROWS rows
        .select("\x00id", "\x00grade", F.sha2(column(text), 256).alias("\x00digest"), column(text).alias("text"))
    )

    def make():
        return lambda texts: [[sorted({bucket(f) for f in features(t)}) for t in texts]]

    hashed = (
        text_columns(
            rated, make, [StructField("buckets", ArrayType(IntegerType()))], "text", ["\x00id", "\x00grade", "\x00digest"]
        )
        .groupBy("\x00id", "\x00grade")
        .agg(F.min_by("buckets", F.coalesce("\x00digest", F.lit(""))).alias("buckets"))
    )

    def fitted(table: pa.Table) -> pa.Table:
        grades = np.array(table.column(1).to_pylist(), np.int64)
        if len(np.unique(grades)) < 2:
            return pa.table({"weights": pa.array([], pa.binary()), "thresholds": pa.array([], pa.binary())})
        order = np.argsort(table.column(0).to_pylist(), kind="stable")
        rows = [np.array(r, np.int64) for r in table.column(2).to_pylist()]
        weights, thresholds = fit([rows[i] for i in order], grades[order], top)
        return pa.table({"weights": [weights.tobytes()], "thresholds": [thresholds.tobytes()]})

    model = hashed.groupBy().applyInArrow(fitted, "weights binary, thresholds binary").first()
    return model and (bytes(model.weights), bytes(model.thresholds))


class _Weights(dict):
    """Features to their weights, remembered while there is room."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, feature: bytes) -> float:
        if len(self) >= 400_000:
            self.clear()
        found = self[feature] = float(self.weights[bucket(feature)])
        return found


def score(df: DataFrame, model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``expected_grade``, ``tail_probability`` (of the top grade) and ``kept``."""
    fields = [
        StructField("expected_grade", DoubleType()),
        StructField("tail_probability", DoubleType()),
        StructField("kept", BooleanType()),
    ]
    if model is None:
        return text_columns(df, lambda: lambda t: [[None] * len(t), [None] * len(t), [True] * len(t)], fields, text, keep)
    shared = df.sparkSession.sparkContext.broadcast(model)
    model_id = hashlib.sha256(b"".join(model)).hexdigest()

    def make():
        weights, thresholds = (np.frombuffer(b) for b in shared.value)
        known = remembered(("classifier", model_id), lambda: _Weights(weights))

        def compute(texts):
            scores = np.array([math.fsum(map(known.__getitem__, features(t))) for t in texts])
            at_least = 1 - sigmoid(thresholds - scores.reshape(-1, 1))
            tail = at_least[:, -1]
            return [at_least.sum(axis=1), tail, tail >= LEAST_TAIL]

        return compute

    return text_columns(df, make, fields, text, keep)


def classify(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Scores of all documents by a model of the labelled ones (``quality``, ``toxic`` 0 or 1)."""
    rated = labels.filter("quality IS NOT NULL AND toxic IS NOT NULL")
    ratings = rated.select(column(key), grade(F.col("quality"), F.col("toxic")).alias("grade"))
    return score(documents, train(documents, ratings, text, key), text, [key])


def select_documents(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents that the model keeps, with all their columns."""
    rated = labels.filter("quality IS NOT NULL AND toxic IS NOT NULL")
    ratings = rated.select(column(key), grade(F.col("quality"), F.col("toxic")).alias("grade"))
    model = train(documents, ratings, text, key)
    renamed = documents.toDF(*(f"\x00{i}" for i in range(len(documents.columns))))
    at = f"\x00{documents.columns.index(text)}"
    return score(renamed, model, at).filter("kept").select(*renamed.columns).toDF(*documents.columns)
