"""Whitening against a dense eigendecomposition and exact integer sums."""

import math

import numpy as np
import pytest

from linksieve.llm import embedding_whitening as W
from linksieve.llm.queries import LLM_QUERIES


def dense(vectors, components=8):
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], np.int64)
    n, sums = len(x), [int(s) for s in x.sum(axis=0, dtype=object)]
    deviations = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = x - x.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    total = float((centred**2).sum() / n)
    return deviations, np.abs(centred @ directions / np.sqrt(values)), values / total


def check(rows, ids, vectors, components=8, close=1e-8):
    deviations, white, explained = dense(vectors, components)
    count = white.shape[1]
    assert len(rows) == count * len(ids)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    for i, key in enumerate(ids):
        mine = by_id[key]
        assert sorted(mine) == list(range(1, count + 1))
        assert {r.deviation for r in mine.values()} == {deviations[i]} and {r.n for r in mine.values()} == {len(ids)}
        assert [abs(mine[c + 1].whitened) for c in range(count)] == pytest.approx(white[i], abs=close)
        assert [mine[c + 1].explained for c in range(count)] == pytest.approx(explained, rel=1e-9)
    assert rows[0].identity_error < 1e-8 and rows[0].residual < 1e-11


def test_table(spark, sf_dir):
    rows = LLM_QUERIES["op11_whitening"](spark, sf_dir).collect()
    stored = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    check(rows, [r.vec_id for r in stored], [r.embedding for r in stored])
    again = LLM_QUERIES["op11_whitening"](spark, sf_dir).collect()
    first, second = ({(r.vec_id, r.component): r.whitened for r in run} for run in (rows, again))
    assert all(first[k] == pytest.approx(second[k], abs=1e-9) for k in first)


@pytest.mark.parametrize("size", [1, 3, 20, 45])
def test_random_vectors(spark, size):
    draw = np.random.default_rng(size)
    vectors = (draw.standard_normal((150, size)) * np.geomspace(3, 0.05, size) + draw.standard_normal(size)).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(5)
    check(W.whiten(df).collect(), range(150), vectors, min(8, size))


def test_a_filter_damps_the_unwanted_spectrum(spark):
    class Diagonal:
        def __init__(self, values):
            self.values = np.array(values)

        def times_covariance(self, block):
            return self.values[:, None] * block

    values = [10.0, 8.0, 5.0, 1.0, 0.5, 0.0]
    out = np.diag(W.filtered(Diagonal(values), np.eye(6), 1.0, 10.0, 6))
    assert abs(out[0]) == pytest.approx(1) and abs(out[2]) > 1e-3
    assert (np.abs(out[3:]) < 1e-5).all()
    degree = [W.filtered(Diagonal(values), np.eye(6), 1.0, 10.0, d)[3, 3] for d in (2, 4, 8)]
    assert abs(degree[2]) < abs(degree[1]) < abs(degree[0])


def test_few_directions_among_many_dimensions(spark):
    draw = np.random.default_rng(3)
    vectors = (np.round(draw.standard_normal((80, 3)) * 512) @ draw.integers(-3, 4, (3, 40)) / 1024.0).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    rows = W.whiten(df).collect()
    assert {r.component for r in rows} == {1, 2, 3} and sum(
        r.explained for r in rows if r.vec_id == 0
    ) == pytest.approx(1)
    check(rows, range(80), vectors, 3)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, -1.0], [0.25, 3.0], [-2.0, 0.125], [-2.0, 0.125]]
    bad = [None, [], [None, 1.0], [nan, 1.0], [inf, 1.0], [1e300, 1.0], [1.0, 2.0, 3.0]]
    data = [(i if i != 3 else None, v, "x") for i, v in enumerate(good)] + [(2, v, "y") for v in bad]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, Whitened string")
    rows = W.whiten(df).collect()
    check(rows, [0, 1, 2, None], good)
    assert W.whiten(df.limit(0)).count() == 0 and W.whiten(df.limit(0)).columns == W.whiten(df).columns
    assert W.whiten(df.filter("vec_id = 0")).count() == 0  # no variance, nothing to whiten
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<float>")
    assert W.whiten(same).count() == 0


def test_deviations_beyond_a_long(spark):
    vectors = [[3e6, 1.0], [-3e6, 2.0], [0.5, 5.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    rows = {r.vec_id: r.deviation for r in W.whiten(df).collect()}
    exact = [d if d < 2**63 else None for d in dense(vectors)[0]]
    assert [rows[i] for i in range(3)] == exact and None in exact and exact[2] is not None


def test_passes_have_few_tasks(spark):
    """However many splits the vectors come in, a pass has some tasks for each core, and one adds up their sums."""
    draw = np.random.default_rng(1).integers(0, 50, (300, 12)).tolist()
    most = W.TASKS * spark.sparkContext.defaultParallelism
    table = spark.createDataFrame(list(enumerate(draw)), "key long, x array<long>").repartition(most + 20)
    vectors = W.Vectors(table, 12)
    assert vectors.table.rdd.getNumPartitions() == most
    assert vectors.sums == np.sum(draw, axis=0).tolist() and vectors.n == 300
    covariance = np.cov(np.array(draw).T, bias=True)
    assert vectors.times_covariance(np.eye(12)) == pytest.approx(covariance, abs=1e-9)
