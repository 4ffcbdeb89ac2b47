import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from linksieve.operators import metrics as M

HAND = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)]


def scored(spark, rows, threshold=0.5):
    df = spark.createDataFrame(rows, "label int, p_phish double")
    return df.withColumn("prediction", (F.col("p_phish") >= threshold).cast("int"))


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_curve(rows):
    pos, neg = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    pts = []
    for t in sorted({p for _, p in rows}, reverse=True):
        pts.append((sum(1 - y for y, p in rows if p >= t), sum(y for y, p in rows if p >= t), t))
    keep = []
    for i, pt in enumerate(pts):
        if 0 < i < len(pts) - 1:
            before = (pt[0] - pts[i - 1][0], pt[1] - pts[i - 1][1])
            after = (pts[i + 1][0] - pt[0], pts[i + 1][1] - pt[1])
            if before == after:
                continue
        keep.append(pt)
    return [(0.0, 0.0, float("inf"))] + [(a / neg, b / pos, t) for a, b, t in keep]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    return [(int(draw.random() < 0.4), round(draw.random() ** 3, 2)) for _ in range(700)]


def test_hand_case(spark):
    row = M.score_metrics(scored(spark, HAND)).first()
    assert row.asDict() == pytest.approx(
        {"accuracy": 0.75, "precision": 2 / 3, "recall": 1.0, "f1": 0.8, "roc_auc": 0.875}
    )
    cells = {(r.actual, r.predicted): (r.n, r.pct) for r in M.confusion_matrix(scored(spark, HAND)).collect()}
    assert cells == {(0, 0): (1, 25.0), (0, 1): (1, 25.0), (1, 0): (0, 0.0), (1, 1): (2, 50.0)}


def test_undefined_ratios(spark):
    row = M.score_metrics(scored(spark, HAND, threshold=2)).first()
    assert (row.precision, row.recall, row.f1) == (0, 0, 0)
    one_class = M.score_metrics(scored(spark, [(1, 0.3), (1, 0.6)])).first()
    assert one_class.roc_auc is None and one_class.recall == 0.5
    none = M.score_metrics(scored(spark, HAND).limit(0)).first()
    assert none.accuracy == 0 and none.roc_auc is None


@pytest.fixture(params=[True, False], ids=["one range", "many ranges"])
def ranges(spark, request):
    """Small tables are dealt out in one range, unless Spark is kept from joining small ones."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, str(request.param).lower())
    yield
    spark.conf.set(name, before)


def test_ranking_metrics_match_brute_force(spark, rows, ranges):
    df = scored(spark, rows)
    assert M.roc_auc(df).first().roc_auc == pytest.approx(brute_auc(rows), abs=1e-12)
    got = sorted(map(tuple, M.roc_curve(df).collect()), key=lambda r: -r[2])
    want = brute_curve(rows)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b)
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="p_phish", numBins=0).evaluate(df)
    assert spark_auc == pytest.approx(brute_auc(rows), abs=1e-9)


def test_rows_without_a_score_are_not_ranked(spark, rows, ranges):
    odd = [(1, None), (0, None), (1, float("nan")), (0, float("nan"))]
    ends = [(1, float("inf")), (0, float("-inf")), (0, float("inf"))]
    df = scored(spark, rows + ends + odd).withColumn("prediction", F.coalesce("prediction", F.lit(0)))
    assert M.roc_auc(df).first().roc_auc == pytest.approx(brute_auc(rows + ends), abs=1e-12)
    got = sorted(map(tuple, M.roc_curve(df).collect()), key=lambda r: (-r[2], r[0] + r[1]))
    assert len(got) == len(brute_curve(rows + ends))
    assert got[-1][:2] == (1, 1)
    both = M.score_metrics(df).first()
    assert both.roc_auc == M.roc_auc(df).first().roc_auc
    assert both.accuracy == M.binary_metrics(df).first().accuracy


def test_metrics_from_counts_equal_those_of_rows(spark, rows):
    df = scored(spark, rows).withColumn("model", F.when(F.col("p_phish") > 0.1, "a").otherwise(None))
    counted = M.counted_scores(df, ["model"])
    key = lambda r: str(r.model)
    assert sorted(M.outcomes_of(counted, ["model"]).collect(), key=key) == sorted(
        M.outcome_counts(df, ["model"]).collect(), key=key
    )
    got = {r.model: r.roc_auc for r in M.metrics_of(counted, ["model"]).collect()}
    assert got == pytest.approx({r.model: r.roc_auc for r in M.roc_auc(df, ["model"]).collect()})


def test_groups_do_not_mix(spark, rows, ranges):
    df = scored(spark, rows)
    two = df.withColumn("model", F.lit("a")).unionByName(
        df.withColumn("model", F.lit("b")).withColumn("p_phish", 1 - F.col("p_phish"))
    )
    got = {r.model: r.roc_auc for r in M.score_metrics(two, ["model"]).collect()}
    assert got["a"] == pytest.approx(brute_auc(rows))
    assert got["b"] == pytest.approx(1 - brute_auc(rows))


def test_sweep_matches_single_thresholds(spark, rows):
    df = scored(spark, rows)
    sweep = {r.threshold: r for r in M.threshold_sweep(df, [0.5, 0.1, 0.9, 2.0]).collect()}
    for t, row in sweep.items():
        single = M.with_rates(M.outcome_counts(scored(spark, rows, t))).first().asDict()
        assert row.asDict() == pytest.approx({"threshold": t, **single})


def test_plans_have_no_cross_join(spark, rows, ranges):
    df = scored(spark, rows)
    for out in (M.score_metrics(df), M.roc_curve(df), M.threshold_sweep(df), M.confusion_matrix(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
