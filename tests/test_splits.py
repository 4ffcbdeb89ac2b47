import math

import pytest
from pyspark.sql import functions as F

from linksieve.operators import ordering
from linksieve.operators.corpus import clean_corpus
from linksieve.operators.ordering import find_cuts
from linksieve.operators.splits import (
    domain_disjoint_split, make_splits, proportional_quotas, stratified_sample, with_curve_step,
    with_folds,
)
from linksieve.plans.sample_corpus import raw_urls
from linksieve.session import checkpointed


@pytest.fixture(scope="module")
def corpus(spark):
    return checkpointed(clean_corpus(raw_urls(spark, "/root/testdata/sf0.01")))


@pytest.fixture(scope="module")
def wide(spark):
    return checkpointed(
        spark.range(20_000).select(
            F.concat(F.lit("u"), "id").alias("url"), (F.col("id") % 7 < 3).cast("byte").alias("label")
        )
    )


def counts(df, *by):
    return {tuple(r)[:-1]: r["count"] for r in df.groupBy(*by).count().collect()}


def test_quotas():
    assert proportional_quotas({0: 55, 1: 45}, 10) == {0: 6, 1: 4}
    assert proportional_quotas({0: 1, 1: 1}, 1) == {0: 1, 1: 0}
    assert proportional_quotas({}, 0) == {}
    assert proportional_quotas({0: 0, 1: 0}, 0) == {0: 0, 1: 0}


@pytest.mark.parametrize("step, per_prefix", [(4, 500_000), (1, 100), (2, 1)])
def test_cuts_equal_a_full_sort(spark, wide, monkeypatch, step, per_prefix):
    monkeypatch.setattr(ordering, "PREFIX_STEP", step)
    monkeypatch.setattr(ordering, "ROWS_PER_PREFIX", per_prefix)
    asked = {0: [1, 17, 5000, 11428], 1: [0, 8571, 8572, 8572]}
    cuts = find_cuts(wide, "url", "s", lambda sizes: asked, "label")
    rows = wide.select("url", "label", cuts.segment().alias("seg"), F.md5(F.concat(F.lit("s|"), "url")).alias("h")).collect()
    for label, ranks in asked.items():
        ordered = sorted((r for r in rows if r.label == label), key=lambda r: (r.h, r.url))
        for i, r in enumerate(ordered, start=1):
            assert r.seg == sum(i > k for k in ranks)


def test_narrowing_rounds_give_the_same_cuts(wide, monkeypatch):
    asked = {0: [3, 5000, 11_000], 1: [1, 8000]}
    found = []
    for step, per_prefix in ((4, 500_000), (1, 50), (1, 1)):
        monkeypatch.setattr(ordering, "PREFIX_STEP", step)
        monkeypatch.setattr(ordering, "ROWS_PER_PREFIX", per_prefix)
        found.append(find_cuts(wide, "url", "s", lambda sizes: asked, "label").per_label)
    assert found[0] == found[1] == found[2]


def test_repeated_keys_and_missing_labels(spark):
    twice = spark.range(400).selectExpr("concat('u', id % 50) AS url", "int(id % 2) AS label")
    with pytest.raises(ValueError, match="repeats"):
        make_splits(twice, test_per_class=30)
    some = spark.range(300).selectExpr("concat('u', id) AS url", "if(id % 3 = 0, null, int(id % 2)) AS label")
    split = counts(make_splits(some, test_per_class=20), "split", "label")
    assert split["test", 0] == split["test", 1] == 20
    assert split[None, None] == 100


def test_many_labels(spark):
    df = spark.range(4000).selectExpr("concat('u', id) AS url", "int(id % 400) AS label")
    sample = counts(stratified_sample(checkpointed(df), 800), "label")
    assert sample == {(label,): 2 for label in range(400)}


def test_splits_are_complete_balanced_and_repeatable(corpus, wide):
    for df, per_class in ((corpus, None), (wide, 3000), (wide, 50_000)):
        kwargs = {} if per_class is None else {"test_per_class": per_class}
        split = make_splits(df, **kwargs)
        n = {k: v for (k,), v in counts(df, "label").items()}
        got = counts(split, "split", "label")
        test = min(per_class or 50_000, n[0] // 2, n[1] // 2)
        assert got["test", 0] == got["test", 1] == test
        rest = sum(n.values()) - 2 * test
        assert got["val", 0] + got["val", 1] == math.ceil(0.1 * rest)
        assert sum(got.values()) == sum(n.values())
        assert abs(got["val", 1] / math.ceil(0.1 * rest) - (n[1] - test) / rest) < 0.01
    again = make_splits(wide.repartition(3, F.rand(1)), test_per_class=3000)
    first = make_splits(wide, test_per_class=3000)
    assert first.exceptAll(again).isEmpty()
    other = make_splits(wide, seed=7, test_per_class=3000)
    assert not first.exceptAll(other).isEmpty()


def test_split_is_a_map(wide):
    plan = make_splits(wide)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan


def test_sample_and_curve(wide):
    sample = counts(stratified_sample(wide, 1001), "label")
    total = counts(wide, "label")
    quotas = proportional_quotas({k[0]: v for k, v in total.items()}, 1001)
    assert {k[0]: v for k, v in sample.items()} == quotas
    assert stratified_sample(wide, 10**6).count() == 20_000
    curve = with_curve_step(wide)
    for i, fraction in enumerate((0.1, 0.25, 0.5, 1.0)):
        assert curve.filter(F.col("step") <= i).count() == int(fraction * 20_000)


def test_folds(wide):
    got = counts(with_folds(wide), "label", "fold")
    assert set(got) == {(lab, f) for lab in (0, 1) for f in (0, 1, 2)}
    for label in (0, 1):
        sizes = [got[label, f] for f in (0, 1, 2)]
        assert max(sizes) - min(sizes) <= 1


def test_domain_disjoint(spark, corpus):
    split = checkpointed(domain_disjoint_split(corpus))
    assert split.count() == corpus.count()
    domains = split.select("domain").distinct().count()
    held = split.filter("split <> 'train'").select("domain").distinct()
    assert held.count() == int(domains * 0.15)
    assert split.filter("split = 'train'").join(held, "domain").count() == 0
    got = counts(split.filter("split = 'test'"), "label")
    assert got[(0,)] == got[(1,)] > 0


def test_domain_key_uses_raw_host(spark):
    urls = ["1.2.3.4/x", "a.com:80/y", "u@www.bbc.co.uk", "www.bbc.co.uk/a.b", "localhost", "a.com?q=x.y/z"]
    df = spark.createDataFrame([(u, 0) for u in urls], "url string, label int")
    got = {r.url: r.domain for r in domain_disjoint_split(df).collect()}
    assert list(got.values()) == ["3.4", "a.com:80", "bbc.co.uk", "bbc.co.uk", "localhost", "com?q=x.y"]


def test_one_domain_with_a_third_of_all_rows(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("x"), "id", F.lit(".duckdns.org")))
        .otherwise(F.concat(F.lit("h"), "id", F.lit(".com"))).alias("url"),
        (F.col("id") % 2).cast("byte").alias("label"),
    )
    split = domain_disjoint_split(df, test_per_class=10**9)
    got = counts(split, "split")
    assert sum(got.values()) == 3000
    hot = split.filter("domain = 'duckdns.org'").select("split").distinct().count()
    assert hot <= 2


def test_empty_and_single_class(spark):
    none = spark.createDataFrame([], "url string, label byte")
    assert make_splits(none).count() == 0
    one = spark.createDataFrame([("a", 1), ("b", 1)], "url string, label int")
    assert "test" not in {r.split for r in make_splits(one).collect()}
    assert with_folds(one).count() == 2
