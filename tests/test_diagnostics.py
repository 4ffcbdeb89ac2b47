from collections import Counter, defaultdict

import pytest
from plain_features import is_address, registrable, split_url
from pyspark.sql import functions as F

from linksieve.operators import diagnostics as D
from linksieve.operators.corpus import clean_corpus
from linksieve.operators.features import FEATURE_NAMES, with_features
from linksieve.operators.splits import make_splits
from linksieve.plans.sample_corpus import raw_urls
from linksieve.session import checkpointed


@pytest.fixture(scope="module")
def corpus(spark):
    return checkpointed(clean_corpus(raw_urls(spark, "/root/testdata/sf0.01")))


@pytest.fixture(scope="module")
def rows(corpus):
    out = []
    for r in corpus.collect():
        host = split_url(r.url)["host"]
        out.append((r.url, r.label, "" if is_address(host) else registrable(host)))
    return out


def test_rule_audit(spark):
    raw = [("http://a.com", 1), ("b.com/", 1), ("c.com", 0), ("d.com/", 0), ("e.com", 0), (None, 1)]
    df = spark.createDataFrame(raw, "url string, label int")
    got = {r.rule: r for r in D.rule_audit(df).collect()}
    assert got["has_scheme"][1:] == (50.0, 0.0, 80.0, 60.0)
    assert got["ends_with_slash"].phishing_pct == 50
    assert got["ends_with_slash"].legitimate_pct == pytest.approx(100 / 3)
    both = df.withColumn("form", F.lit("raw")).unionByName(clean_corpus(df).withColumn("form", F.lit("clean")))
    after = {(r.form, r.rule): r for r in D.rule_audit(both, by=["form"]).collect()}
    assert after["clean", "has_scheme"].phishing_pct == 0
    assert after["clean", "has_scheme"].accuracy_pct == after["clean", "has_scheme"].baseline_pct


def test_class_balance(spark):
    df = spark.createDataFrame([("a", 0)] * 3 + [("a", 1)] + [("b", 1)], "split string, label int")
    got = {(r.split, r.label): (r.n, r.share, r.majority_share) for r in D.class_balance(df, ["split"]).collect()}
    assert got == {("a", 0): (3, 0.75, 0.75), ("a", 1): (1, 0.25, 0.75), ("b", 1): (1, 1.0, 1.0)}


def test_domain_reports(corpus, rows):
    per = defaultdict(Counter)
    for _, label, domain in rows:
        per[domain][label] += 1
    df = D.with_domain(corpus)
    got = {r.domain: (r.n, r.phishing) for r in D.domain_rates(df).collect()}
    assert got == {d: (sum(c.values()), c[1]) for d, c in per.items()}
    ceiling = D.domain_ceiling(df).first()
    assert ceiling.domains == len(per)
    assert ceiling.ceiling == pytest.approx(sum(max(c.values()) for c in per.values()) / len(rows))
    top = D.most_skewed_domains(df, 5).collect()
    assert len(top) == 5 and all(r.phishing_share in (0, 1) for r in top)
    assert top[0].n == max(sum(c.values()) for c in per.values() if len(c) == 1)


def test_domain_overlap(corpus, rows):
    split = D.with_domain(make_splits(corpus))
    of = {r.url: r.split for r in split.collect()}
    train = {d for u, _, d in rows if of[u] == "train"}
    test = [d for u, _, d in rows if of[u] == "test"]
    got = D.domain_overlap(split).first()
    assert got.tested_rows == len(test)
    assert got.shared_rows == sum(d in train for d in test)


def test_feature_reports(spark, corpus):
    feats = checkpointed(with_features(corpus))
    rates = {r.feature: r for r in D.fire_rates(feats).collect()}
    assert set(rates) == set(FEATURE_NAMES)
    assert rates["uses_https"].is_constant and rates["uses_https"].fire_share == 0
    assert not rates["url_length"].is_constant
    check = D.contract_check(feats).collect()
    assert len(check) == 47 and all(r.nulls == r.nans == r.infinities == 0 for r in check)
    bad = feats.withColumn("num_dots", F.when(F.col("num_dots") > 1, float("nan")).cast("float"))
    found = {r.feature: r for r in D.contract_check(bad).collect()}["num_dots"]
    assert found.nans > 0 and found.nulls > 0
    with pytest.raises(ValueError):
        D.contract_check(feats.drop("num_dots"))
    with pytest.raises(ValueError):
        D.contract_check(feats.withColumn("num_dots", F.lit(1.0)))


def test_family_shares_and_gains(spark):
    imp = spark.createDataFrame(
        [("m", "num_dots", 0.5), ("m", "has_port", 0.2), ("m", "tld_rank", 0.2), ("m", "num_hyphens", 0.1)],
        "model string, feature string, importance double",
    )
    got = {r.family: (round(r.share, 6), round(r.top_share, 6)) for r in D.family_shares(imp).collect()}
    assert got == {"lexical": (0.6, 0.5), "structural": (0.2, 0.2), "suspicion": (0.2, 0.2)}
    curve = spark.createDataFrame([("m", 10, 0.5), ("m", 20, 0.75)], "model string, train_rows int, f1 double")
    assert [r.gain for r in D.marginal_gains(curve).orderBy("train_rows").collect()] == [None, 0.25]
