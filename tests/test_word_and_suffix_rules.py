"""Suffix rules of any depth, word lists of any length, rule search and threshold choice."""

import random
import time

import pytest
from pyspark.sql import functions as F

from linksieve.functions import suffixes as P
from linksieve.functions import words as W
from linksieve.functions.lexicons import DEFAULT_LEXICONS, Lexicons
from linksieve.functions.url_parts import with_url_parts
from linksieve.operators import diagnostics as D
from linksieve.operators.features import with_features
from linksieve.operators.metrics import threshold_choice
from linksieve.operators.splits import domain_disjoint_split, raw_host_domain
from linksieve.sources.urls import urls_frame

RULES = ("com", "co.uk", "*.ck", "!www.ck", "a.b.co.uk", "*.compute.cloud.com", "!my.compute.cloud.com", "w.x.y.z")
HOSTS = {
    "example.com": "example.com",
    "www.example.com": "example.com",
    "com": "com",
    "www.bbc.co.uk": "bbc.co.uk",
    "co.uk": "co.uk",
    "x.a.b.co.uk": "x.a.b.co.uk",
    "y.x.a.b.co.uk": "x.a.b.co.uk",
    "a.b.co.uk": "a.b.co.uk",
    "b.co.uk": "b.co.uk",
    "ck": "ck",
    "foo.ck": "foo.ck",
    "bar.foo.ck": "bar.foo.ck",
    "www.ck": "www.ck",
    "me.www.ck": "www.ck",
    "n.eu.compute.cloud.com": "n.eu.compute.cloud.com",
    "m.n.eu.compute.cloud.com": "n.eu.compute.cloud.com",
    "compute.cloud.com": "cloud.com",
    "m.my.compute.cloud.com": "my.compute.cloud.com",
    "q.w.x.y.z": "q.w.x.y.z",
    "p.q.w.x.y.z": "q.w.x.y.z",
    "x.y.z": "y.z",
    "un.listed": "un.listed",
    "a.un.listed": "un.listed",
    "1.2.3.4": "",
    "": "",
}


def plain_domain(host, rules):
    labels = host.split(".")
    depth, excepted = 1, False
    for rule in rules:
        want = rule.lstrip("!").split(".")
        tail = labels[-len(want) :]
        if len(tail) == len(want) and all(w in ("*", t) for w, t in zip(want, tail)):
            if rule.startswith("!"):
                depth, excepted = len(want) - 1, True
            elif not excepted:
                depth = max(depth, len(want))
    return ".".join(labels[-(depth + 1) :])


def domains(spark, hosts, rules):
    parts = with_url_parts(urls_frame(spark, hosts), suffixes=rules)
    return {r.url: r.registered for r in parts.select("url", "registered").collect()}


def test_rules_of_one_to_four_labels(spark):
    assert domains(spark, HOSTS, RULES) == HOSTS
    assert {h: plain_domain(h, RULES) for h in HOSTS if HOSTS[h]} == {h: d for h, d in HOSTS.items() if d}


@pytest.mark.parametrize("seed", range(4))
def test_random_rules_against_plain_matching(spark, seed):
    draw = random.Random(seed)

    def name(depth):
        return ".".join(draw.choice("abcd") for _ in range(depth))

    rules = {name(draw.randint(1, 4)) for _ in range(12)} | {"*." + name(draw.randint(1, 3)) for _ in range(4)}
    hosts = {name(draw.randint(1, 6)) for _ in range(300)}
    assert domains(spark, hosts, tuple(rules)) == {h: plain_domain(h, rules) for h in hosts}


def test_a_table_of_rules(spark):
    lines = ["// a comment", "", "  CO.UK  ", "*.ck // any", "!www.ck", "co.uk", None]
    table = spark.createDataFrame([(line,) for line in lines], "rule string")
    assert P.suffix_rules(table) == ("!www.ck", "*.ck", "co.uk")
    with pytest.raises(ValueError, match="more than 2"):
        P.suffix_rules(table, most=2)
    for bad in ("a.*.b", "*", "a..b", "!ck", "a b", ""):
        with pytest.raises(ValueError, match="rule|exception"):
            P.registered_domain("host", [bad])


def test_ten_thousand_rules(spark):
    rules = tuple(f"s{i}.t{i % 50}" + (f".u{i % 7}" if i % 3 == 0 else "") for i in range(10_000))
    hosts = [f"www.shop.{r}" for r in rules[::100]]
    assert domains(spark, hosts, rules) == {h: h[4:] for h in hosts}


def test_domain_operators_take_the_rules(spark):
    rows = [(f"a{i}.shop{i % 5}.x.y", i % 2) for i in range(100)] + [("www.ck/", 1), ("q.www.ck", 0)]
    df = spark.createDataFrame(rows, "url string, label int")
    rules = ("x.y", "*.ck", "!www.ck")
    assert {r.domain for r in D.domain_rates(D.with_domain(df, suffixes=rules)).collect()} == {
        *(f"shop{i}.x.y" for i in range(5)), "www.ck"
    }
    assert {r.domain for r in D.domain_rates(D.with_domain(df)).collect()} == {"x.y", "www.ck"}
    by_rules = domain_disjoint_split(df, held_out_fraction=0.5, suffixes=rules)
    assert by_rules.select("domain").distinct().count() == 6
    got = df.select(raw_host_domain(suffixes=rules).alias("d")).distinct().count()
    assert got == 6 and domain_disjoint_split(df, held_out_fraction=0.5).select("domain").distinct().count() == 2


# -- word lists ------------------------------------------------------------------


def found_in(spark, urls, keywords, brands, few, monkeypatch):
    monkeypatch.setattr(W, "FEW_WORDS", few)
    names = ["num_suspicious_keywords", "brand_domain_mismatch"]
    lexicons = Lexicons(keywords=keywords, brands=brands)
    out = with_features(urls_frame(spark, urls), features=names, lexicons=lexicons)
    return out, [(r.url, *(r[n] for n in names)) for r in out.collect()]


@pytest.mark.parametrize("seed", range(3))
def test_the_automaton_counts_what_single_searches_count(spark, seed, monkeypatch):
    draw = random.Random(seed)

    def word(most):
        return "".join(draw.choices("abcé日", k=draw.randint(1, most)))

    keywords = tuple(word(4) for _ in range(60)) + ("", "aa", "aa")
    brands = tuple(word(5) for _ in range(20))
    urls = ["".join(draw.choices("abcAé日./", k=draw.randint(0, 30))) for _ in range(200)] + [None, ""]
    plan, many = found_in(spark, urls, keywords, brands, 0, monkeypatch)
    assert "ArrowEvalPython" in plan._jdf.queryExecution().executedPlan().toString()
    plan, few = found_in(spark, urls, keywords, brands, 10**6, monkeypatch)
    assert "ArrowEvalPython" not in plan._jdf.queryExecution().executedPlan().toString()
    assert many == few


def test_default_lists_stay_built_in(spark):
    out = with_features(urls_frame(spark, ["a.com"]), features=["num_suspicious_keywords", "brand_domain_mismatch"])
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert not W.many(DEFAULT_LEXICONS.keywords) and not W.many(DEFAULT_LEXICONS.brands)


def test_word_lists_from_tables_are_bounded(spark, monkeypatch):
    table = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("",)], "w string")
    assert W.word_list(table, "w") == ("a", "b")
    with pytest.raises(ValueError, match="characters"):
        W.word_list(table, "w", most=1)
    monkeypatch.setattr(W, "MOST_CHARACTERS", 3)
    with pytest.raises(ValueError, match="characters"):
        W.words_in("url", ["abcd"], [])


def test_a_long_list_is_no_part_of_the_plan(spark):
    """A listed brand as the first label is no mismatch; no word of a long list becomes a literal."""
    brands = tuple(f"brand{i}" for i in range(2000))
    urls = ["brand7.com", "brand77.evil.com/brand7", "evil.com/brand1999", "evil.com", "", None]
    out = with_features(urls_frame(spark, urls), features=["brand_domain_mismatch"], lexicons=Lexicons(brands=brands))
    assert [r.brand_domain_mismatch for r in out.collect()] == [0, 1, 1, 0, 0, 0]
    assert "brand1999" not in out._jdf.queryExecution().analyzed().toString()


def test_time_hardly_depends_on_the_length_of_the_list(spark):
    urls = spark.range(20_000, numPartitions=4).select(
        F.concat(F.lit("www.site"), F.md5(F.col("id").cast("string")), F.lit(".com/path/"), "id").alias("url")
    )

    def seconds(count):
        words = tuple(f"w{i:05d}x" for i in range(count))
        out = with_features(urls, features=["num_suspicious_keywords"], lexicons=Lexicons(keywords=words))
        out.write.format("noop").mode("overwrite").save()
        times = []
        for _ in range(2):
            started = time.perf_counter()
            out.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        return min(times)

    assert seconds(20_000) < 5 * seconds(200) + 1


# -- rule search -----------------------------------------------------------------


def plain_rules(rows, names):
    out = {}
    for n in names:
        known = [(r[n], r["label"]) for r in rows if r[n] is not None and r["label"] is not None]
        best = None
        for t in sorted({v for v, _ in known}):
            for turn, fires in ((0, lambda v: v >= t), (1, lambda v: v < t)):
                good = sum(fires(v) == (y == 1) for v, y in known)
                if best is None or (-good, turn, t) < best:
                    best = (-good, turn, t)
        if best:
            out[n] = (">=<"[best[1] * 2 :][: 2 - best[1]], float(best[2]), 100 * -best[0] / len(known))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_best_rules_against_all_thresholds(spark, seed):
    draw = random.Random(seed)
    rows = [
        {"a": draw.randint(0, 5), "b": draw.choice([None, 0.5, -1.5, 2.25]), "c": 7, "d": draw.random(),
         "label": draw.choice([0, 1, 1, None])}
        for _ in range(200)
    ]
    df = spark.createDataFrame(rows, "a int, b double, c int, d double, label int").repartition(5)
    got = {r.feature: (r.direction, r.threshold, r.accuracy_pct) for r in D.rule_search(df, list("abcd")).collect()}
    want = plain_rules(rows, "abcd")
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
    assert all(got[k][2] == pytest.approx(want[k][2]) for k in want)


def test_both_collection_rules_are_found_on_raw_rows(spark):
    rows = [(f"http://a{i}.com/x/", 1) for i in range(50)] + [(f"b{i}.org/y", 0) for i in range(60)]
    raw = spark.createDataFrame(rows, "url string, label int")
    ruled = raw.withColumns({n: F.expr(sql).cast("int") for n, sql in D.COLLECTION_RULES.items()})
    found = {r.feature: r for r in D.rule_search(ruled, list(D.COLLECTION_RULES)).collect()}
    assert set(found) == set(D.COLLECTION_RULES)
    for r in found.values():
        assert (r.direction, r.threshold, r.phishing_pct, r.legitimate_pct, r.accuracy_pct) == (">=", 1, 100, 0, 100)
        assert r.baseline_pct == pytest.approx(6000 / 110)


def test_rule_search_without_rows(spark):
    empty = spark.createDataFrame([], "x double, label int")
    assert D.rule_search(empty, ["x"]).count() == 0
    one_class = spark.createDataFrame([(1.0, 1), (float("nan"), 1)], "x double, label int")
    row = D.rule_search(one_class, ["x"]).first()
    assert (row.direction, row.accuracy_pct, row.legitimate_pct) == (">=", 100, None)


# -- threshold choice ------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_thresholds_against_all_scores(spark, seed):
    draw = random.Random(seed)
    rows = [(draw.choice("mn"), draw.randint(0, 1), draw.choice([None, *(i / 16 for i in range(17))])) for _ in range(300)]
    df = spark.createDataFrame(rows, "model string, label int, p_phish double")
    wanted = (0.0, 0.5, 0.52, 0.6, 1.0)
    got = {(r.model, r.wanted): r for r in threshold_choice(df, wanted, ["model"]).collect()}
    assert len(got) == 10
    for (model, w), r in got.items():
        mine = [(y, p) for m, y, p in rows if m == model and p is not None]
        best = None
        for t in {p for _, p in mine}:
            tp, fp = (sum(y == k and p >= t for y, p in mine) for k in (1, 0))
            if tp >= w * (tp + fp) and (best is None or (tp, t) > best[:2]):
                best = (tp, t, fp)
        if best is None:
            assert r.threshold is None and r.recall is None
        else:
            assert (r.tp, r.threshold, r.fp) == best
            assert r.recall == pytest.approx(best[0] / sum(y for y, _ in mine))
