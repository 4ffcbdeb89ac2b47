import pytest

from linksieve.functions.canonical import canonicalize
from linksieve.operators.corpus import (
    canonical_urls, clean_corpus, cleaning_audit, distinct_pairs, drop_empty,
)
from linksieve.plans.sample_corpus import raw_urls, table
from linksieve.session import checkpointed
from linksieve.sources.urls import (
    load_corpus, load_raw, read_corpus_csv, urls_frame, write_corpus_csv,
)

CANONICAL = {
    "https://Example.COM/Path/": "example.com/Path",
    "http://example.com": "example.com",
    "example.com/": "example.com",
    "HTTP://A.B.C/x?q=1": "a.b.c/x?q=1",
    "WWW.Example.com/CamelCase": "www.example.com/CamelCase",
    "A.com?Q=X": "a.com?q=x",
    "a.com/?q=1//": "a.com/?q=1",
    "http://http://x": "http://x",
    "x /": "x ",
    "　 \t x.com/A \x1f\n": "x.com/A",
    " ": "", "http://": "", "////": "", "": "", None: None,
    "a//b//": "a//b",
    "javascript:alert(1)": "javascript:alert(1)",
    "ПРИМЕР.РФ/Путь": "пример.рф/Путь",
}


def test_canonical_pairs(spark):
    df = urls_frame(spark, CANONICAL)
    rows = df.select("url", canonicalize(df.url).alias("c")).collect()
    assert {r.url: r.c for r in rows} == CANONICAL


def test_canonical_is_stable_on_ordinary_urls(spark, sf_dir):
    once = drop_empty(canonical_urls(raw_urls(spark, sf_dir)))
    assert once.filter(canonicalize(once.url) != once.url).count() == 0


@pytest.mark.parametrize(
    "sf, raw, missing, pairs, final, phishing",
    [("0.001", 1500, 20, 152, 126, 59), ("0.01", 15000, 273, 1311, 1049, 541),
     ("0.1", 150000, 2936, 12548, 10274, 5284)],
)
def test_audit_counts(spark, sf, raw, missing, pairs, final, phishing):
    df = raw_urls(spark, f"/root/testdata/sf{sf}")
    audit = cleaning_audit(df).first().asDict()
    assert audit["raw_rows"] == raw
    assert audit["missing_rows"] == missing
    assert audit["duplicate_rows"] == raw - missing - pairs
    assert audit["conflict_rows"] == pairs - final
    assert (audit["final_rows"], audit["phishing_rows"]) == (final, phishing)
    assert audit["legitimate_pct"] + audit["phishing_pct"] == pytest.approx(100)
    clean = clean_corpus(df)
    assert clean.count() == clean.select("url").distinct().count() == final
    assert distinct_pairs(drop_empty(canonical_urls(df))).count() == pairs


def test_conflicts_empty_and_missing(spark):
    raw = spark.createDataFrame(
        [("a.com", 0), ("http://a.com/", 0), ("b.com", 0), ("B.com/", 1), ("b.com", 1), ("c.com", 1),
         (None, 1), (" / ", 0), ("d.com", None)],
        "url string, label int",
    )
    assert sorted(tuple(r) for r in clean_corpus(raw).collect()) == [("a.com", 0), ("c.com", 1)]
    audit = cleaning_audit(raw).first()
    # " / " is trimmed, then all its slashes go
    assert tuple(audit)[:7] == (9, 3, 2, 2, 2, 1, 1)
    empty = cleaning_audit(raw.limit(0)).first()
    assert tuple(empty) == (0, 0, 0, 0, 0, 0, 0, 0.0, 0.0)


def test_cleaning_is_one_shuffle_without_python(spark, sf_dir):
    labelled = table(spark, sf_dir, "pages").selectExpr("url", "page_id % 2 AS label")
    plan = clean_corpus(labelled)._jdf.queryExecution().executedPlan().toString()
    # Canonicalised in one projection, and not again in a filter below it.
    assert plan.count("Filter ") == 1 and plan.index("Filter ") < plan.index("Exchange")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and plan.count("partial_min") >= 1


def test_sources_round_trip(spark, tmp_path):
    rows = [("NA", 0), ("null", 1), ('a"b,c\nd', 0), ("nan", 1), ("\\", 0)]
    one = spark.createDataFrame(rows[:2], "url string, label int")
    two = spark.createDataFrame([(7, lab, u) for u, lab in rows[2:]], "client_id int, label long, url string")
    one.write.parquet(str(tmp_path / "1"))
    two.write.parquet(str(tmp_path / "2"))
    raw = load_raw(spark, str(tmp_path / "1"), str(tmp_path / "2"))
    assert raw.dtypes == [("url", "string"), ("label", "tinyint")]
    assert sorted(map(tuple, raw.collect())) == sorted(rows)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "client_id" not in plan.split("ReadSchema", 2)[2]

    calls = []
    build = lambda: calls.append(1) or raw
    for _ in range(2):
        stored = load_corpus(spark, str(tmp_path / "corpus"), build)
        assert sorted(map(tuple, stored.collect())) == sorted(rows)
    assert calls == [1]

    odd = [" x.com/a", "y.com ", "NA", "a\nb", "a\r\nb\\nc\\\\n", "\\", 'q"q,r', "\u0000", "'", "\t"]
    raw = raw.unionByName(spark.createDataFrame([(u, 1) for u in odd], raw.schema))
    rows = rows + [(u, 1) for u in odd]
    write_corpus_csv(raw, str(tmp_path / "csv"))
    assert sorted(map(tuple, read_corpus_csv(spark, str(tmp_path / "csv")).collect())) == sorted(rows)


def test_one_url_with_a_third_of_all_rows(spark):
    raw = spark.range(60_000).selectExpr(
        "CASE id % 3 WHEN 0 THEN concat('http://hot.com', repeat('/', int(id % 5))) "
        "WHEN 1 THEN NULL ELSE concat('h', id, '.com') END AS url",
        "int(id % 2) AS label",
    )
    hot = raw.withColumn("label", raw.label * (raw.url.isNull() | ~raw.url.contains("hot")).cast("int"))
    assert clean_corpus(hot).count() == 20_001
    audit = cleaning_audit(hot).first()
    assert audit[:5] == (60_000, 20_000, 19_999, 0, 20_001)
    conflicting = cleaning_audit(raw).first()
    assert conflicting[:5] == (60_000, 20_000, 19_998, 2, 20_000)


def test_the_registered_clean_corpus_is_one_shuffle(spark, sf_dir):
    plan = clean_corpus(checkpointed(raw_urls(spark, sf_dir)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
