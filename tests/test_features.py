import hashlib
import random

import numpy as np
import pytest
from plain_features import plain_features
from pyspark.sql import types as T

from linksieve.functions import measures
from linksieve.functions.lexicons import DEFAULT_LEXICONS, MULTI_LABEL_SUFFIXES, Lexicons
from linksieve.functions.measures import MEASURES
from linksieve.operators.features import FEATURE_FAMILIES, FEATURE_NAMES, with_features
from linksieve.plans.sample_corpus import raw_urls, table

# Delimiters, labels and ports; every ordered pair and many longer draws of them are tried.
PIECES = (
    "", " ", "/", ":", "//", "://", "?", "#", "@", "%", ".", "..", "=", "&", "[", "]", "[fe80::9]", ":77", ":abc",
    "ftp://", "HTTPS://", "me@", "me:pw@", "shop.tld", "SHOP.TLD", "quay.org.uk", "kiosk.com.mx", "com.mx", "10.20.30.40",
    "300.1.1.1", "0xc0ffee", "0xq", "ow.ly", "v.ow.ly", "mysite.web.app", "web.app", "тест.рф", "xn--80ak6aa92e", "~a//b",
    ".PDF", ".Exe", "?k=v&k=w", "#frag", "cafe0123", "gcafe0123", "\n", "\n\n\n", "😀", "İ", "ẞ", "²³", "\x00", "\u3000",
)


def hostile():
    """One string per trap, then pieces put together."""
    traps = [
        None, "\t \t", "word word word", "q" * 6000, "http://" + "sub." * 150 + "quay.org", "data:text/plain,hi",
        "http://ebay.mx.quay.org", "ebay.com.mx/x", "quay.org/?ebay", "quay.org/ow.ly", "quay.org/%41%42%43", "9.9.9.9/ebay",
        "login-account-verify-update.zip", "aab\n\n\n\nc", "quay.org/_cafe0123", "quay.org/CAFE0123!", "rhythm.crypt.top",
        "777", "8.8.8.8\n", "x y\u0085z.org", "\u00a0quay.org\u2009", "http://ftp://quay.org",
    ]
    pairs = [a + b for a in PIECES for b in PIECES]
    draw = random.Random(11)
    longer = ["".join(draw.choices(PIECES, k=draw.randint(3, 9))) for _ in range(1500)]
    return traps + pairs + longer


HOSTILE = hostile()

PINNED = {
    "shorteners": "b8f4e56b3f17",
    "keywords": "d0187af5f638",
    "brands": "d2c5682cddda",
    "suspicious_tlds": "3eb7bf380034",
    "free_hosting": "6420fce59537",
    "suffixes": "46e14a84d124",
    "ranked_tlds": "f50a5e525720",
    "executable_extensions": "834fe125ef55",
}


def feature_rows(spark, urls):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("url", T.StringType())])
    df = spark.createDataFrame(list(enumerate(urls)), schema)
    return [r.asDict() for r in with_features(df).orderBy("n").collect()]


def assert_same(got, url):
    want = plain_features(url)
    assert list(want) == list(FEATURE_NAMES)
    for name, value in want.items():
        assert got[name] is not None, (name, url)
        assert got[name] == pytest.approx(float(np.float32(value)), rel=1e-6, abs=1e-6), (name, url)


def test_families_partition_the_features():
    assert [len(v) for v in FEATURE_FAMILIES.values()] == [20, 13, 14]
    assert len(set(FEATURE_NAMES)) == 47


def test_lexicon_sizes():
    assert len(MULTI_LABEL_SUFFIXES) == len(set(MULTI_LABEL_SUFFIXES)) == 395
    lex = DEFAULT_LEXICONS
    assert [len(x) for x in (lex.shorteners, lex.keywords, lex.brands, lex.suspicious_tlds,
                             lex.free_hosting, lex.ranked_tlds, lex.executable_extensions)] == [
        27, 32, 34, 37, 67, 55, 10]
    assert Lexicons(brands=("acme",)).fingerprint() != lex.fingerprint()


def test_hostile_strings(spark):
    for row, url in zip(feature_rows(spark, HOSTILE), HOSTILE):
        assert_same(row, url)


def test_corpus_against_plain_python(spark, sf_dir):
    urls = [r.url for r in raw_urls(spark, sf_dir).select("url").distinct().collect()]
    urls += [r.url for r in table(spark, sf_dir, "pages").select("url").collect()]
    for row, url in zip(feature_rows(spark, urls), urls):
        assert_same(row, url)


# Letters added to Unicode after the version of the running JDK would count as
# letters in Python only, so the alphabet stays within long-standing blocks.
ALPHABET = list("ab1.:/?#@%[]-_=&x0fF\n ") + list("éßяДяÇ中文ñΩ²½٣😀\u3000\u00a0\u0301")


def test_random_strings(spark):
    draw = random.Random(7)
    urls = ["".join(draw.choices(ALPHABET, k=draw.randint(0, 40))) for _ in range(3000)]
    for row, url in zip(feature_rows(spark, urls), urls):
        assert_same(row, url)


@pytest.mark.parametrize(
    "url, expected",
    [
        ("fern.moss.org.uk", {"num_subdomains": 2, "subdomain_length": 4}),
        ("512.4.4.4/q", {"has_ip_host": 0}),
        ("moss.org:9090/fern", {"hostname_length": 8, "has_port": 1, "uses_https": 0}),
        ("ebay.org.uk/lot", {"brand_domain_mismatch": 0}),
        ("ebay.fern.org.uk/lot", {"brand_domain_mismatch": 1}),
        ("moss.org/t.co", {"is_shortener": 0}),
        ("moss.org/%5Ba%5D%20", {"num_encoded_chars": 3}),
        ("https://ann:pw@fern.moss.org:8443/x/y/z?k=1&l=2&m=3#end",
         {"uses_https": 1, "has_port": 1, "has_userinfo": 1, "has_fragment": 1,
          "num_path_segments": 3, "num_query_params": 3, "num_subdomains": 1}),
        ("", dict.fromkeys(set(FEATURE_NAMES) - {"tld_rank"}, 0) | {"tld_rank": 55}),
        ("http://fern.org/" + "z" * 4000, {"longest_consecutive_run": 4000, "url_length": 4016}),
        ("moss-and-fern.stone.org", {"subdomain_length": 13}),
        ("moss.com", {"tld_rank": 0}),
        ("moss.garden", {"tld_rank": 55}),
        ("8080", {"digit_letter_ratio": 1}),
    ],
)
def test_hand_values(spark, url, expected):
    row = feature_rows(spark, [url])[0]
    assert {k: row[k] for k in expected} == expected


@pytest.mark.parametrize("kinds", [20, measures.WIDEST])
def test_measures_of_many_kinds_of_characters(spark, kinds):
    """Characters beyond ASCII are numbered batch by batch, counted in a table or, beyond its width, as pairs."""
    draw = random.Random(kinds)
    signs = [chr(0x400 + i) for i in range(kinds - 1)] + ["\U0001f600", "a", "b", "."]
    urls = ["", "".join(signs)] + ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(200)]
    df = spark.createDataFrame([(u,) for u in urls], "url string").coalesce(1)
    for row in with_features(df, features=MEASURES).collect():
        want = plain_features(row.url)
        assert [row[m] for m in MEASURES] == pytest.approx([want[m] for m in MEASURES], abs=1e-5)


def test_schema_is_fixed_even_without_rows(spark):
    out = with_features(spark.createDataFrame([], "url string"))
    assert out.columns == ["url", *FEATURE_NAMES]
    assert {f.dataType for f in out.schema.fields[1:]} == {T.FloatType()}
    assert out.count() == 0


def test_rows_and_other_columns_are_kept(spark, sf_dir):
    raw = raw_urls(spark, sf_dir)
    out = with_features(raw, features=["url_length"])
    assert out.columns == ["row_id", "url", "label", "url_length"]
    assert out.count() == raw.count()


def test_long_whitespace_and_slashes_stay_linear(spark):
    url = "a" + " " * 300_000 + "b/" + "/" * 300_000 + "c"
    row = feature_rows(spark, [url])[0]
    assert row["longest_consecutive_run"] == 300_001
    assert row["url_length"] == len(url)


def test_plan_is_map_only_and_native(spark, sf_dir):
    plan = with_features(table(spark, sf_dir, "pages"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("ArrowEvalPython") == 1  # the character measures
    rest = [n for n in FEATURE_NAMES if n not in MEASURES]
    plan = with_features(table(spark, sf_dir, "pages"), features=rest)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_only_needed_columns_are_read(spark, sf_dir):
    df = with_features(table(spark, sf_dir, "pages"), features=["num_dots"]).select("num_dots")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<url:string>" in plan
    assert "xn--" not in plan


def test_own_lexicons(spark):
    lex = Lexicons(
        brands=("o'neil", "a\\\\b"), keywords=("it's",), shorteners=(), free_hosting=("x.y.z.w",),
        suffixes=("priv.at",), ranked_tlds=("at",), suspicious_tlds=("at",), executable_extensions=(".o'",),
    )
    urls = ["www.shop.priv.at/O'Neil/it's.o'", "a.x.y.z.w", "x.y.z.w", "c.com/a\\\\b", "bit.ly"]
    df = spark.createDataFrame(list(enumerate(urls)), "n int, url string")
    rows = with_features(df, lexicons=lex).orderBy("n").collect()
    assert rows[0].subdomain_length == 3 and rows[0].tld_rank == 0 and rows[0].has_suspicious_tld == 1
    assert rows[0].num_suspicious_keywords == 1 and rows[0].has_executable_extension == 1
    assert [r.brand_domain_mismatch for r in rows] == [1, 0, 0, 1, 0]
    assert [r.is_free_hosting for r in rows] == [0, 1, 0, 0, 0]
    assert rows[4].is_shortener == 0 and rows[1].tld_rank == 1
    with pytest.raises(ValueError):
        Lexicons(brands=("a.b",))


def test_awkward_column_names(spark):
    df = spark.createDataFrame([("http://a.com", 1)], "`the.url` string, `x y` int")
    row = with_features(df, "the.url", ["uses_https", "has_port", "num_dots"]).first()
    assert tuple(row) == ("http://a.com", 1, 0, 0, 1)


def test_names_that_are_taken(spark):
    df = spark.createDataFrame([("a.com", 1.0)], "url string, TLD_rank double")
    with pytest.raises(ValueError, match="tld_rank"):
        with_features(df)
    assert with_features(df, features=["url_length"]).columns == ["url", "TLD_rank", "url_length"]


def test_fixed_lists_are_what_they_were():
    """Content, whatever the order; ranked lists in order."""
    found = {}
    for name, values in vars(DEFAULT_LEXICONS).items():
        ordered = values if name == "ranked_tlds" else sorted(values)
        found[name] = hashlib.sha256("\n".join(ordered).encode()).hexdigest()[:12]
    assert found == PINNED
