import random

import pytest
from plain_features import is_address, registrable, split_url
from test_features import ALPHABET, HOSTILE

from linksieve.functions.url_parts import PART_NAMES, with_url_parts


def parts(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "n int, url string")
    return with_url_parts(df).orderBy("n").collect()


def test_parts_against_plain_python(spark):
    draw = random.Random(11)
    urls = HOSTILE + ["".join(draw.choices(ALPHABET, k=draw.randint(0, 30))) for _ in range(2000)]
    for row, url in zip(parts(spark, urls), urls):
        want = split_url(url or "")
        for name in ("scheme", "userinfo", "host", "port", "path", "query", "fragment"):
            assert row[name] == want[name], (name, url)
        host = want["host"]
        assert row.is_ip == is_address(host), url
        assert row.registered == ("" if row.is_ip else registrable(host)), url
        assert row.host_parts == (host.split(".") if host else []), url
        assert row.segments == [s for s in want["path"].split("/") if s], url
        assert row.last_segment == (row.segments or [""])[-1]
        if row.registered:
            assert (row.subdomain + "." + row.registered).lstrip(".") == host.lstrip(".") or host == row.registered


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://user:pw@shop.example.com:8443/a/b.TXT?x=1&y=2#top",
         dict(scheme="https", userinfo="user:pw", host="shop.example.com", port="8443", path="/a/b.TXT",
              query="x=1&y=2", fragment="top", tld="com", registered="example.com", subdomain="shop",
              segments=["a", "b.TXT"], last_segment="b.TXT", extension=".txt")),
        ("http://[::1]:80/x", dict(host="[::1]", port="80", is_ip=True, registered="", tld="", subdomain="")),
        ("http://[oops/x", dict(host="[oops", port="", is_ip=True)),
        ("x.com/a?b#c?d", dict(path="/a", query="b", fragment="c?d")),
        ("x.com#a?b/c", dict(path="", query="", fragment="a?b/c")),
        ("a@b@c.com/d@e", dict(userinfo="a@b", host="c.com", path="/d@e")),
        ("www.bbc.co.uk", dict(registered="bbc.co.uk", subdomain="www", tld="uk")),
        ("co.uk", dict(registered="co.uk", subdomain="")),
        ("localhost", dict(registered="localhost", tld="")),
        ("1.2.3.999", dict(is_ip=False, registered="3.999", tld="999")),
        (None, dict.fromkeys(set(PART_NAMES) - {"is_ip", "host_parts", "segments"}, "")),
    ],
)
def test_hand_values(spark, url, expected):
    row = parts(spark, [url])[0]
    assert {k: row[k] for k in expected} == expected


def test_other_columns_survive(spark):
    df = spark.createDataFrame([("x.com/a", "t", "n", "r")], "url string, text string, name string, rest string")
    out = with_url_parts(df)
    assert out.columns == ["url", "text", "name", "rest", *sorted(PART_NAMES, key=out.columns.index)]
    assert tuple(out.first())[:4] == ("x.com/a", "t", "n", "r")
