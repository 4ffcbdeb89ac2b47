"""Collocations against SQL and against a plain count of all windows."""

import random
import re
from collections import Counter

import duckdb
import pytest

from linksieve.llm import collocations as C
from linksieve.llm.queries import LLM_ORACLES, LLM_QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least, covered, first):
    """The same by counting every window and sorting every phrase."""
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        frequent = [p for p, a in f.items() if len(p) > 1 and a >= least]
        kept = []
        for p in frequent:
            longer = [f[q] for q in frequent if len(q) > len(p) and p in (q[: len(p)], q[1 : 1 + len(p)])]
            if not any(100 * b >= covered * f[p] for b in longer):
                cuts = [(1000000 * f[p] ** 2 // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                kept.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:first], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r[c] for c in COLUMNS) for r in C.collocations(df, **options).collect())


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    words = ["The", "the", "of", "New", "york", "city", "é", "日本", "a\x00b", "x"]
    weights = [9, 9, 9, 5, 5, 5, 3, 3, 2, 1]
    texts = []
    for _ in range(300):
        picked = draw.choices(words, weights, k=draw.randint(0, 25))
        picked = [w + draw.choice(["", "", "", " city", "  hall", ".", ",\t"]) for w in picked]
        texts.append((draw.choice(["en", "en", "en", "fr", None, ""]), " ".join(picked)))
    same = "one single hot phrase here"
    return texts + [("en", same)] * 150 + [("en", None), (None, ""), ("fr", " . ,\n\t"), ("de", "too few words")]


@pytest.mark.parametrize("shards, least, covered, first", [(1, 3, 80, 7), (2, 10, 50, 2000), (4, 2, 0, 3)])
def test_against_a_plain_count(spark, rows, shards, least, covered, first):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    options = dict(least=least, covered=covered, first=first)
    assert found(df, shards=shards, places=1 << 16, **options) == plain(rows, **options)


def test_phrases_that_share_a_place_change_no_count(spark, rows, monkeypatch):
    monkeypatch.setattr(C, "_hashes", lambda lang, words: C.np.array([len(w) for w in words], C.np.uint64))
    monkeypatch.setattr(C, "_word_place", lambda places: C.F.octet_length("phrase").cast("long"))
    monkeypatch.setattr(
        C, "_pair_place", lambda places: C.F.octet_length(C.F.substring_index("phrase", " ", -1)).cast("long")
    )
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert found(df, shards=3, places=1 << 15) == plain(rows, 10, 50, 2000)


def test_many_small_sums(spark, rows, monkeypatch):
    monkeypatch.setattr(C, "AT_ONCE", 50)
    monkeypatch.setattr(C, "COMMON", 2)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert found(df, least=4) == plain(rows, 4, 50, 2000)


def test_table_against_sql(spark, sf_dir):
    query = LLM_QUERIES["op13_collocations"](spark, sf_dir)
    assert query.columns == COLUMNS
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.sql(LLM_ORACLES["op13_collocations"]).fetchall()
    assert sorted(tuple(r) for r in query.collect()) == sorted(want) and len(want) > 100


def test_products_beyond_64_bits(spark):
    counted = spark.createDataFrame(
        [("en", 1, "a", 4 * 10**12), ("en", 1, "b", 3 * 10**12), ("en", 2, "a b", 2 * 10**12 + 1)],
        "lang string, size int, phrase string, rows long",
    )
    (row,) = C.scored(counted).collect()
    assert row.score == 1000000 * (2 * 10**12 + 1) ** 2 // (12 * 10**24)


def test_empty_rare_and_long(spark):
    empty = spark.createDataFrame([], "lang string, text string, PHRASE int, rank string")
    assert C.collocations(empty).count() == 0
    rare = spark.createDataFrame([("en", "no phrase twice", 1)], "lang string, text string, score int")
    assert C.collocations(rare).columns == COLUMNS and C.collocations(rare).count() == 0
    text = "a long text " * 50_000
    (row,) = found(spark.createDataFrame([(None, text)], "lang string, text string"), first=1)
    assert row[:4] in {("und", 1, p, 49_999) for p in ("long text a", "text a long")} | {
        ("und", 1, "a long text", 50_000)
    }
