"""Operators that compare rows with each other, against brute force."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from linksieve.llm import embedding_dedup, html_extraction, minmax_dedup
from linksieve.llm.components import components

DOCS = "doc_id long, text string"


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# -- components ----------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)]
    links += [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(1, 200)] + [(1000, 1000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = components_of({n for a, b in links if a != b for n in (a, b)}, links)
    assert got == want


def test_no_links(spark):
    links = spark.createDataFrame([(1, None), (2, 2)], "a long, b long")
    assert components(links).collect() == []


# -- near-duplicate documents --------------------------------------------------


def brute_force(docs, size, percent):
    sets = {}
    for i, text in docs:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    by_shingle = defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            by_shingle[shingle].append(i)
    shared = defaultdict(int)
    for ids in by_shingle.values():
        for a in ids:
            for b in ids:
                shared[a, b] += a < b
    links = [(a, b) for (a, b), n in shared.items() if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    return sets, components_of(sets, links)


def near_copies(seed, groups=12, copies=12):
    """Groups of copies with more and more edits, so that some link only through others."""
    draw, docs = random.Random(seed), []
    for _ in range(groups):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.choice([4, 30, 120, 400]))]
        for _ in range(copies):
            docs.append((len(docs), " ".join(words)))
            words = list(words)
            for _ in range(draw.randint(0, max(1, len(words) // 60))):
                words[draw.randrange(len(words))] = f"x{draw.randrange(5000)}"
    draw.shuffle(docs)
    return docs


def check_groups(spark, docs, size, percent):
    rows = minmax_dedup.deduplicate(spark.createDataFrame(docs, DOCS), size=size, percent=percent).collect()
    sets, want = brute_force(docs, size, percent)
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(s) for i, s in sets.items()}
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_copies(spark, size, percent):
    check_groups(spark, near_copies(size) + [(9000, "One  two"), (9001, "ONE\ttwo"), (9002, "one")], size, percent)


def test_near_copies_in_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(minmax_dedup, "BLOCK", 300)
    check_groups(spark, near_copies(1, groups=4, copies=30), 3, 85)


def test_near_copies_of_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    check_groups(spark, [tuple(r) for r in table.collect()], 3, 85)


def test_bands_miss_few():
    for percent in (60, 80, 85, 95):
        rows = minmax_dedup.band_rows(percent)
        bands = 2 * minmax_dedup.PERMUTATIONS // rows
        assert (1 - (percent / 100) ** rows) ** bands <= minmax_dedup.MISSED


def test_minimum_and_maximum_estimate_the_similarity():
    draw = np.random.default_rng(1)
    factors = minmax_dedup._factors()
    for _ in range(20):
        both = draw.integers(0, 1 << 63, 1500, dtype=np.uint64)
        a, b = both[:1200], both[300:]
        agree = minmax_dedup.min_max_signature(a, factors) == minmax_dedup.min_max_signature(b, factors)
        assert abs(agree.mean() - 0.6) < 0.2


def test_one_document_of_each_group_stays(spark):
    base = " ".join(f"word{i}" for i in range(100))
    docs = [(5, base, "a"), (3, base + " more", "b"), (7, base, "c"), (3, base + " more", "d"), (8, "else", "e"),
            (9, None, "f"), (10, "", "g"), (None, base, "h")]
    rows = minmax_dedup.keep_one(spark.createDataFrame(docs, "doc_id long, text string, kept string")).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["10", "3", "8", "9", "None"]
    assert all(r.kept in "abcdefgh" for r in rows)


def test_other_texts_of_an_id_stay(spark):
    base = {name: " ".join(f"{name}{i}" for i in range(100)) for name in "abcd"}
    docs = [(1, base["a"]), (1, base["b"]), (1, base["b"]), (1, base["c"]), (2, base["c"] + " more"), (0, base["a"] + " more"),
            (2, base["d"]), (3, base["d"].upper()), (1, base["c"] + " end"), (4, None), (4, None), (None, base["a"])]
    rows = minmax_dedup.keep_one(spark.createDataFrame(docs, DOCS)).collect()
    got = sorted((str(r.doc_id), (r.text or "")[:2]) for r in rows)
    assert got == [("0", "a0"), ("1", "b0"), ("1", "c0"), ("2", "d0"), ("4", ""), ("None", "a0")]


def test_a_hot_id_loses_near_duplicates_only(spark):
    docs = near_copies(5, groups=6, copies=6)
    _, want = brute_force(docs, 5, 80)
    rows = minmax_dedup.keep_one(spark.createDataFrame([(7, t) for _, t in docs], DOCS)).collect()
    assert len(rows) == len(set(want.values()))
    component = {t: want[i] for i, t in docs}
    assert {component[r.text] for r in rows} == set(want.values())


# -- embeddings ----------------------------------------------------------------


def unit_rows(vectors):
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / lengths


def check_links(spark, vectors, **rows):
    table = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got = {r.vec_id: r for r in embedding_dedup.deduplicate(
        spark.createDataFrame(table, "vec_id long, embedding array<double>")).collect()}
    near = unit_rows(np.array(vectors)) @ unit_rows(np.array(vectors)).T >= 0.9
    np.fill_diagonal(near, False)
    found = sum(min(got[i].n_links, int(near[i].sum())) for i in got)
    assert all(got[i].n_links <= near[i].sum() for i in got)
    assert found >= 0.97 * near.sum()
    want = components_of(range(len(vectors)), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])
    same = sum(got[i].component_id == want[i] for i in got)
    assert same >= 0.97 * len(got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


@pytest.mark.parametrize("seed", range(2))
def test_links_of_clustered_vectors(spark, seed, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD", 150)
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(12, 24))
    vectors = centers[draw.integers(0, 12, 500)] + draw.normal(size=(500, 24)) * 0.8
    copies = vectors[draw.integers(0, 500, 200)] + draw.normal(size=(200, 24)) * 0.15
    check_links(spark, np.concatenate([vectors, copies, np.repeat(vectors[:1], 60, axis=0)]))


def test_links_of_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    check_links(spark, [[float(x) for x in r.embedding] for r in table])


def test_vectors_without_direction(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]),
            (8, []), (None, [1.0, 0.0]), (9, [1e300, 1e300]), (10, [1.0]), (11, [1.0, 0.0]), (12, [1.0, 0.0]), (12, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as KEPT", "1 as node")
    got = embedding_dedup.deduplicate(df).collect()
    assert len(got) == len(rows)
    found = {(r.vec_id, r.n_links, r.component_id) for r in got}
    linked = {(1, 4, 1), (2, 4, 1), (11, 4, 1), (12, 4, 1)}
    assert found == linked | {(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10)} | {(None, 0, None)}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.deduplicate(empty).collect() == []


def groups_of_near_vectors(seed, groups, each, size=64):
    draw = np.random.default_rng(seed)
    return np.repeat(draw.normal(size=(groups, size)), each, axis=0) + draw.normal(size=(groups * each, size)) * 0.15


def check_all_links(spark, vectors):
    table = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got = {r.vec_id: r for r in embedding_dedup.deduplicate(
        spark.createDataFrame(table, "vec_id long, embedding array<double>")).collect()}
    near = unit_rows(vectors) @ unit_rows(vectors).T >= 0.9
    np.fill_diagonal(near, False)
    assert [got[i].n_links for i in range(len(vectors))] == near.sum(axis=1).tolist()
    want = components_of(range(len(vectors)), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])
    assert {i: r.component_id for i, r in got.items()} == want
    assert {r.audited_recall for r in got.values()} == {1.0}


def test_links_of_groups_larger_than_the_candidates(spark):
    check_all_links(spark, groups_of_near_vectors(1, 12, 100))


def test_shards_are_compared_exactly_if_the_graph_loses_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "range_search", lambda query, vectors, adjacent, starts: np.empty(0, np.int64))
    for name, value in {"SHARD": 150, "AUDITED": 10_000, "LEAST_RECALL": 1.0}.items():
        monkeypatch.setattr(embedding_dedup, name, value)
    check_all_links(spark, groups_of_near_vectors(2, 8, 80))


def test_search_enters_every_island():
    vectors = unit_rows(groups_of_near_vectors(3, 40, 100))
    adjacent = embedding_dedup.pruned_graph(vectors)
    starts = embedding_dedup.entries(vectors, adjacent)
    assert len(starts) == 40
    for i in range(0, 4000, 37):
        found = embedding_dedup.range_search(vectors[i], vectors, adjacent, starts)
        assert found.tolist() == np.flatnonzero(vectors @ vectors[i] >= embedding_dedup.COSINE).tolist()


def test_pruned_graph_reaches_all():
    vectors = unit_rows(np.random.default_rng(4).normal(size=(400, 16)))
    adjacent = embedding_dedup.pruned_graph(vectors)
    assert max(map(len, adjacent)) <= 3 * embedding_dedup.DEGREE
    seen, open_nodes = {0}, [0]
    while open_nodes:
        for n in adjacent[open_nodes.pop()]:
            if n not in seen:
                seen.add(int(n))
                open_nodes.append(int(n))
    assert len(seen) == 400


# -- pages ---------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><p>Site name</p></header><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- <article>no</article> -->
<{tag}><header><h1>Head &amp; line</h1></header><p>First <b>bold</b>,&nbsp;one<br>two   three<p>Second
 paragraph<div class="ad">Buy</div><form><input name=q><p>Search</p></form></{tag}>
<aside><p>Side</p></aside><div id="comments"><article><p>Reader</p></article></div><footer>&copy; x</footer></body></html>"""


def texts(pages):
    return html_extraction.host_texts(pages)[0]


def test_marked_articles():
    want = "Head & line\n\nFirst bold, one two three\n\nSecond paragraph"
    assert texts([PAGE.format(tag="article"), PAGE.format(tag="main"), PAGE.format(tag="article")]) == [want] * 3


def test_broken_markup():
    cut = "<html><body><nav><a href='/x'>Menu<article><p><b>Open<br><p>text &am"
    assert texts([cut, None, "", "   ", "just text", "<p>a < b</p>", "<article><p>x</article", '<p>y</p><a href="'])[:6] == [
        "Open\n\ntext &am", "", "", "", "just text", "a < b"]


def test_unmarked_pages_lose_what_the_host_repeats():
    menu = "Top menu with links to all of the many parts of this site"
    end = "Share this page with all of your friends today and be happy"
    pages = [f"<div><p>{menu}</p><p>Own text number {i} with words w{i} x{i} y{i} z{i} u{i}</p><p>{end}</p></div>" for i in range(6)]
    assert texts(pages) == [f"Own text number {i} with words w{i} x{i} y{i} z{i} u{i}" for i in range(6)]
    assert texts(pages[:1] * 6) == [f"{menu}\n\nOwn text number 0 with words w0 x0 y0 z0 u0\n\n{end}"] * 6


def test_repeated_tokens_against_windows():
    draw = np.random.default_rng(2)
    for _ in range(30):
        pages = [draw.integers(0, 4, draw.integers(0, 60)) for _ in range(6)]
        pages[1] = np.r_[pages[0][:20], pages[1]]
        pages[2] = np.r_[pages[2], pages[0][:20]]
        where = defaultdict(set)
        for p, tokens in enumerate(pages):
            for i in range(len(tokens) - html_extraction.LONG + 1):
                where[tuple(tokens[i : i + html_extraction.LONG])].add(p)
        want = []
        for tokens in pages:
            inside = np.zeros(len(tokens), bool)
            for i in range(len(tokens) - html_extraction.LONG + 1):
                if len(where[tuple(tokens[i : i + html_extraction.LONG])]) >= html_extraction.PAGES:
                    inside[i : i + html_extraction.LONG] = True
            want.append(inside)
        page_of = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
        got = html_extraction.repeated_tokens(np.concatenate(pages), page_of)
        assert (got == np.concatenate(want)).all()


@pytest.mark.parametrize("broadcast", [html_extraction.BROADCAST_HOSTS, 0])
def test_pages_of_hot_hosts(spark, monkeypatch, broadcast):
    monkeypatch.setattr(html_extraction, "SHARD", 10)
    monkeypatch.setattr(html_extraction, "BROADCAST_HOSTS", broadcast)
    rows = [(i, f"http://{'hot' if i % 3 else f'h{i}'}.org/{i}", PAGE.format(tag="article")) for i in range(100)]
    rows += [(1, "http://hot.org/1", PAGE.format(tag="main")), (None, None, None), (200, "no host", "<p>z</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'' as TEXT", "1 as n_chars")
    got = html_extraction.extract(df).collect()
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)
    assert sum(r.text.startswith("Head & line") for r in got) == 101
    assert html_extraction.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("broadcast", [html_extraction.BROADCAST_HOSTS, 0])
def test_a_large_host_repeats_what_it_would_as_a_small_one(spark, monkeypatch, broadcast):
    def page(i, section):
        menu = " ".join(f"menu{section}{k}" for k in range(12))
        return f"<div class=x{i}><p>{menu}</p><p>{' '.join(f'own{i}{k}' for k in range(15))}</p></div>"

    pages = [page(i, i % 15) for i in range(60)]  # four pages a section
    pages += [page(i, f"two{i // 2}") for i in range(100, 120)]  # two, which is no boilerplate
    pages += [page(1000, "same").replace("x1000", f"x{i}") for i in range(20)]  # equal streams count once
    want = dict(enumerate(zip(*html_extraction.host_texts(pages))))
    monkeypatch.setattr(html_extraction, "SHARD", 8)
    monkeypatch.setattr(html_extraction, "BROADCAST_HOSTS", broadcast)
    rows = [(i, f"http://one.org/{i}", p) for i, p in enumerate(pages)]
    rows += [(i + 1000, f"http://small{i}.org/", p) for i, p in enumerate(pages[:5])]
    got = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: (r.text, r.n_repeated) for r in got if r.page_id < 1000} == want
    assert sum(len(text.split()) == 15 for text, _ in want.values()) == 60
    assert all(r.n_repeated == 0 for r in got if r.page_id >= 1000) and len(got) == len(rows)


@pytest.mark.parametrize("crowded", [False, True])
def test_short_hashes_only_choose_what_is_counted(spark, monkeypatch, crowded):
    def crowded_slices(runs, size):  # three slices of four short hashes, which all runs share
        return runs % np.uint64(3), (runs // np.uint64(3) % np.uint64(4)).astype(np.uint32)

    draw = np.random.default_rng(4)
    shared = [" ".join(f"s{i}w{k}" for k in range(10)) for i in range(80)]
    pages = []
    for i in range(120):  # passages on one to a dozen pages, some of them in equal streams only
        own = " ".join(f"p{i}w{k}" for k in range(12))
        pages.append(f"<p>{shared[int(draw.exponential(15)) % 80]}</p><p>{own}</p>\x1d<p>{shared[i % 80]}</p>")
    pages += [pages[7]] * 9 + [None, "", "<p>a b</p>", "<article>x\x1dy &lt; z</article>"]
    want = dict(enumerate(zip(*html_extraction.host_texts(pages))))
    monkeypatch.setattr(html_extraction, "SHARD", 10)
    monkeypatch.setattr(html_extraction, "PIECE", 3)
    monkeypatch.setattr(html_extraction, "SLICE", 2_000)
    monkeypatch.setattr(html_extraction, "STREAM_SLICE", 4_000)
    if crowded:
        monkeypatch.setattr(html_extraction, "run_slices", crowded_slices)
    rows = [(str(i), f"http://one.org/{i}", p) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "host string, shard string, html string")
    got = html_extraction.extract(df, url="shard", key="host").collect()
    assert len(got) == len(rows) and len({n for _, n in want.values()}) > 2
    assert {int(r.host): (r.text, r.n_repeated) for r in got} == want


def test_packed_values():
    for values in ([], [0], [0, 0, 0, 5, 2**32 - 1, 2**32 - 1], range(0, 90_000, 7)):
        values = np.array(values, np.uint32)
        assert (html_extraction.unpacked_values(html_extraction.packed_values(values), len(values)) == values).all()


def shuffled_bytes(df):
    """What the shuffles of a collected frame wrote, each counted once."""
    found, seen = {}, [df._jdf.queryExecution().executedPlan()]
    while seen:
        node = seen.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            found[node.id()] = node.metrics().apply("shuffleBytesWritten").value()
        if kind == "AdaptiveSparkPlanExec":
            seen.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            seen.append(node.plan())
        elif kind == "ReusedExchangeExec":
            seen.append(node.child())
        else:
            seen += [node.children().apply(i) for i in range(node.children().size())]
    return sum(found.values())


@pytest.mark.parametrize("copies", [1, 4])
def test_pages_of_a_large_host_travel_once_and_packed(spark, tmp_path, copies):
    draw = np.random.default_rng(5)
    pages = [" ".join("".join(map(chr, draw.integers(97, 105, 5))) for _ in range(300)) for _ in range(2000 // copies)]
    pages *= copies
    rows = [(i, f"http://one.org/{i}", f"<p>{p}</p>") for i, p in enumerate(pages)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages")
    size = sum(p.stat().st_size for p in (tmp_path / "pages").glob("*.parquet"))
    df = html_extraction.extract(spark.read.parquet(f"{tmp_path}/pages"))
    assert {r.page_id: r.text for r in df.collect()} == dict(enumerate(pages))
    assert 0.2 * size < shuffled_bytes(df) < 1.5 * size


def test_pages_of_the_table(spark, sf_dir):
    rows = html_extraction.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        inside = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        assert "".join(r.text.split()) == "".join(plain_text(inside).split())


def plain_text(page):
    import html
    import re

    return html.unescape(re.sub("<[^>]*>", " ", page))
