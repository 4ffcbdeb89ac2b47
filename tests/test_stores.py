"""Stored tables that are brought up to date: features by bucket, the corpus by shard, journals."""

import pytest
from pyspark.sql import functions as F

from linksieve.functions.lexicons import Lexicons
from linksieve.operators.corpus import clean_corpus, cleaning_audit, url_groups
from linksieve.operators.features import FEATURE_NAMES, with_features
from linksieve.plans.sample_corpus import raw_urls
from linksieve.session import checkpointed
from linksieve.sources import features as S
from linksieve.sources.corpus_state import CorpusState
from linksieve.sources.journal import Journal, fingerprint
from linksieve.sources.versions import current, publish


def corpus_of(spark, n, start=0):
    rows = [(f"site{i}.example{i % 7}.com/a{i}", i % 2) for i in range(start, n)]
    return spark.createDataFrame(rows, "url string, label byte")


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def bucket_folders(df):
    return {tuple(f.split("/")[-3:-1]) for f in df.inputFiles()}


def test_one_changed_row_rewrites_one_bucket(spark, tmp_path):
    path = str(tmp_path / "features")
    corpus = corpus_of(spark, 500)
    before = S.load_features(corpus, path, buckets=16)
    old_rows = sorted(map(tuple, before.collect()))
    old = bucket_folders(before)
    assert len(old) == 16
    changed = corpus.withColumn(
        "label", F.when(F.col("url").startswith("site3."), 1 - F.col("label")).otherwise(F.col("label")).cast("byte")
    )
    after = S.load_features(changed, path, buckets=16)
    new = bucket_folders(after)
    assert len(new) == 16 and len(new - old) == 1
    assert same(after, with_features(changed))
    # the frame that was opened before still reads what it read
    assert sorted(map(tuple, before.collect())) == old_rows
    assert same(S.read_features(spark, path, version=1), with_features(corpus))
    assert same(S.read_features(spark, path), after)


def test_rows_that_go_and_come(spark, tmp_path):
    path = str(tmp_path / "features")
    S.load_features(corpus_of(spark, 40), path, buckets=64)
    for corpus in (corpus_of(spark, 60, 20), corpus_of(spark, 21, 20), corpus_of(spark, 20, 20), corpus_of(spark, 30)):
        got = S.load_features(corpus, path, buckets=64)
        assert same(got, with_features(corpus)) and got.columns == ["url", "label", *FEATURE_NAMES]
    assert current(spark, path)["version"] == 5


def test_other_lists_versions_or_buckets_rebuild_all(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "features")
    corpus = corpus_of(spark, 50)
    seen = [bucket_folders(S.load_features(corpus, path, buckets=4))]
    acme = Lexicons(brands=("acme",))
    seen.append(bucket_folders(S.load_features(corpus, path, buckets=4, lexicons=acme)))
    seen.append(bucket_folders(S.load_features(corpus, path, buckets=8, lexicons=acme)))
    seen.append(bucket_folders(S.load_features(corpus, path, buckets=8, lexicons=acme, rebuild=True)))
    monkeypatch.setattr(S, "FEATURE_VERSION", S.FEATURE_VERSION + 1)
    seen.append(bucket_folders(S.load_features(corpus, path, buckets=8, lexicons=acme)))
    assert all(not a & b for i, a in enumerate(seen) for b in seen[i + 1 :])
    assert bucket_folders(S.load_features(corpus, path, buckets=8, lexicons=acme)) == seen[-1]


def test_an_interrupted_build_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "features")
    corpus, more = corpus_of(spark, 30), corpus_of(spark, 40)
    S.load_features(corpus, path, buckets=4)
    monkeypatch.setattr(S, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError, match="gone"):
        S.load_features(more, path, buckets=4)
    assert same(S.read_features(spark, path), with_features(corpus))
    monkeypatch.undo()
    assert same(S.load_features(more, path, buckets=4), with_features(more))
    with pytest.raises(FileNotFoundError, match="no feature table"):
        S.read_features(spark, str(tmp_path / "nothing"))


def test_large_buckets_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_FILE", 50)
    corpus = corpus_of(spark, 400)
    got = S.load_features(corpus, str(tmp_path / "features"), buckets=2)
    assert len(got.inputFiles()) > 4 and same(got, with_features(corpus))


def test_claims_of_two_writers(spark, tmp_path):
    path = str(tmp_path / "table")
    assert current(spark, path) is None
    publish(spark, path, {"a": 1}, None)
    first = current(spark, path)
    publish(spark, path, {"a": 2}, first)
    publish(spark, path, {"a": 3}, first)
    last = current(spark, path)
    assert last["version"] == 2 and last["a"] in (2, 3) and current(spark, path, 1) == first
    assert publish(spark, path, {"a": 4}, last) == 3 and current(spark, path)["a"] == 4


# -- corpus by shard -------------------------------------------------------------


def parts(spark, n=3):
    raw = checkpointed(raw_urls(spark, "/root/testdata/sf0.01"))
    return raw, [raw.filter(F.pmod("row_id", F.lit(n)) == i) for i in range(n)]


def test_shard_by_shard_equals_all_at_once(spark, tmp_path):
    raw, shards = parts(spark)
    state = CorpusState(spark, str(tmp_path / "state"), buckets=4)
    opened = []
    for i, shard in enumerate(shards):
        assert state.merge(shard, f"s{i}")
        opened.append((state.groups(), state.groups().count()))
    assert state.shards() == ["s0", "s1", "s2"]
    assert same(state.groups(), url_groups(raw))
    assert same(state.corpus(), clean_corpus(raw))
    assert state.audit().collect() == cleaning_audit(raw).collect()
    assert [frame.count() for frame, _ in opened] == [n for _, n in opened]
    assert same(state.groups(version=1), url_groups(shards[0]))


def test_merging_a_shard_again_changes_nothing(spark, tmp_path):
    raw, shards = parts(spark)
    state = CorpusState(spark, str(tmp_path / "state"), buckets=4)
    state.merge(shards[0], "a")
    before = state.audit().collect()
    assert not state.merge(shards[0], "a") and state.audit().collect() == before
    # another session has the path only
    assert CorpusState(spark, str(tmp_path / "state")).audit().collect() == before


def test_a_broken_merge_is_not_seen(spark, tmp_path, monkeypatch):
    from linksieve.sources import corpus_state as M

    raw, shards = parts(spark)
    state = CorpusState(spark, str(tmp_path / "state"), buckets=4)
    state.merge(shards[0], "a")
    before = state.audit().collect()
    monkeypatch.setattr(M, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        state.merge(shards[1], "b")
    monkeypatch.undo()
    assert state.audit().collect() == before and state.shards() == ["a"]
    state.merge(shards[1], "b")
    assert same(state.groups(), url_groups(shards[0].unionByName(shards[1])))


def test_the_stored_side_is_not_shuffled(spark, tmp_path):
    raw, shards = parts(spark)
    state = CorpusState(spark, str(tmp_path / "state"), buckets=8)
    for i, shard in enumerate(shards):
        plan = state.merged(shard)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1, plan  # the new shard's grouping
        assert "SelectedBucketsCount: 8 out of 8" in plan
        state.merge(shard, str(i))
        # every bucket is one file, as the tasks of the join are its buckets
        assert len(state.groups().inputFiles()) <= 8


def test_a_url_with_a_third_of_the_rows(spark, tmp_path):
    hot = [("http://hot.com/", 1)] * 3000
    rest = [(f"a{i}.com", i % 2) for i in range(6000)]
    raw = spark.createDataFrame(hot + rest + [(None, 1), ("", None)], "url string, label int")
    state = CorpusState(spark, str(tmp_path / "state"), buckets=4)
    for i in range(2):
        state.merge(raw, f"copy{i}")
    assert state.groups().filter("url = 'hot.com'").first().rows == 6000
    assert same(state.corpus(), clean_corpus(raw))
    assert state.audit().first().missing_rows == 4


def test_no_state_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="merge a shard"):
        CorpusState(spark, str(tmp_path / "state")).groups()
    state = CorpusState(spark, str(tmp_path / "state"), buckets=2)
    state.merge(spark.createDataFrame([], "url string, label int"), "empty")
    assert state.corpus().isEmpty() and state.audit().first().raw_rows == 0


# -- journal ---------------------------------------------------------------------


def test_journal(spark, tmp_path):
    path = str(tmp_path / "journal")
    book = Journal(spark, path)
    assert book.get({"a": 1}) is None
    assert book.once({"a": 1, "b": [2.5, None]}, lambda: {"f1": 0.25}) == {"f1": 0.25}
    book.add({"a": 2}, {"f1": 1 / 3})
    again = Journal(spark, path)
    assert again.once({"b": [2.5, None], "a": 1}, lambda: pytest.fail("known")) == {"f1": 0.25}
    assert again.get({"a": 2}) == {"f1": 1 / 3} and again.get({"a": 3}) is None
    assert Journal(spark, None).once({"a": 1}, lambda: {"x": 1}) == {"x": 1}


def test_fingerprint(spark):
    df = corpus_of(spark, 100)
    columns = ["url", "label"]
    assert fingerprint(df, columns) == fingerprint(df.repartition(7), columns)
    assert fingerprint(df, columns) != fingerprint(df.filter("url <> 'site3.example3.com/a3'"), columns)
    twice = df.unionByName(df)
    assert fingerprint(twice, columns) != fingerprint(df, columns)
    assert fingerprint(df.limit(0), columns) == fingerprint(df.limit(0), columns)
