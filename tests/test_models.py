import math

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Observation
from pyspark.sql import functions as F

from linksieve.functions.lexicons import Lexicons
from linksieve.operators import models as M
from linksieve.operators import scoring
from linksieve.operators.corpus import clean_corpus
from linksieve.operators.diagnostics import family_shares, marginal_gains
from linksieve.operators.features import FEATURE_NAMES
from linksieve.operators.scoring import (
    featurize, importance_table, score_repeated_urls, score_urls, top_features, verdicts,
)
from linksieve.operators.splits import domain_disjoint_split, make_splits
from linksieve.operators.tuning import tune
from linksieve.plans import ablation as ablation_plans
from linksieve.plans.ablation import (
    family_ablation, feature_configs, learning_curve, memorisation_gap, run_config, split_strategy,
)
from linksieve.plans.evaluate import evaluate_models, write_evaluation
from linksieve.plans.sample_corpus import raw_urls
from linksieve.plans.train import train_models
from linksieve.session import checkpointed
from linksieve.sources.features import load_features
from linksieve.sources.models import load_model, save_model
from linksieve.sources.reports import read_best_params
from linksieve.sources.urls import urls_frame
from linksieve.streaming.scoring import scored_stream

SMALL = {
    "random_forest": {"n_estimators": 8, "max_depth": 6},
    "boosted_trees": {"n_estimators": 5, "max_depth": 4},
}
CLEAR = {
    "https://github.com/files/one": 0,
    "https://en.wikipedia.org/wiki/CamelCase_1#top": 0,
    "http://paypal-secure-login77.verify-account.top/signin/update?cmd=login&id=77": 1,
    "http://login123.duckdns.org/signin/update?cmd=login&id=123": 1,
}


@pytest.fixture(scope="module")
def work(tmp_path_factory):
    return str(tmp_path_factory.mktemp("models"))


@pytest.fixture(scope="module")
def corpus(spark):
    return checkpointed(clean_corpus(raw_urls(spark, "/root/testdata/sf0.01")))


@pytest.fixture(scope="module")
def features(corpus, work):
    return load_features(corpus, f"{work}/features")


@pytest.fixture(scope="module")
def trained(features, work):
    table = checkpointed(make_splits(features))
    fitted, summary = train_models(
        table, f"{work}/models", f"{work}/best_params", fixed=SMALL, draws=2, folds=2, rows=400
    )
    return table, fitted, summary


def test_builders_map_parameters(spark):
    forest = M.build_random_forest(max_features=0.4, min_samples_split=9).getStages()[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (300, 30, "0.4")
    assert forest.getMinInstancesPerNode() == 5 and forest.getSeed() == 42
    boosted = M.build_boosted_trees(gamma=0.1).getStages()[-1]
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (400, 8, 0.2)
    assert boosted.getMinInfoGain() == 0.1 and boosted.getSubsamplingRate() == 0.9
    with pytest.raises(ValueError):
        M.build_random_forest(trees=3)


def test_depths_beyond_the_limit_are_refused():
    assert M.build_random_forest(max_depth=30).getStages()[-1].getMaxDepth() == 30
    with pytest.raises(ValueError, match="30"):
        M.build_random_forest(max_depth=31)


def test_reported_parameters_are_the_fitted_ones(trained):
    _, fitted, summary = trained
    for row in summary:
        assert M.fitted_as(fitted[row["model"]], row["model"], row["best_params"])
        assert not M.fitted_as(fitted[row["model"]], row["model"], {**row["best_params"], "n_estimators": 999})


def test_draws_stay_in_their_ranges():
    assert M.draw_params("boosted_trees", 5) == M.draw_params("boosted_trees", 5)
    for p in M.draw_params("boosted_trees", 200):
        assert 200 <= p["n_estimators"] < 600 and 6 <= p["max_depth"] < 14
        assert 0.03 <= p["learning_rate"] <= 0.4 and 0.6 <= p["subsample"] <= 1
        assert 1 <= p["min_child_weight"] < 10 and 0 <= p["gamma"] <= 0.4
    for p in M.draw_params("random_forest", 200):
        assert 150 <= p["n_estimators"] < 400 and p["max_depth"] in (None, 20, 30)
        assert 2 <= p["min_samples_split"] < 12 and 1 <= p["min_samples_leaf"] < 5
        assert p["max_features"] in ("sqrt", "log2", 0.4)


def test_feature_store_reuses_and_rebuilds(spark, corpus, features, work):
    path = f"{work}/features"
    first = sorted(features.inputFiles())
    assert features.columns == ["url", "label", *FEATURE_NAMES]
    assert sorted(load_features(corpus.repartition(5), path).inputFiles()) == first
    other = f"{work}/features2"
    before = set(load_features(corpus, other).inputFiles())
    changed = corpus.withColumn("label", 1 - F.col("label"))
    after = set(load_features(changed, other).inputFiles())
    assert not after & before
    assert not set(load_features(changed, other, lexicons=Lexicons(brands=("acme",))).inputFiles()) & after


def test_training_summary_and_artifacts(spark, trained, work):
    table, fitted, summary = trained
    assert [s["model"] for s in summary] == list(M.BUILDERS)
    for s in summary:
        assert s["n_train"] + s["n_val"] + s["n_test"] == table.count()
        assert s["n_features"] == 47 and 0 <= s["f1"] <= 1 and s["roc_auc"] > 0.8
    saved = read_best_params(spark, f"{work}/best_params", M.BUILDERS)
    assert saved == {s["model"]: s["best_params"] for s in summary}
    assert saved["random_forest"]["n_estimators"] == 8
    assert read_best_params(spark, f"{work}/nothing", ["a"]) == {"a": {}}
    with pytest.raises(FileNotFoundError, match="train"):
        load_model(f"{work}/models", "missing")


@pytest.mark.parametrize("name", list(M.BUILDERS))
def test_scoring_invariants(spark, trained, work, name):
    model = load_model(f"{work}/models", name)
    urls = [*CLEAR, None, "", "HTTPS://WWW.Example.COM/Path/", "http://1.2.3.4:99/a"]
    rows = score_urls(model, urls_frame(spark, urls)).collect()
    assert [r.url for r in rows] == urls
    for r in rows:
        assert 0 <= r.p_phish <= 1 and r.prediction == int(r.p_phish >= 0.5)
    by_url = {r.url: r for r in rows}
    for url, label in CLEAR.items():
        assert by_url[url].prediction == label, url
    assert by_url["HTTPS://WWW.Example.COM/Path/"].canonical_url == "www.example.com/Path"
    assert by_url[None].p_phish == by_url[""].p_phish
    again = score_urls(trained[1][name], urls_frame(spark, urls)).collect()
    assert again == rows
    for url in CLEAR:
        assert score_urls(model, urls_frame(spark, [url])).first().p_phish == by_url[url].p_phish
    shown = verdicts(score_urls(model, urls_frame(spark, list(CLEAR)))).collect()
    assert [r.verdict for r in shown] == ["legitimate"] * 2 + ["PHISHING"] * 2
    assert all(r.p == round(r.p, 4) for r in shown)
    plan = score_urls(model, urls_frame(spark, urls))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BatchEvalPython" not in plan


def test_featurize_equals_direct_features_on_canonical_urls(spark, features):
    again = featurize(features.select("url")).select("url", *FEATURE_NAMES)
    assert again.exceptAll(features.select("url", *FEATURE_NAMES)).isEmpty()


def test_evaluation(spark, trained, work):
    table, fitted, _ = trained
    result = evaluate_models(fitted, table)
    metrics = {r.model: r for r in result.comparison.collect()}
    assert set(metrics) == set(M.BUILDERS) and all(r.accuracy > 0.75 for r in metrics.values())
    cells = result.confusion.groupBy("model").agg(F.sum("n").alias("n")).collect()
    assert {r.n for r in cells} == {table.filter("split = 'test'").count()}
    sums = result.importance.groupBy("model").agg(F.sum("importance").alias("s")).collect()
    assert all(math.isclose(r.s, 1) for r in sums)
    assert top_features(result.importance, 5).count() == 10
    assert importance_table(result.importance, list(M.BUILDERS)).count() == 47
    shares = family_shares(result.importance).groupBy("model").agg(F.sum("share").alias("s")).collect()
    assert all(math.isclose(r.s, 1) for r in shares)
    write_evaluation(result, f"{work}/reports", list(M.BUILDERS))
    stored = spark.read.csv(f"{work}/reports/model_comparison", header=True, inferSchema=True)
    assert stored.count() == 2 and stored.columns == ["model", "accuracy", "precision", "recall", "f1", "roc_auc"]
    assert spark.read.parquet(f"{work}/reports/roc_curve").count() > 4


def test_ablation_pieces(spark, corpus, features, trained):
    sizes = {k: len(v) for k, v in feature_configs().items()}
    assert sizes == {
        "all_features": 47, "only_lexical": 20, "only_structural": 13, "only_suspicion": 14,
        "without_lexical": 27, "without_structural": 34, "without_suspicion": 33,
    }
    table = trained[0]
    train, test = table.filter("split = 'train'"), table.filter("split = 'test'")
    one = run_config(
        "random_forest", SMALL["random_forest"], train, train.count(), test, feature_configs()["only_structural"]
    )
    assert one["n_features"] == 13 and 0 <= one["f1"] <= 1
    params = {"boosted_trees": SMALL["boosted_trees"]}
    curve = learning_curve(table, params, (0.5, 1.0))
    got = {r.config: r.train_rows for r in curve.collect()}
    assert got == {"50pct": train.count() // 2, "100pct": train.count()}
    disjoint = checkpointed(domain_disjoint_split(features))
    gap = memorisation_gap(curve.unionByName(split_strategy(disjoint, params))).first()
    assert gap.gap == pytest.approx(gap.random_f1 - gap.disjoint_f1)
    assert marginal_gains(curve).count() == 2


def test_tuning_is_repeatable(trained):
    train = trained[0].filter("split = 'train'")
    kwargs = dict(draws=2, folds=2, rows=300, fixed={"n_estimators": 3, "max_depth": 3})
    a, b = tune("random_forest", train, **kwargs), tune("random_forest", train, **kwargs)
    assert a == b and a.best_f1 == max(f for _, f in a.tried)


def test_stream_equals_batch(spark, sf_dir, trained, tmp_path):
    model = trained[1]["random_forest"]
    raw = raw_urls(spark, sf_dir).select("row_id", "url")
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = scored_stream(model, stream, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = score_urls(model, raw)
    assert got.count() == raw.count() and batch.exceptAll(got.select(batch.columns)).isEmpty()


def test_fresh_model_scores_after_observations(spark, trained):
    table, fitted, _ = trained
    seen = Observation("rows")
    assert table.observe(seen, F.count(F.lit(1)).alias("n")).count() == seen.get["n"]
    for model in fitted.values():
        assert score_urls(model, table.select("url")).filter("p_phish is null").isEmpty()


# -- searches and studies that go on where they broke off --------------------------


class _Broken(Exception):
    pass


def test_a_broken_search_does_only_the_rest(trained, tmp_path, monkeypatch):
    train = trained[0].filter("split = 'train'")
    path = str(tmp_path / "journal")
    options = dict(draws=3, folds=2, rows=300, fixed={"n_estimators": 3, "max_depth": 3}, parallelism=1)
    whole = tune("random_forest", train, **options)
    fit, fits = RandomForestClassifier.fit, []

    def counted(self, *args):
        if len(fits) == stop:
            raise _Broken
        fits.append(1)
        return fit(self, *args)

    monkeypatch.setattr(RandomForestClassifier, "fit", counted)
    stop = 4
    with pytest.raises(_Broken):
        tune("random_forest", train, journal=path, **options)
    assert len(fits) == 4
    stop = None
    assert tune("random_forest", train, journal=path, **options) == whole and len(fits) == 6
    assert tune("random_forest", train, journal=path, **options) == whole and len(fits) == 6
    # other rows are another search
    tune("random_forest", train.filter("length(url) % 2 = 0"), journal=path, **options)
    assert len(fits) == 12


def test_studies_share_one_vector_and_a_journal(spark, trained, tmp_path, monkeypatch):
    table = trained[0]
    params = {"random_forest": {"n_estimators": 3, "max_depth": 3}}
    train, test = table.filter("split = 'train'"), table.filter("split = 'test'")
    n = train.count()

    def without_time(row):
        return {k: v for k, v in row.items() if k != "fit_seconds"}

    direct = {
        config: without_time(run_config("random_forest", params["random_forest"], train, n, test, columns))
        for config, columns in feature_configs().items()
    }
    assembled = []
    transform = VectorAssembler.transform
    monkeypatch.setattr(VectorAssembler, "transform", lambda self, *a: assembled.append(1) or transform(self, *a))
    path = str(tmp_path / "journal")
    rows = {r.config: r.asDict() for r in family_ablation(table, params, path).collect()}
    assert len(assembled) == 1
    assert {c: without_time({k: v for k, v in r.items() if k not in ("study", "config")}) for c, r in rows.items()} == direct
    monkeypatch.setattr(ablation_plans, "run_config", lambda *a: pytest.fail("known already"))
    assert {r.config: r.asDict() for r in family_ablation(table, params, path).collect()} == rows


# -- what a model expects ----------------------------------------------------------


def test_a_model_of_other_lists_is_refused(spark, trained, tmp_path, monkeypatch):
    model = trained[1]["random_forest"]
    acme = Lexicons(brands=("acme",))
    save_model(model, str(tmp_path), "mine", acme, threshold=0.9)
    with pytest.raises(ValueError, match="other lists"):
        load_model(str(tmp_path), "mine")
    loaded = load_model(str(tmp_path), "mine", acme)
    assert loaded.contract["columns"] == list(FEATURE_NAMES) and loaded.contract["threshold"] == 0.9
    urls = urls_frame(spark, CLEAR)
    with pytest.raises(ValueError, match="other lists"):
        score_urls(loaded, urls)
    rows = score_urls(loaded, urls, lexicons=acme).collect()
    assert [r.prediction for r in rows] == [int(r.p_phish >= 0.9) for r in rows]
    rows = score_urls(loaded, urls, threshold=0.1, lexicons=acme).collect()
    assert [r.prediction for r in rows] == [int(r.p_phish >= 0.1) for r in rows]
    monkeypatch.setattr("linksieve.operators.scoring.FEATURE_VERSION", 99)
    with pytest.raises(ValueError, match="version"):
        load_model(str(tmp_path), "mine", acme)


def test_a_model_without_contract_or_with_other_columns_is_refused(spark, trained, tmp_path):
    model = trained[1]["random_forest"]
    model.write().overwrite().save(f"{tmp_path}/bare")
    with pytest.raises(ValueError, match="no contract"):
        load_model(str(tmp_path), "bare")
    assert load_model(str(tmp_path), "bare", lexicons=None).stages
    save_model(model, str(tmp_path), "changed")
    row = spark.read.json(f"{tmp_path}/changed.contract").first()
    other = row.contract.replace('"url_length", "hostname_length"', '"hostname_length", "url_length"')
    assert other != row.contract
    spark.createDataFrame([(other,)], "contract string").write.mode("overwrite").json(f"{tmp_path}/changed.contract")
    with pytest.raises(ValueError, match="other columns"):
        load_model(str(tmp_path), "changed")


# -- tables that repeat URLs -------------------------------------------------------


def test_repeated_urls_are_scored_once(spark, trained, monkeypatch):
    model = trained[1]["random_forest"]
    urls = ["http://hot.com/a/"] * 400 + [f"site{i % 90}.duckdns.org/x{i % 7}" for i in range(800)]
    urls += [None, "", "http://http://x", "x /", "HTTPS://WWW.Example.COM/Path/"]
    df = spark.createDataFrame(list(enumerate(urls)), "row long, address string").repartition(6)
    want = {tuple(r) for r in score_urls(model, df, "address").collect()}
    for common in (1, 1000):
        monkeypatch.setattr(scoring, "COMMON_URLS", common)
        got = score_repeated_urls(model, df, "address")
        rows = got.collect()
        assert len(rows) == len(urls) and {tuple(r) for r in rows} == want
        assert got.columns == ["row", "address", "canonical_url", "p_phish", "prediction"]
    with pytest.raises(ValueError, match="rename"):
        score_repeated_urls(model, df.withColumn("P_phish", F.lit(1)), "address")


def test_a_hot_url_is_not_shuffled(spark, trained, monkeypatch):
    model = trained[1]["random_forest"]
    urls = ["http://hot.com/"] * 3000 + [f"site{i}.org" for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(urls)), "row long, url string").repartition(6)
    monkeypatch.setattr(scoring, "COMMON_URLS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = score_repeated_urls(model, df)
        parts = out.filter("url <> 'x'").groupBy(F.spark_partition_id().alias("p"), "canonical_url").count()
        hot = {r.p: r["count"] for r in parts.filter("canonical_url = 'hot.com'").collect()}
        # the rows of the hot URL stay where they stood, in as many tasks
        assert len(hot) == 6 and max(hot.values()) < 2 * min(hot.values())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
