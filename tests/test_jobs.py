import pytest

from linksieve.operators.models import BUILDERS
from linksieve.plans import jobs as J
from linksieve.plans.sample_corpus import pages, raw_urls

QUICK = {
    "random_forest": {"n_estimators": 4, "max_depth": 4},
    "boosted_trees": {"n_estimators": 3, "max_depth": 3},
}


def test_jobs_end_to_end(spark, tmp_path, sf_dir):
    raw, folder = str(tmp_path / "raw"), str(tmp_path / "work")
    raw_urls(spark, "/root/testdata/sf0.01").write.parquet(raw)
    assert J.corpus_job(spark, folder, raw).count() == 1049
    assert spark.read.json(f"{folder}/reports/corpus_audit").first().raw_rows == 15000
    J.features_job(spark, folder)
    J.splits_job(spark, folder)
    plan = J.split_table(spark, folder).filter("split = 'train'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    summary = J.train_job(spark, folder, fixed=QUICK, draws=1, folds=2)
    assert [s["model"] for s in summary] == list(BUILDERS)
    assert J.evaluate_job(spark, folder).count() == 2
    split = spark.read.json(f"{folder}/reports/test_split").first()
    assert split.phishing_fraction == 0.5 and split.n == summary[0]["n_test"]
    results = J.ablation_job(spark, folder)
    rows = results.collect()
    assert len(rows) == 24
    assert {r.study for r in rows} == {"feature_group", "training_size", "split_strategy"}
    stored = spark.read.csv(f"{folder}/reports/ablation_results", header=True)
    assert stored.count() == 24 and stored.columns == results.columns
    J.score_job(spark, folder, pages(spark, sf_dir), str(tmp_path / "scored"))
    scored = spark.read.parquet(str(tmp_path / "scored"))
    assert scored.count() == 50 and scored.columns == ["verdict", "p", "url"]


def test_missing_model_names_the_train_step(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="train"):
        J.evaluate_job(spark, str(tmp_path))
