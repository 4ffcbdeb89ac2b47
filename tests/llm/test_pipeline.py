"""The pipeline against the same five decisions taken one document at a time."""

import numpy as np
import pytest
from test_linking_operators import brute_force
from test_text_operators import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from linksieve.llm import bpe, packing, quality_classifier, quality_rules, secret_scans


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage got and gave."""
    docs, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir).cache()
        found.append((docs.collect(), out.collect(), out.columns))
        docs = out
    return found


def test_stages_keep_the_columns(stages, spark, sf_dir):
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert len(stages) == 5 and all(got == columns for _, _, got in stages[:-1])
    for _, out, _ in stages[1:4]:
        assert all(r.n_chars == len(r.text) for r in out)


def test_classifier_stage(stages, spark, sf_dir):
    given, kept, _ = stages[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ratings = labels.selectExpr("doc_id", "quality + 1 - toxic as grade")
    weights, thresholds = map(np.frombuffer, quality_classifier.train(docs, ratings))
    want = []
    for r in given:
        score = sum(weights[quality_classifier.bucket(f)] for f in quality_classifier.features(r.text))
        if 1 / (1 + np.exp(thresholds[-1] - score)) >= quality_classifier.LEAST_TAIL:
            want.append(r.doc_id)
    assert sorted(r.doc_id for r in kept) == sorted(want)
    assert 0 < len(kept) < len(given)


def test_rules_stage(stages):
    given, kept, _ = stages[1]
    rules = quality_rules.LineRules()
    judged = {r.doc_id: rules.judge(r.text) for r in given}
    assert {r.doc_id: r.text for r in kept} == {i: v[-1] for i, v in judged.items() if v[-2]}


def test_near_duplicate_stage(stages):
    given, kept, _ = stages[2]
    _, component = brute_force([(r.doc_id, r.text) for r in given], 5, 80)
    assert sorted(r.doc_id for r in kept) == sorted(i for i, c in component.items() if i == c)


def test_secret_stage(stages):
    given, out, _ = stages[3]
    efficiency = secret_scans.Efficiency(secret_scans.RANKS)
    texts = {r.doc_id: r.text for r in out}
    assert set(texts) == {r.doc_id for r in given}
    for r in given:
        base = secret_scans.base_spans(r.text)
        spans = secret_scans.ordered(base + efficiency.random_spans(r.text, base))
        assert texts[r.doc_id] == secret_scans.redacted(r.text, spans)
        assert not secret_scans.base_spans(texts[r.doc_id])


def test_packing_stage(stages):
    given, out, _ = stages[4]
    library = Tokenizer.from_file(bpe.VOCABULARY)
    ids = {}
    for r in sorted(out, key=lambda r: (r.doc_id, r.piece)):
        ids[r.doc_id] = ids.get(r.doc_id, b"") + bytes(r.ids)
    for r in given:
        want = [*library.encode(r.text, add_special_tokens=False).ids, packing.END]
        assert np.frombuffer(ids.pop(r.doc_id), "<u4").tolist() == want
    assert not ids
    check_packing(out)


def test_run_gives_the_last_stage(stages, spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.piece, r.length) for r in rows) == sorted((r.doc_id, r.piece, r.length) for r in stages[-1][1])
