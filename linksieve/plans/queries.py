"""Ready-made queries over the test tables, one per operator or group of them.

Every query reads whole tables. Real-valued results are rounded so that another
engine can be compared on them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linksieve.functions import canonical as C
from linksieve.functions.lexicons import Lexicons
from linksieve.functions.url_parts import PART_NAMES, with_url_parts
from linksieve.functions.words import word_list
from linksieve.operators import diagnostics as D
from linksieve.operators import metrics as M
from linksieve.operators import splits as L
from linksieve.operators.corpus import (
    canonical_urls,
    clean_corpus,
    cleaning_audit,
    distinct_pairs,
    drop_empty,
)
from linksieve.operators.features import FEATURE_FAMILIES, FEATURE_NAMES, with_features
from linksieve.operators.models import BUILDERS, fitted_as
from linksieve.operators.scoring import (
    feature_importance,
    featurize,
    importance_table,
    score_repeated_urls,
    score_urls,
    top_features,
    verdicts,
)
from linksieve.operators.tuning import tune
from linksieve.plans import ablation as A
from linksieve.plans.evaluate import evaluate_models
from linksieve.plans.sample_corpus import many_raw_urls, pages, raw_urls, table
from linksieve.plans.train import train_models
from linksieve.session import checkpointed, ensure_checkpoint_dir, scratch_path
from linksieve.sources.corpus_state import CorpusState
from linksieve.sources.features import load_features
from linksieve.sources.models import load_model, save_model
from linksieve.sources.reports import read_best_params, rounded
from linksieve.sources.urls import (
    load_corpus,
    load_raw,
    read_corpus_csv,
    write_corpus_csv,
)

DIGITS = 6
WANTED_PRECISIONS = (0.4, 0.45, 0.5, 0.6, 0.75, 0.9, 1.0)
Query = Callable[[SparkSession, str], DataFrame]

# Parameters small enough for a test run; the builders' defaults are the real ones.
QUICK = {
    "random_forest": {"n_estimators": 10, "max_depth": 5},
    "boosted_trees": {"n_estimators": 5, "max_depth": 3},
}


REAL_FEATURES = {
    "path_to_url_ratio", "digit_letter_ratio", "domain_entropy", "url_entropy", "vowel_ratio_domain",
}


def _doubles(df: DataFrame, keys: Iterable[str], names: Iterable[str]) -> DataFrame:
    """Features as doubles; those that are not whole numbers are rounded."""

    def value(name: str) -> Column:
        double = F.col(name).cast("double")
        return F.round(double, DIGITS) if name in REAL_FEATURES else double

    return df.select(*keys, *[value(n).alias(n) for n in names])


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean corpus as a materialised table, as split operators read it repeatedly."""
    return checkpointed(clean_corpus(raw_urls(spark, sf_dir)))


def rule_score(features: DataFrame) -> DataFrame:
    """A fixed score in 512ths from a few features, so that any engine gets the same.

    Stands in for a model's probability where metrics are checked exactly.
    """
    points = (
        F.col("num_suspicious_keywords") * 24
        + F.col("has_suspicious_tld") * 32
        + F.col("brand_domain_mismatch") * 24
        + F.col("is_free_hosting") * 40
        + F.col("has_ip_host") * 24
        + F.col("url_length")
    )
    p = points.cast("double") / 512
    return features.select(
        "url", "label", p.alias("p_phish"), (p >= 0.125).cast("int").alias("prediction")
    )


def hashed_score(urls: DataFrame) -> DataFrame:
    """A fixed score in 2^-24ths, nearly one per URL: its length, and digits of its md5."""
    digits = F.conv(F.substring(F.md5("url"), 1, 4), 16, 10).cast("long")
    p = (F.length("url") * 65536 + digits).cast("double") / (1 << 24)
    return urls.select("url", "label", p.alias("p_phish"), (p >= 0.125).cast("int").alias("prediction"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_score(with_features(clean_corpus(raw_urls(spark, sf_dir))))


def _scored_by_scheme(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows scored, with their scheme as a grouping column."""
    raw = with_url_parts(raw_urls(spark, sf_dir)).select("url", "label", "scheme")
    features = with_features(raw)
    scored = rule_score(features.withColumn("url", F.struct("url", "scheme")))
    return scored.select(F.col("url.scheme").alias("scheme"), "label", "p_phish", "prediction")


# -- sources and cleaning ------------------------------------------------------


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1. Two stored shards with extra columns, read back as one pruned table."""
    raw = raw_urls(spark, sf_dir)
    paths = []
    for part in (0, 1):
        path = scratch_path(spark, f"shard{part}")
        raw.filter(F.pmod("row_id", F.lit(2)) == part).write.parquet(path)
        paths.append(path)
    return load_raw(spark, *paths)


def canonical_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1-C5 with every step shown."""
    steps = raw_urls(spark, sf_dir).select("row_id", "url", C.trim_whitespace(F.col("url")).alias("trimmed"))
    steps = steps.withColumn("bare", C.strip_scheme(F.col("trimmed")))
    steps = steps.withColumn("unslashed", C.strip_trailing_slashes(F.col("bare")))
    return steps.withColumn("canonical", C.lower_host(F.col("unslashed")))


def nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_empty(canonical_urls(raw_urls(spark, sf_dir)))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_pairs(drop_empty(canonical_urls(raw_urls(spark, sf_dir))))


def corpus_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_corpus(raw_urls(spark, sf_dir))


def corpus_clean_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_corpus(many_raw_urls(spark, sf_dir))


def corpus_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cleaning_audit(raw_urls(spark, sf_dir)), DIGITS)


def corpus_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2. Build if missing, then read the stored Parquet table."""
    path = scratch_path(spark, "corpus")
    return load_corpus(spark, path, lambda: clean_corpus(raw_urls(spark, sf_dir)))


def corpus_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2. The CSV form, written and read back."""
    path = scratch_path(spark, "corpus-csv")
    write_corpus_csv(clean_corpus(raw_urls(spark, sf_dir)), path)
    return read_corpus_csv(spark, path)


# -- parts and features --------------------------------------------------------


def _parts(df: DataFrame, key: str) -> DataFrame:
    joined = {n: F.array_join(F.col(n), "|") for n in ("host_parts", "segments")}
    return with_url_parts(df).select(key, *[joined.get(n, F.col(n)).alias(n) for n in PART_NAMES])


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(raw_urls(spark, sf_dir), "row_id")


def page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(pages(spark, sf_dir), "page_id")


def family_features(family: str) -> Query:
    names = FEATURE_FAMILIES[family]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _doubles(with_features(raw_urls(spark, sf_dir), features=names), ["row_id"], names)

    return run


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX over one URL per line item."""
    return _doubles(with_features(many_raw_urls(spark, sf_dir)), ["row_id"], FEATURE_NAMES)


def corpus_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5-C8 + FX in one go: raw rows to the features of the clean corpus, one shuffle."""
    corpus = clean_corpus(many_raw_urls(spark, sf_dir))
    return _doubles(with_features(corpus), ["url", "label"], FEATURE_NAMES)


def page_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + FX. All features of the page URLs in canonical form."""
    return _doubles(
        featurize(pages(spark, sf_dir)), ["page_id", "canonical_url"], FEATURE_NAMES
    )


def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3. The stored feature table, asked for twice and computed once."""
    corpus = _corpus(spark, sf_dir)
    path = scratch_path(spark, "features")
    load_features(corpus, path)
    return _doubles(load_features(corpus, path), ["url", "label"], FEATURE_NAMES)


#: S3. Rows that the second version of the test corpus changes, drops or adds.
_CHANGED, _DROPPED, _ADDED = ("url LIKE '%77%'", "url LIKE '%88%'", "url LIKE '%99%'")


def feature_store_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3. A stored feature table brought up to date with a corpus that differs in some buckets."""
    corpus = _corpus(spark, sf_dir)
    path = scratch_path(spark, "features-delta")
    older = corpus.filter(f"NOT ({_ADDED})").withColumn(
        "label", F.when(F.expr(_CHANGED), 1 - F.col("label")).otherwise(F.col("label")).cast("byte")
    )
    load_features(older, path)
    newer = corpus.filter(f"NOT ({_DROPPED})")
    return _doubles(load_features(newer, path), ["url", "label"], FEATURE_NAMES)


def _merged_shards(spark: SparkSession, sf_dir: str) -> CorpusState:
    """C7-C9. Three shards merged one after the other, one of them twice."""
    raw = raw_urls(spark, sf_dir)
    state = CorpusState(spark, scratch_path(spark, "corpus-state"), buckets=8)
    for part in (0, 1, 2, 1):
        state.merge(raw.filter(F.pmod("row_id", F.lit(3)) == part), f"shard-{part}")
    return state


def corpus_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_shards(spark, sf_dir).corpus()


def corpus_merge_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_merged_shards(spark, sf_dir).audit(), DIGITS)


#: P11. Suffix rules of one to four labels, with wildcards and exceptions.
SUFFIX_RULES = (
    "com", "org", "uk", "duckdns.org", "*.co.uk", "!shop1007.co.uk", "!www.shop23.co.uk", "google.com",
    "sites.google.com", "*.wikipedia.org", "*.verify-account.top", "en.wikipedia.org.test",
    "mail.sites.google.com", "*.mail.paypal.com",
)


def _mail_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean corpus, half of it with one more label in front of the host."""
    corpus = clean_corpus(raw_urls(spark, sf_dir))
    return corpus.withColumn("url", F.expr("if(length(url) % 2 = 0, concat('mail.', url), url)"))


def suffix_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11. Parts that depend on the suffix, by rules of any depth."""
    parts = with_url_parts(_mail_hosts(spark, sf_dir), suffixes=SUFFIX_RULES)
    return parts.select("url", "host", "registered", "subdomain")


def suffix_rule_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3. Rates by domain under the same rules."""
    return rounded(D.domain_rates(D.with_domain(_mail_hosts(spark, sf_dir), suffixes=SUFFIX_RULES)), DIGITS)


def keyword_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F35, F37 with lists of thousands of words: four and five digits of hashed keys."""
    keys = F.md5(F.col("o_orderkey").cast("string"))
    orders = table(spark, sf_dir, "orders")
    lexicons = Lexicons(
        keywords=word_list(orders.select(F.substring(keys, 1, 4).alias("word")), "word"),
        brands=word_list(orders.select(F.substring(keys, 7, 5).alias("word")), "word"),
    )
    names = ["num_suspicious_keywords", "brand_domain_mismatch"]
    return _doubles(with_features(raw_urls(spark, sf_dir), features=names, lexicons=lexicons), ["row_id"], names)


# -- splits --------------------------------------------------------------------


def split_train_val_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.make_splits(_corpus(spark, sf_dir))


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3. A sample of 500 rows, the sampling operator itself."""
    return L.stratified_sample(_corpus(spark, sf_dir), 500)


def curve_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.with_curve_step(_corpus(spark, sf_dir))


def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.with_folds(_corpus(spark, sf_dir))


def split_domain_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.domain_disjoint_split(_corpus(spark, sf_dir))


# -- metrics -------------------------------------------------------------------


def metrics_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.binary_metrics(_scored(spark, sf_dir)), DIGITS)


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.roc_auc(_scored(spark, sf_dir)), DIGITS)


def _scored_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed_score(clean_corpus(many_raw_urls(spark, sf_dir)))


def roc_auc_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 over one URL per line item, nearly all scores distinct."""
    return rounded(M.roc_auc(_scored_many(spark, sf_dir)), DIGITS)


def roc_curve_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 over one URL per line item, nearly all scores distinct."""
    return rounded(M.roc_curve(_scored_many(spark, sf_dir)), DIGITS)


def metrics_by_scheme(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.score_metrics(_scored_by_scheme(spark, sf_dir), ["scheme"]), DIGITS)


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.confusion_matrix(_scored(spark, sf_dir)), DIGITS)


def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.roc_curve(_scored(spark, sf_dir)), DIGITS)


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(M.threshold_sweep(_scored(spark, sf_dir)), DIGITS)


def threshold_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8. Thresholds for wanted precisions among nearly as many scores as URLs."""
    return rounded(M.threshold_choice(_scored_many(spark, sf_dir), WANTED_PRECISIONS), DIGITS)


def verdict_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(_scored(spark, sf_dir))


# -- diagnostics ---------------------------------------------------------------


def rule_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1. Both collection rules, before and after canonicalisation."""
    raw = raw_urls(spark, sf_dir).select("url", "label", F.lit("raw").alias("form"))
    clean = clean_corpus(raw_urls(spark, sf_dir)).withColumn("form", F.lit("clean"))
    return rounded(D.rule_audit(raw.unionByName(clean), by=["form"]), DIGITS)


def rule_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1. The best single rule of every feature, and of both collection rules, on raw rows."""
    raw = raw_urls(spark, sf_dir).filter("url is not null").select("url", "label")
    ruled = raw.withColumns({name: F.expr(sql).cast("int") for name, sql in D.COLLECTION_RULES.items()})
    values = _doubles(with_features(ruled), ["label", *D.COLLECTION_RULES], FEATURE_NAMES)
    return rounded(D.rule_search(values, [*FEATURE_NAMES, *D.COLLECTION_RULES]), DIGITS)


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.class_balance(L.make_splits(_corpus(spark, sf_dir)), ["split"]), DIGITS)


def domain_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.domain_rates(D.with_domain(clean_corpus(raw_urls(spark, sf_dir)))), DIGITS)


def skewed_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3. The twenty most one-sided domains."""
    domains = D.with_domain(clean_corpus(raw_urls(spark, sf_dir)))
    return rounded(D.most_skewed_domains(domains, 20), DIGITS)


def domain_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.domain_ceiling(D.with_domain(clean_corpus(raw_urls(spark, sf_dir)))), DIGITS)


def fire_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.fire_rates(with_features(clean_corpus(raw_urls(spark, sf_dir)))), DIGITS)


def feature_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.contract_check(with_features(raw_urls(spark, sf_dir)))


def domain_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(D.domain_overlap(D.with_domain(L.make_splits(_corpus(spark, sf_dir)))), DIGITS)


# -- models --------------------------------------------------------------------
#
# A fit has no counterpart in SQL, so these queries return what can be known beforehand of its
# results: which rows and columns took part, and whether every figure keeps its promises.


def _is_share(*names: str) -> Column:
    """Whether all these columns lie in 0..1 and none is null."""
    inside = F.lit(True)
    for name in names:
        inside &= F.coalesce(F.col(name).between(0, 1), F.lit(False))
    return inside


RATES = ("accuracy", "precision", "recall", "f1", "roc_auc")


def _fitted(split: DataFrame) -> dict:
    ensure_checkpoint_dir(split.sparkSession)
    train = split.filter("split = 'train'")
    return {n: BUILDERS[n](**QUICK[n]).fit(train) for n in BUILDERS}


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with its random split, made and stored once."""
    return checkpointed(L.make_splits(with_features(_corpus(spark, sf_dir))))


def training_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + M6 + S4-S6. Tune, refit, validate and store both models; what the report says of them."""
    report, folder = scratch_path(spark, "best-params"), scratch_path(spark, "models")
    train_models(_split(spark, sf_dir), folder, report, fixed=QUICK, draws=2, folds=2)
    stored = read_best_params(spark, report, BUILDERS)
    same = {n: fitted_as(load_model(folder, n), n, stored[n]) for n in BUILDERS}
    return spark.read.json(report).select(
        "model", "n_train", "n_val", "n_test", "n_features",
        F.element_at(F.create_map(*[F.lit(x) for pair in same.items() for x in pair]), F.col("model")).alias("reported_is_fitted"),
        _is_share("best_f1", *RATES).alias("rates_ok"),
        (F.col("roc_auc") > 0.7).alias("better_than_chance"),
    )


def tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 + M5. Every setting tried for the forest, within its space and with a mean F1."""
    pinned = {"n_estimators": 5, "max_depth": 4}
    result = tune("random_forest", _split(spark, sf_dir).filter("split = 'train'"), draws=3, fixed=pinned)
    rows = [
        (
            i,
            all(params[k] == v for k, v in pinned.items())
            and 2 <= params["min_samples_split"] < 12
            and 1 <= params["min_samples_leaf"] < 5
            and params["max_features"] in ("sqrt", "log2", 0.4),
            0 < f1 <= 1,
            f1 <= result.best_f1,
        )
        for i, (params, f1) in enumerate(result.tried)
    ]
    return spark.createDataFrame(rows, "draw int, in_space boolean, f1_ok boolean, best_is_best boolean")


def scored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 + S4. Page URLs scored by a stored and reloaded model."""
    folder = scratch_path(spark, "models")
    save_model(_fitted(_split(spark, sf_dir))["boosted_trees"], folder, "boosted_trees")
    scored = score_urls(load_model(folder), pages(spark, sf_dir))
    return scored.select(
        "page_id", "canonical_url", _is_share("p_phish").alias("p_ok"),
        (F.col("prediction") == (F.col("p_phish") >= 0.5).cast("int")).alias("prediction_ok"),
    )


def scored_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7. A table in which one URL holds a third of the rows: scored by URL, and row by row."""
    model = _fitted(_split(spark, sf_dir))["boosted_trees"]
    hot = F.when(F.pmod("row_id", F.lit(3)) == 0, F.lit("https://github.com/")).otherwise(F.col("url"))
    urls = raw_urls(spark, sf_dir).select("row_id", hot.alias("url"))
    by_row = score_urls(model, urls).select("row_id", F.struct("p_phish", "prediction").alias("by_row"))
    by_url = score_repeated_urls(model, urls).join(by_row, "row_id")
    same = F.struct("p_phish", "prediction") == F.col("by_row")
    return by_url.select("row_id", "canonical_url", same.alias("same"))


def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7 + E6. Both models on the balanced test rows."""
    split = _split(spark, sf_dir)
    result = evaluate_models(_fitted(split), split)
    cells = result.confusion.groupBy("model").agg(
        F.sum("n").alias("tested"),
        F.sum(F.when(F.col("actual") == 1, F.col("n"))).alias("positives"),
    )
    points = result.roc.groupBy("model").agg(
        (F.min("fpr") + F.min("tpr") == 0).alias("starts_at_0"), (F.max("fpr") + F.max("tpr") == 2).alias("ends_at_1")
    )
    return result.comparison.join(cells, "model").join(points, "model").select(
        "model", "tested", "positives", "starts_at_0", "ends_at_1",
        _is_share(*RATES).alias("rates_ok"), (F.col("roc_auc") > 0.7).alias("better_than_chance"),
    )


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = _fitted(_split(spark, sf_dir))
    frames = [feature_importance(model, name, spark) for name, model in models.items()]
    return frames[0].unionByName(frames[1])


def importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5. A row per feature; the weights of each model are shares."""
    table = importance_table(_importance(spark, sf_dir), list(BUILDERS))
    total = Window.partitionBy()
    sums = [F.abs(F.sum(m).over(total) - 1) < 1e-3 for m in BUILDERS]
    return table.select("feature", _is_share(*BUILDERS).alias("weights_ok"), (sums[0] & sums[1]).alias("sums_ok"))


def strongest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5. The places of each model's strongest features, in order of weight."""
    order = Window.partitionBy("model").orderBy("place")
    falling = F.col("importance") <= F.coalesce(F.lag("importance").over(order), F.lit(1.0))
    return top_features(_importance(spark, sf_dir)).select("model", "place", falling.alias("falling"))


def _fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances that SQL can compute: how often a feature fires, on two sources of URLs."""
    parts = [
        D.fire_rates(with_features(urls)).select(
            F.lit(name).alias("model"), "feature", F.col("fire_share").alias("importance")
        )
        for name, urls in (("corpus", clean_corpus(raw_urls(spark, sf_dir))), ("pages", pages(spark, sf_dir)))
    ]
    return parts[0].unionByName(parts[1])


def importance_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 on importances that SQL can compute."""
    return importance_table(_fires(spark, sf_dir), ["corpus", "pages"])


def importance_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5. The twenty strongest of each, on importances that SQL can compute."""
    return rounded(top_features(_fires(spark, sf_dir)), DIGITS)


def family_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 on importances that SQL can compute."""
    return rounded(D.family_shares(_fires(spark, sf_dir)), DIGITS)


def family_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 on fitted models: shares of the families, which sum to one."""
    shares = D.family_shares(_importance(spark, sf_dir))
    total = F.sum("share").over(Window.partitionBy("model"))
    return shares.select(
        "model", "family", (F.abs(total - 1) < 1e-6).alias("sums_ok"),
        (F.col("top_share") <= F.col("share") + 1e-9).alias("top_ok"),
    )


def _checked(results: DataFrame) -> DataFrame:
    return results.select(
        "study", "config", "model", "n_features", "train_rows",
        _is_share(*RATES).alias("rates_ok"), (F.col("fit_seconds") > 0).alias("timed"),
    )


def _disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpointed(L.domain_disjoint_split(with_features(_corpus(spark, sf_dir))))


def family_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A3. Every feature set with both models."""
    return _checked(A.family_ablation(_split(spark, sf_dir), QUICK))


def learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + D6. Learning curve; gains add up to the whole way."""
    curve = checkpointed(D.marginal_gains(A.learning_curve(_split(spark, sf_dir), QUICK)))
    steps = Window.partitionBy("model")
    first, last = (F.max_by("f1", sign * F.col("train_rows")).over(steps) for sign in (-1, 1))
    gained = F.coalesce(F.sum("gain").over(steps), F.lit(0.0))
    return curve.select("model", "train_rows", (F.abs(last - first - gained) < 1e-9).alias("gains_ok"))


def split_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5. Random against domain-disjoint split."""
    full = A.learning_curve(_split(spark, sf_dir), QUICK, (1.0,))
    gap = A.memorisation_gap(full.unionByName(A.split_strategy(_disjoint(spark, sf_dir), QUICK)))
    return gap.select(
        "model", (F.col("gap") == F.col("random_f1") - F.col("disjoint_f1")).alias("gap_ok"),
        _is_share("random_f1", "disjoint_f1").alias("f1_ok"),
    )


def ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6. All 24 fits."""
    return _checked(A.ablation(_split(spark, sf_dir), _disjoint(spark, sf_dir), QUICK))


QUERIES: dict[str, Query] = {
    "shards": shards,
    "canonical_steps": canonical_steps,
    "nonempty_urls": nonempty,
    "distinct_pairs": pairs,
    "corpus_clean": corpus_clean,
    "corpus_clean_many": corpus_clean_many,
    "corpus_audit": corpus_audit,
    "corpus_store": corpus_store,
    "corpus_csv": corpus_csv,
    "url_parts": url_parts,
    "page_parts": page_parts,
    "features_lexical": family_features("lexical"),
    "features_structural": family_features("structural"),
    "features_suspicion": family_features("suspicion"),
    "feature_table": feature_table,
    "corpus_features": corpus_features,
    "page_features": page_features,
    "feature_store": feature_store,
    "feature_store_delta": feature_store_delta,
    "corpus_merge": corpus_merge,
    "corpus_merge_audit": corpus_merge_audit,
    "suffix_rules": suffix_rules,
    "suffix_rule_domains": suffix_rule_domains,
    "keyword_scan": keyword_scan,
    "split_train_val_test": split_train_val_test,
    "stratified_sample": stratified_sample,
    "curve_steps": curve_steps,
    "kfold": folds,
    "split_domain_disjoint": split_domain_disjoint,
    "metrics_binary": metrics_binary,
    "metrics_by_scheme": metrics_by_scheme,
    "roc_auc": roc_auc,
    "roc_auc_many": roc_auc_many,
    "confusion": confusion,
    "roc_curve": roc_curve,
    "roc_curve_many": roc_curve_many,
    "threshold_sweep": threshold_sweep,
    "threshold_choice": threshold_choice,
    "verdicts": verdict_rows,
    "rule_audit": rule_audit,
    "rule_search": rule_search,
    "class_balance": class_balance,
    "domain_rates": domain_rates,
    "skewed_domains": skewed_domains,
    "domain_ceiling": domain_ceiling,
    "fire_rates": fire_rates,
    "feature_contract": feature_contract,
    "domain_overlap": domain_overlap,
    "tuning": tuning,
    "training_summary": training_summary,
    "scored_pages": scored_pages,
    "scored_repeats": scored_repeats,
    "evaluation": evaluation,
    "importances": importances,
    "strongest_features": strongest_features,
    "importance_pivot": importance_pivot,
    "importance_top": importance_top,
    "family_fires": family_fires,
    "family_importance": family_importance,
    "family_ablation": family_ablation,
    "learning_curve": learning_curve,
    "split_strategy": split_strategy,
    "ablation": ablation,
}
