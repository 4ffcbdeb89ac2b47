"""Leakage and data-quality diagnostics of a labelled URL corpus."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linksieve.functions.lexicons import DEFAULT_LEXICONS
from linksieve.functions.strings import column, quoted
from linksieve.functions.url_parts import with_url_parts
from linksieve.operators.features import FEATURE_FAMILIES, FEATURE_NAMES
from linksieve.operators.metrics import accumulate, score_counts

# Fixed value: the two single rules the corpus is checked for.
COLLECTION_RULES = {
    "has_scheme": "contains(url, '://')",
    "ends_with_slash": "endswith(url, '/')",
}


def _mean(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def _long(wide: DataFrame, by: Sequence[str], names: Iterable[str], key: str, fields: Sequence[str]) -> DataFrame:
    """Turn one row of columns ``<name>.<field>`` into a row per name."""
    structs = [
        f"named_struct('{key}', {quoted(n)}, " + ", ".join(f"'{f}', {column(f'{n}.{f}')}" for f in fields) + ")"
        for n in names
    ]
    return wide.select(*by, F.expr(f"explode(array({', '.join(structs)}))").alias("r")).select(*by, "r.*")


def _per_feature(features: DataFrame, names: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """One aggregation over all features; ``fields`` are SQL over a column ``{c}``."""
    aggs = [
        F.expr(sql.format(c=column(name))).alias(f"{name}.{field}")
        for name in names
        for field, sql in fields.items()
    ]
    return _long(features.agg(*aggs), (), names, "feature", list(fields))


def rule_audit(
    df: DataFrame, rules: dict[str, str] = COLLECTION_RULES, by: Sequence[str] = ()
) -> DataFrame:
    """D1. How far each rule alone separates the classes.

    Per rule: percent of each class it fires on, accuracy of "fires means
    phishing", and the majority share of the same rows to compare it with. A rule
    about how a URL was collected should not beat that baseline.
    """
    is_phish = F.col("label") == 1
    known = df.filter("url is not null and label is not null")
    fired = known.select(*by, "label", *[F.expr(sql).alias(name) for name, sql in rules.items()])
    aggs = []
    for name in rules:
        fires = F.col(f"`{name}`")
        aggs += [
            (_mean(F.when(is_phish, fires)) * 100).alias(f"{name}.phishing_pct"),
            (_mean(F.when(~is_phish, fires)) * 100).alias(f"{name}.legitimate_pct"),
            (_mean(fires == is_phish) * 100).alias(f"{name}.accuracy_pct"),
            (F.greatest(_mean(is_phish), _mean(~is_phish)) * 100).alias(f"{name}.baseline_pct"),
        ]
    fields = ("phishing_pct", "legitimate_pct", "accuracy_pct", "baseline_pct")
    return _long(fired.groupBy(*by).agg(*aggs), by, rules, "rule", fields)


def rule_search(df: DataFrame, names: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """D1. For every numeric column the single rule that separates the classes best.

    A rule is ``value >= threshold`` or ``value < threshold`` for a value that occurs, and says
    phishing where it fires. Of equally accurate rules the first form comes first, then the lower
    threshold. One pass counts the classes by (column, value); running counts over ranges of
    these, at any number of distinct values, give every threshold's outcome.

    ``feature, direction, threshold``, percent of each class it fires on, accuracy, the majority
    baseline and the gain over it. Rows without a label, and null or NaN values, take no part.
    """
    values = [f"named_struct('feature', {quoted(n)}, 'score', double({column(n)}))" for n in names]
    long = df.filter("label is not null").select(
        "label", F.expr(f"inline(array({', '.join(values)}))")
    )
    points = accumulate(score_counts(long, ["feature"], p="score"), ["feature"])
    tp, fp = F.col("pos_above") + F.col("pos"), F.col("neg_above") + F.col("neg")
    right = tp + F.col("all_neg") - fp
    rows = F.col("all_pos") + F.col("all_neg")
    outcome = [tp.alias("tp"), fp.alias("fp"), F.col("all_pos").alias("pos"), F.col("all_neg").alias("neg")]
    found = points.groupBy("feature").agg(
        F.max(F.struct(right.alias("right"), (-F.col("score")).alias("low"), *outcome)).alias("up"),
        F.max(F.struct((rows - right).alias("right"), (-F.col("score")).alias("low"), *outcome)).alias("down"),
    )
    upward = F.col("up.right") >= F.col("down.right")
    best = found.select("feature", upward.alias("upward"), F.when(upward, F.col("up")).otherwise(F.col("down")).alias("r"))
    fired = {c: F.when(F.col("upward"), F.col(f"r.{c}")).otherwise(F.col(f"r.{n}") - F.col(f"r.{c}"))
             for c, n in (("tp", "pos"), ("fp", "neg"))}
    n = F.col("r.pos") + F.col("r.neg")

    def percent(part: Column, whole: Column) -> Column:
        return F.try_divide(part * 100.0, whole)

    accuracy, baseline = percent(F.col("r.right"), n), percent(F.greatest("r.pos", "r.neg"), n)
    return best.select(
        "feature", F.when(F.col("upward"), ">=").otherwise("<").alias("direction"),
        # minus zero is a zero
        (F.lit(0.0) - F.col("r.low")).alias("threshold"),
        percent(fired["tp"], F.col("r.pos")).alias("phishing_pct"),
        percent(fired["fp"], F.col("r.neg")).alias("legitimate_pct"),
        accuracy.alias("accuracy_pct"), baseline.alias("baseline_pct"),
        (accuracy - baseline).alias("gain_pct"),
    )


def class_balance(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """D2. Rows and share per label, with the accuracy of always guessing the majority."""
    whole = Window.partitionBy(*by)
    counts = df.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        *by, "label", "n",
        (F.col("n") / F.sum("n").over(whole)).alias("share"),
        (F.max("n").over(whole) / F.sum("n").over(whole)).alias("majority_share"),
    )


def with_domain(
    df: DataFrame, name: str = "domain", suffixes: Iterable[str] = DEFAULT_LEXICONS.suffixes
) -> DataFrame:
    """Add the registrable domain of ``url``; addresses have none (empty string).

    ``suffixes`` should be the rules the features were made with: D3, D4 and D8 follow from them.
    """
    parts = with_url_parts(df, "url", "__", suffixes)
    return parts.select(*[F.col(f"`{c}`") for c in df.columns], F.col("__registered").alias(name))


def domain_rates(df: DataFrame) -> DataFrame:
    """D3. Rows and phishing share per domain."""
    return df.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("label") == 1).cast("long")).alias("phishing"),
        _mean(F.col("label") == 1).alias("phishing_share"),
    )


def most_skewed_domains(df: DataFrame, k: int = 20) -> DataFrame:
    """D3. The ``k`` domains furthest from an even mix, larger ones first among equals."""
    skew = F.abs(F.col("phishing_share") - 0.5)
    return domain_rates(df).orderBy(skew.desc(), F.col("n").desc(), "domain").limit(k)


def domain_ceiling(df: DataFrame) -> DataFrame:
    """D4. Accuracy of a model that only remembers each domain's majority label."""
    majority = F.greatest(F.col("phishing"), F.col("n") - F.col("phishing"))
    return domain_rates(df).agg(
        F.count(F.lit(1)).alias("domains"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.try_divide(F.sum(majority), F.sum("n")).alias("ceiling"),
    )


def fire_rates(features: DataFrame, names: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """D5. Share of rows where a feature is not 0; constant features are flagged."""
    fields = {"fire_share": "avg(double({c} <> 0))", "is_constant": "min({c}) = max({c})"}
    return _per_feature(features, names, fields)


def contract_check(features: DataFrame, names: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """D7. Per feature, the rows that are null, NaN or infinite; all should be 0.

    Raises when the table's feature columns differ from ``names`` in name, order
    or type, which is wrong whatever the rows hold.
    """
    present = [(f.name, f.dataType) for f in features.schema.fields if f.name in set(names)]
    if present != [(name, T.FloatType()) for name in names]:
        raise ValueError("feature columns must be exactly the expected ones, in order, as floats")
    fields = {
        "nulls": "count_if({c} IS NULL)",
        "nans": "count_if(isnan({c}))",
        "infinities": "count_if(abs({c}) = double('Infinity'))",
    }
    return _per_feature(features, names, fields)


def domain_overlap(df: DataFrame, tested: str = "test", trained: str = "train") -> DataFrame:
    """D8. Share of ``tested`` rows whose domain also has ``trained`` rows.

    One pre-aggregated pass per domain tells both sides, so no rows are joined on
    a domain that may hold a third of them.
    """
    by_domain = df.groupBy("domain").agg(
        F.sum((F.col("split") == tested).cast("long")).alias("tested"),
        F.max(F.col("split") == trained).alias("seen"),
    )
    shared = F.sum(F.when(F.col("seen"), F.col("tested")).otherwise(0))
    return by_domain.agg(
        F.coalesce(F.sum("tested"), F.lit(0)).alias("tested_rows"),
        F.coalesce(shared, F.lit(0)).alias("shared_rows"),
        F.try_divide(shared, F.sum("tested")).alias("overlap_share"),
    )


def family_shares(importance: DataFrame) -> DataFrame:
    """D6. Importance of each feature family per model.

    ``importance`` has ``model, feature, importance``; ``top_share`` is what a
    family holds among the model's three strongest features.
    """
    family_of = [(f, family) for family, names in FEATURE_FAMILIES.items() for f in names]
    families = importance.sparkSession.createDataFrame(family_of, "feature string, family string")
    strongest = Window.partitionBy("model").orderBy(F.col("importance").desc(), "feature")
    return (
        importance.withColumn("place", F.row_number().over(strongest))
        .join(F.broadcast(families), "feature")
        .groupBy("model", "family")
        .agg(
            F.sum("importance").alias("share"),
            F.sum(F.when(F.col("place") <= 3, F.col("importance")).otherwise(0.0)).alias("top_share"),
        )
    )


def marginal_gains(curve: DataFrame, metric: str = "f1") -> DataFrame:
    """D6. Change of ``metric`` from each learning-curve point to the next."""
    steps = Window.partitionBy("model").orderBy("train_rows")
    return curve.select(
        "model", "train_rows", metric,
        (F.col(metric) - F.lag(metric).over(steps)).alias("gain"),
    )
