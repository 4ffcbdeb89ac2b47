"""From raw labelled URLs to a clean corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linksieve.functions.canonical import canonicalize


def canonical_urls(raw: DataFrame, url: str = "url") -> DataFrame:
    """C5. Replace column ``url`` by its canonical form."""
    return raw.withColumn(url, canonicalize(F.col(url)))


def drop_empty(df: DataFrame, url: str = "url") -> DataFrame:
    """C6. Keep rows that still have a URL after canonicalisation."""
    return df.filter(F.length(url) > 0)


def distinct_pairs(df: DataFrame) -> DataFrame:
    """C7. One row per (url, label)."""
    return df.select("url", "label").dropDuplicates(["url", "label"])


def url_groups(raw: DataFrame) -> DataFrame:
    """One row per canonical URL with its number of rows and lowest and highest label.

    Everything the cleaning steps and their audit need, from a single shuffle.
    Rows are pre-aggregated per task, so a URL (or the empty string, which
    gathers all missing URLs) may hold any share of the rows.

    The empty string gets no label. So dropping it is a test on an aggregate,
    which the optimizer cannot move below the shuffle, where it would canonicalise
    every URL a second time.
    """
    canonical = raw.select(
        F.coalesce(canonicalize(F.col("url")), F.lit("")).alias("url"),
        F.col("label").cast("byte").alias("label"),
    )
    label = F.when(F.col("url") != "", F.col("label"))
    return canonical.groupBy("url").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(label).alias("labelled"),
        F.min(label).alias("low"),
        F.max(label).alias("high"),
    )


def unanimous(groups: DataFrame) -> DataFrame:
    """C8. The URLs whose rows all carry one label, with that label."""
    agreed = groups.filter(F.col("low") == F.col("high"))
    return agreed.select("url", F.col("low").alias("label"))


def clean_corpus(raw: DataFrame) -> DataFrame:
    """C5-C8. One ``url, label`` row per canonical URL.

    Missing and empty URLs go, copies collapse to one row, and a URL seen with
    both labels goes altogether, as no label can be right for it.
    """
    return unanimous(url_groups(raw))


def _audit_counts() -> list[Column]:
    single = F.col("low") == F.col("high")
    conflict = F.col("low") != F.col("high")

    def total(value, condition=F.lit(True)):
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("long")

    copies = F.col("labelled") - F.when(conflict, 2).when(single, 1).otherwise(0)
    return [
        total(F.col("rows")).alias("raw_rows"),
        total(F.col("rows") - F.col("labelled")).alias("missing_rows"),
        total(copies).alias("duplicate_rows"),
        total(F.lit(2), conflict).alias("conflict_rows"),
        total(F.lit(1), single).alias("final_rows"),
        total(F.lit(1), single & (F.col("low") == 0)).alias("legitimate_rows"),
        total(F.lit(1), single & (F.col("low") == 1)).alias("phishing_rows"),
    ]


def _with_shares(counts: DataFrame) -> DataFrame:
    def percent(name: str) -> Column:
        share = F.try_divide(F.col(name) * 100.0, F.col("final_rows"))
        return F.coalesce(share, F.lit(0.0))

    return counts.withColumns(
        {
            "legitimate_pct": percent("legitimate_rows"),
            "phishing_pct": percent("phishing_rows"),
        }
    )


def audit(groups: DataFrame) -> DataFrame:
    """C9. One row that accounts for every raw row behind :func:`url_groups`.

    raw = missing + duplicates + conflicts + final; ``conflict_rows`` counts the
    rows left after removal of copies, two per URL with both labels. Rows without
    a label are part of ``missing_rows``.
    """
    return _with_shares(groups.agg(*_audit_counts()))


def cleaning_audit(raw: DataFrame) -> DataFrame:
    """C9. The audit of raw rows."""
    return audit(url_groups(raw))
