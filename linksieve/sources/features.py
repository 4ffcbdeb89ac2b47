"""Stored feature table, kept up to date bucket by bucket (S3).

URLs are dealt into buckets by their hash. The current version names, for every bucket, the
digest of the ``url, label`` rows its features were made from and the folder that holds them. One
scan of the corpus tells which digests differ; only those buckets are computed, into a folder of
their own, and a new version points to them and to the untouched rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linksieve.functions.lexicons import DEFAULT_LEXICONS, Lexicons
from linksieve.operators.features import FEATURE_NAMES, FEATURE_VERSION, with_features
from linksieve.sources.versions import current, fresh_name, publish

#: Choose so many that one bucket is worth a rebuild: a changed row rewrites its bucket.
BUCKETS = 64
#: A bucket of more rows is written by several tasks.
ROWS_PER_FILE = 1_000_000


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(buckets)).cast("int")


def _stamp(corpus: DataFrame, lexicons: Lexicons, buckets: int) -> dict:
    """What all buckets of a version have in common."""
    return {
        "feature_version": FEATURE_VERSION,
        "lexicons": lexicons.fingerprint(),
        "columns": list(FEATURE_NAMES),
        "label": corpus.schema["label"].dataType.simpleString(),
        "buckets": buckets,
    }


def bucket_digests(corpus: DataFrame, buckets: int = BUCKETS) -> dict[int, list]:
    """Rows and digest of every bucket that has rows; a row per bucket reaches the driver.

    A digest adds up two hashes of each row as decimals, so it depends on the rows only, not
    on their order, and cannot overflow.
    """
    sums = [
        F.sum(F.xxhash64(F.lit(salt), "url", "label").cast("decimal(38,0)")).cast("string")
        for salt in ("one", "two")
    ]
    found = (
        corpus.groupBy(_bucket(buckets).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"), F.concat_ws(" ", *sums).alias("digest"))
        .collect()
    )
    return {r["bucket"]: [r["rows"], r["digest"]] for r in found}


def _folders(path: str, version: dict) -> list[str]:
    return [f"{path.rstrip('/')}/data/{folder}/bucket={b}" for b, (_, _, folder) in sorted(version["at"].items())]


def read_features(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """S3. The current version of the stored table, or an earlier one."""
    found = current(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no feature table at {path}" + (f", version {version}" if version else ""))
    empty = spark.createDataFrame([], f"url string, label {found['label']}")
    schema = with_features(empty, features=found["columns"]).schema
    folders = _folders(path, found)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def load_features(
    corpus: DataFrame,
    path: str,
    rebuild: bool = False,
    lexicons: Lexicons = DEFAULT_LEXICONS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """S3. ``url, label`` and the features of ``corpus``, computed once and then reread.

    Buckets are reused whose rows and content digest match, if feature version, lexicons,
    column names, label type and number of buckets do. Frames read before keep the version
    they were opened on. An interrupted build is never taken for a finished one.
    """
    spark = corpus.sparkSession
    corpus = corpus.select("url", "label")
    stamp = _stamp(corpus, lexicons, buckets)
    before = current(spark, path)
    same = before is not None and all(before[k] == v for k, v in stamp.items()) and not rebuild
    stored = before["at"] if same else {}
    digests = bucket_digests(corpus, buckets)
    kept = {b: stored[str(b)] for b, d in digests.items() if stored.get(str(b), [None] * 3)[:2] == d}
    changed = sorted(set(digests) - set(kept))
    if same and not changed and len(kept) == len(stored):
        return read_features(spark, path)
    folder = fresh_name()
    if changed:
        dealt = corpus.withColumn("bucket", _bucket(buckets))
        if len(changed) < len(digests):
            dealt = dealt.filter(F.col("bucket").isin(changed))
        parts = -(-max(digests[b][0] for b in changed) // ROWS_PER_FILE)
        dealt = dealt.repartition(
            len(changed) * parts, "bucket", F.pmod(F.xxhash64(F.lit("part"), "url"), F.lit(parts))
        )
        built = with_features(dealt, lexicons=lexicons)
        built.write.partitionBy("bucket").parquet(f"{path.rstrip('/')}/data/{folder}")
    at = {str(b): [*digests[b], kept[b][2] if b in kept else folder] for b in digests}
    publish(spark, path, {**stamp, "at": at}, before)
    return read_features(spark, path)
