"""Read and write labelled URL tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORPUS_SCHEMA = T.StructType(
    [T.StructField("url", T.StringType()), T.StructField("label", T.ByteType())]
)


def load_raw(spark: SparkSession, *paths: str) -> DataFrame:
    """S1. All Parquet shards as one ``url, label`` table.

    Only the two columns are read; shards may carry others, in any order. Each
    shard is resolved by itself, so label types may differ between them.
    """
    if not paths:
        raise ValueError("give at least one path")
    shards = [
        spark.read.parquet(path).select(F.col("url"), F.col("label").cast("byte").alias("label"))
        for path in paths
    ]
    out = shards[0]
    for shard in shards[1:]:
        out = out.unionByName(shard)
    return out


def urls_frame(spark: SparkSession, urls: Iterable[str | None]) -> DataFrame:
    """S7. A handful of URLs given in code; tables come through :func:`load_raw`."""
    return spark.createDataFrame([(u,) for u in urls], "url string")


def write_corpus(corpus: DataFrame, path: str) -> None:
    """S2. Store a clean corpus as Parquet."""
    corpus.select("url", "label").write.mode("overwrite").parquet(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """S2. The stored corpus, with its declared types."""
    return spark.read.schema(CORPUS_SCHEMA).parquet(path)


def load_corpus(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """S2. The stored corpus, built and stored first where there is none."""
    try:
        return read_corpus(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    write_corpus(build(), path)
    return read_corpus(spark, path)


# Line breaks within a URL as two characters each, so that a line of the file is a row.
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def write_corpus_csv(corpus: DataFrame, path: str) -> None:
    r"""S2. CSV exchange form: header, every text quoted, so ``NA`` stays a URL.

    Spaces are kept as they are. A backslash is written ``\\``, line feed and carriage
    return ``\n`` and ``\r``, so every file can be read in splits.
    """
    url = F.col("url")
    for plain, escaped in _ESCAPES:
        url = F.replace(url, F.lit(plain), F.lit(escaped))
    corpus.select(url.alias("url"), "label").write.mode("overwrite").csv(
        path, header=True, quoteAll=True, escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def _unescaped(url):
    """Undo the escapes: ``\\\\`` first becomes a character that no CSV line has, a bare line feed."""
    marked = F.replace(url, F.lit("\\\\"), F.lit("\n"))
    marked = F.replace(marked, F.lit("\\r"), F.lit("\r"))
    # a line feed now stands for a backslash, and backslash-n for a line feed: exchange them
    marked = F.replace(marked, F.lit("\\n"), F.lit("\\"))
    return F.translate(marked, "\n\\", "\\\n")


def read_corpus_csv(spark: SparkSession, path: str) -> DataFrame:
    """S2. Reads that CSV form back, character for character."""
    read = spark.read.schema(CORPUS_SCHEMA).csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return read.select(_unescaped(F.col("url")).alias("url"), "label")
