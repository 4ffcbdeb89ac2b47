"""A labelled URL corpus that grows shard by shard.

What cleaning and its audit need to know of a URL is four numbers: its rows, its labelled rows,
its lowest and its highest label. They are stored as a table bucketed by URL. A new shard is
grouped by URL, dealt into the same buckets and merged by a join that reads the stored side
bucket by bucket, so only the shard is shuffled. Every URL stands once on either side, whatever
its share of the rows.

Merged shards are remembered by name; merging one again changes nothing, so a job that broke off
is simply run again. Frames read before a merge keep the version they were opened on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linksieve.operators.corpus import audit, unanimous, url_groups
from linksieve.sources.versions import current, fresh_name, publish

BUCKETS = 64
_COLUMNS = "url string, rows long, labelled long, low byte, high byte"


class CorpusState:
    """The stored groups under ``path``; ``buckets`` counts for a new one only."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _opened(self, folder: str, buckets: int) -> DataFrame:
        """The bucketed table of a folder; the session's catalog learns of it if need be."""
        name = f"linksieve_corpus_{folder}"
        location = f"{self.path}/data/{folder}".replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_COLUMNS}) USING parquet "
            f"CLUSTERED BY (url) SORTED BY (url) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        return self.spark.table(name)

    def _version(self) -> dict:
        return current(self.spark, self.path) or {"version": 0, "folder": None, "buckets": self.buckets, "shards": []}

    def shards(self) -> list[str]:
        """Names of the shards merged so far."""
        return self._version()["shards"]

    def groups(self, version: int | None = None) -> DataFrame:
        """One row per canonical URL of all merged shards, as :func:`operators.corpus.url_groups` gives it."""
        found = current(self.spark, self.path, version)
        if found is None:
            raise FileNotFoundError(f"no corpus state at {self.path}: merge a shard first")
        return self._opened(found["folder"], found["buckets"])

    def corpus(self) -> DataFrame:
        """C8. The clean corpus of all merged shards."""
        return unanimous(self.groups())

    def audit(self) -> DataFrame:
        """C9. The audit of all merged shards."""
        return audit(self.groups())

    def merged(self, raw: DataFrame) -> DataFrame:
        """The groups after ``raw``: a join in place, without a shuffle of the stored side."""
        before = self._version()
        # a new state starts from an empty table, so its first version lies in buckets already
        folder = before["folder"] or fresh_name()
        old = self._opened(folder, before["buckets"]).alias("old")
        new = url_groups(raw).alias("new")

        def total(name: str):
            return (F.coalesce(f"old.{name}", F.lit(0)) + F.coalesce(f"new.{name}", F.lit(0))).alias(name)

        return old.join(new, "url", "full_outer").select(
            "url",
            total("rows"),
            total("labelled"),
            F.least("old.low", "new.low").alias("low"),
            F.greatest("old.high", "new.high").alias("high"),
        )

    def merge(self, raw: DataFrame, shard: str) -> bool:
        """Add the rows of a shard; False if a shard of that name is in already."""
        before = self._version()
        if shard in before["shards"]:
            return False
        folder = fresh_name()
        (
            self.merged(raw)
            .write.bucketBy(before["buckets"], "url")
            .sortBy("url")
            .format("parquet")
            .option("path", f"{self.path}/data/{folder}")
            .saveAsTable(f"linksieve_corpus_{folder}")
        )
        content = {"folder": folder, "buckets": before["buckets"], "shards": [*before["shards"], shard]}
        publish(self.spark, self.path, content, before)
        return True
