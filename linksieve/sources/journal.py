"""Results of a long job, kept one by one, so that a broken job goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linksieve.sources.versions import fresh_name, read_if_there

_ENTRY = "key string, identity string, result string"


def fingerprint(df: DataFrame, columns: Iterable[str | Column]) -> str:
    """Digest of a table's rows, whatever their order: one pass, one row for the driver."""
    columns = list(columns)
    sums = [F.sum(F.xxhash64(F.lit(salt), *columns).cast("decimal(38,0)")).cast("string") for salt in ("one", "two")]
    seen = df.agg(F.count(F.lit(1)).cast("string").alias("rows"), F.concat_ws(" ", *sums).alias("digest")).first()
    return hashlib.sha256(f"{seen['rows']} {seen['digest']}".encode()).hexdigest()


class Journal:
    """Entries under ``path``, each in a folder of its own, so writers do not meet.

    An entry is found again by everything its result depends on. Without a path nothing is
    kept and nothing found.
    """

    def __init__(self, spark: SparkSession, path: str | None):
        self.spark, self.path = spark, path.rstrip("/") if path else None
        self.known = self._read()

    def _read(self) -> dict[str, dict]:
        if self.path is None:
            return {}
        reader = self.spark.read.schema(_ENTRY).option("recursiveFileLookup", True)
        stored = read_if_there(lambda: reader.json(self.path))
        return {} if stored is None else {r.key: json.loads(r.result) for r in stored.collect()}

    @staticmethod
    def key(identity: dict) -> str:
        return hashlib.sha256(json.dumps(identity, sort_keys=True).encode()).hexdigest()

    def get(self, identity: dict) -> dict | None:
        return self.known.get(self.key(identity))

    def add(self, identity: dict, result: dict) -> dict:
        key = self.key(identity)
        if self.path is not None:
            row = (key, json.dumps(identity, sort_keys=True), json.dumps(result))
            entry = self.spark.createDataFrame([row], _ENTRY)
            entry.coalesce(1).write.json(f"{self.path}/{key[:16]}-{fresh_name()}")
        self.known[key] = result
        return result

    def once(self, identity: dict, make: Callable[[], dict]) -> dict:
        """The stored result, or that of ``make``, which is then stored."""
        found = self.get(identity)
        return self.add(identity, make()) if found is None else found
