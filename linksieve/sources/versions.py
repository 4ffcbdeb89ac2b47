"""Versions of a stored table, published one after the other.

A version's data goes to folders that no earlier version uses and that are never written again.
It exists for readers once its claim, a file of one row, has been written: the claim with the
highest number is the current version. So a reader keeps the files it started with, and an
interrupted build leaves only folders that nobody looks at.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_CLAIM = "version long, name string, content string"


def fresh_name() -> str:
    return uuid.uuid4().hex


def read_if_there(read) -> DataFrame | None:
    """The frame that ``read()`` gives, None if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return None


def current(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """Content of the current claim, or of a given version's; with its number as ``version``.

    Of two writers that claimed the same number at once, the one of the higher name counts.
    """
    reader = spark.read.schema(_CLAIM).option("recursiveFileLookup", True)
    claims = read_if_there(lambda: reader.json(f"{path.rstrip('/')}/claims"))
    if claims is None:
        return None
    if version is not None:
        claims = claims.filter(claims.version == version)
    last = claims.orderBy(claims.version.desc(), claims.name.desc()).first()
    return None if last is None else {**json.loads(last.content), "version": last.version}


def publish(spark: SparkSession, path: str, content: dict, after: dict | None) -> int:
    """Claim the version that follows ``after``; returns its number."""
    version = 1 + (after["version"] if after else 0)
    name = fresh_name()
    kept = {k: v for k, v in content.items() if k != "version"}
    claim = spark.createDataFrame([(version, name, json.dumps(kept))], _CLAIM)
    claim.coalesce(1).write.json(f"{path.rstrip('/')}/claims/{version:08d}-{name}")
    return version
