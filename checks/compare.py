"""Run registered queries against their SQL: ``python -m checks.compare [sf] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.oracle import ORACLES  # noqa: E402
from linksieve.plans.queries import QUERIES  # noqa: E402
from linksieve.session import local_session  # noqa: E402

TESTDATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if isinstance(value, float) and not math.isinf(value):
        return round(value, 6) + 0.0
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when Spark and SQL agree, else what differs first."""
    frame = QUERIES[name](spark, sf_dir)
    relation = connection.sql(ORACLES[name])
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} against {sorted(relation.columns)}"
    got = as_rows(frame.columns, [tuple(r) for r in frame.collect()])
    want = as_rows(relation.columns, relation.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            apart = [(c, x, y) for c, x, y in zip(sorted(frame.columns), a, b) if x != y]
            return f"{apart} in {a}"
    return None


def main(sf: str = "0.01", *names: str) -> int:
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{TESTDATA}/sf{sf}"
    connection = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        started = time.perf_counter()
        if name in ORACLES:
            problem = difference(spark, connection, name, sf_dir)
            result = "same" if problem is None else f"DIFFERS {problem}"
            failed += problem is not None
        else:
            result = f"rows only: {len(QUERIES[name](spark, sf_dir).collect())}"
        print(f"{name:24s} {time.perf_counter() - started:6.2f}s  {result}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
