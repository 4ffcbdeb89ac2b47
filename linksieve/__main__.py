"""``spark-submit`` entry: ``linksieve JOB FOLDER [raw shard ...]``, or
``linksieve score FOLDER INPUT OUTPUT``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from linksieve.plans.jobs import JOBS, score_job


def main() -> None:
    parser = argparse.ArgumentParser(prog="linksieve", description=__doc__)
    parser.add_argument("job", choices=[*JOBS, "score"])
    parser.add_argument("folder", help="shared folder for tables, models and reports")
    parser.add_argument("paths", nargs="*", help="raw shards, or input and output of score")
    options = parser.parse_args()
    builder = SparkSession.builder.appName(f"linksieve-{options.job}")
    spark = builder.config("spark.ui.enabled", "false").getOrCreate()
    if options.job == "score":
        source, output = options.paths
        score_job(spark, options.folder, spark.read.parquet(source), output)
    else:
        JOBS[options.job](spark, options.folder, *options.paths)
    spark.stop()


if __name__ == "__main__":
    main()
