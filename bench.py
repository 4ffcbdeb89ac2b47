"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. A query's time is the
better of two runs after one warm-up; ``cold`` holds the warm-up. Results go to a
sink that discards them, so every column is computed.
"""

from __future__ import annotations

import json
import os
import time

from linksieve.plans.queries import QUERIES
from linksieve.session import local_session

HEADLINE = (
    "feature_table",
    "corpus_features",
    "features_lexical",
    "features_structural",
    "features_suspicion",
    "page_features",
    "url_parts",
    "canonical_steps",
    "corpus_clean",
    "corpus_clean_many",
    "corpus_audit",
    "split_train_val_test",
    "kfold",
    "split_domain_disjoint",
    "metrics_binary",
    "roc_auc",
    "roc_curve",
    "threshold_sweep",
    "rule_audit",
    "domain_rates",
    "domain_ceiling",
    "fire_rates",
    "feature_contract",
    "domain_overlap",
    "evaluation",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    cold, warm = {}, {}
    for name in HEADLINE:
        cold[name] = run(name)
        warm[name] = min(run(name), run(name))
    urls = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "feature_table_urls": urls,
                "feature_table_urls_per_sec": round(urls / warm["feature_table"]),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
