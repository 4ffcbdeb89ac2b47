"""Inline scoring: the batch scorer over an unbounded table of URLs.

Scoring is a stateless map, so a stream needs neither watermark nor state.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from linksieve.operators.scoring import score_urls


def scored_stream(
    model: PipelineModel,
    urls: DataFrame,
    path: str,
    checkpoint: str,
    url: str = "url",
    threshold: float | None = None,
) -> DataStreamWriter:
    """A writer that appends every scored micro-batch to Parquet, exactly once."""
    return (
        score_urls(model, urls, url, threshold)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
