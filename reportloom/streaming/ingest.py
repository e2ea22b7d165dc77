"""Incremental ingest: new files pass the same transforms once; the checkpoint is what a progress file would be."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def ingest(spark: SparkSession, source: str, schema: str, transform: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> int:
    """Reads what is new under ``source`` (Parquet), appends ``transform`` of it to ``sink`` and returns the rows taken in. Done when nothing is left."""
    stream = transform(spark.readStream.schema(schema).parquet(source))
    q = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return sum(p["numInputRows"] for p in q.recentProgress)
