"""Incremental runs: each one takes what is new since the last and stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def file_stream(
    spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet"
) -> DataFrame:
    """A stream of the parquet files that appear in a folder; ``folder`` may be a glob."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def run_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write all new rows to parquet, each exactly once, and stop.

    Nothing new means no batch; a run that died half-way is finished by the next one.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_upserts(
    stream: DataFrame, checkpoint: str, upsert: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Hand every new batch to ``upsert``; it must be keyed, because a batch may come twice."""
    query = (
        stream.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
