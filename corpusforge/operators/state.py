"""Sync state: which source was loaded when, and which is due."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.dates import is_due


def seed_state(state: DataFrame, sources: DataFrame) -> DataFrame:
    """The state table, filled with unsynced sources when it is empty."""
    spark = state.sparkSession
    return spark.sql(
        """
        SELECT source_table, last_synced FROM {state}
        UNION ALL
        SELECT source_table, CAST(NULL AS TIMESTAMP) FROM {sources}
        WHERE NOT EXISTS (SELECT 1 FROM {state})
        """,
        state=state,
        sources=sources,
    )


def refresh_due(sources: DataFrame, state: DataFrame, as_of: dt.datetime) -> DataFrame:
    """``(source_table, due)`` per source; a source without a row or stamp is due.

    The row with a null source says whether any source is due.
    """
    return (
        sources.join(state, "source_table", "left")
        .rollup("source_table")
        .agg(F.bool_or(is_due("last_synced", F.lit(as_of))).alias("due"))
    )


def stamp_sync(state: DataFrame, synced: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The state after the given sources were loaded; a source new to the state gets its row."""
    stamped = synced.select("source_table").distinct().withColumn("_now", F.lit(as_of))
    return state.join(stamped, "source_table", "full_outer").select(
        "source_table", F.coalesce("_now", "last_synced").alias("last_synced")
    )
