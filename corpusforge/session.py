"""Session defaults for local runs; on a cluster the submitted configuration wins."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "corpusforge", master: str | None = None, **conf: str) -> SparkSession:
    """UTC clock, ANSI arithmetic, adaptive execution with skew handling."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # a table this small, by the optimizer's own statistics, is cheaper sent than shuffled for
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
