"""Landed files with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header, quotes doubled inside quotes. Bad bytes become the replacement character, bad fields null.

    ``multi_line`` reads line breaks inside quotes; such files cannot be split, and each is read by one task.
    """
    options = {"header": True, "mode": "PERMISSIVE", "escape": '"', "multiLine": multi_line}
    return spark.read.schema(schema).options(**options).csv(path)


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON record per line."""
    return spark.read.schema(schema).json(path)


def read_binary(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Whole files as ``(path, modificationTime, length, content)``; content is read only when selected."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
