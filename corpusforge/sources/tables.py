"""Catalog tables: create, append, overwrite and keyed merge on plain parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.sources import versions


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def ensure_table(spark: SparkSession, name: str, columns: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def create_if_absent(df: DataFrame, name: str) -> None:
    df.write.mode("ignore").saveAsTable(name)


def append(df: DataFrame, name: str) -> None:
    """Add rows. Columns go by name; the table decides their order."""
    spark = df.sparkSession
    stored = versions.shown(spark, name)
    if stored:
        df.select(*spark.table(name).columns).write.mode("append").insertInto(stored)
    else:
        df.write.saveAsTable(name)


def overwrite(
    df: DataFrame, name: str, bucket_by: tuple[int, str] | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Replace a table, also when ``df`` reads it. Readers see the old version or the new one, whenever the run stops."""
    versions.publish(df, name, bucket_by, partition_by)


def widen(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the columns of the stored table that it lacks, as nulls."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return df
    return spark.table(name).limit(0).unionByName(df, allowMissingColumns=True)


def insert_new(df: DataFrame, name: str, key: str) -> None:
    """Insert the rows whose key the table lacks; running it twice changes nothing, also for a null key."""
    spark = df.sparkSession
    if versions.shown(spark, name):
        known = spark.table(name).select(F.col(key).alias("_known")).distinct()
        df = df.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    append(df, name)
