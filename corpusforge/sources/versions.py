"""Tables that are replaced as a whole: every version is a table of its own, and a view by the plain name shows one of them.

Switching the view is the last act of a replacement and a single change of the catalog. A run that stops at any step before leaves the
view on the old version; what it has written is dropped by the next replacement. The version shown before stays until then,
so that queries which have begun on it can end.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

MARK = "__v"
ADOPTED = f"{MARK}000000_adopted"  # a plain table of that name, from before it had versions


def publish(
    df: DataFrame, name: str, bucket_by: tuple[int, str] | None = None, partition_by: list[str] | None = None
) -> str:
    """Replace the table ``name`` by ``df``, which may read it, and return the name of the version.

    ``bucket_by=(n, key)`` stores rows hashed by key, so that later joins and aggregates on it need no shuffle.
    """
    spark = df.sparkSession
    version = write_version(df, name, bucket_by, partition_by)
    switch(spark, name, version)
    drop_stale(spark, name)
    return version


def write_version(
    df: DataFrame, name: str, bucket_by: tuple[int, str] | None = None, partition_by: list[str] | None = None
) -> str:
    """Store ``df`` as a version that nobody sees yet. No two attempts share a name, so a retry meets no remains."""
    spark = df.sparkSession
    last = max([int(v.split(MARK)[-1][:6]) for v in versions(spark, name)], default=0)
    version = f"{name}{MARK}{last + 1:06}_{uuid.uuid4().hex[:12]}"
    # rebalancing keeps the files of a partition few, and splits a hot partition
    writer = df.hint("rebalance", *partition_by).write if partition_by else df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(version)
    return version


def switch(spark: SparkSession, name: str, version: str) -> None:
    """Let the plain name show ``version``."""
    _adopt(spark, name)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")


def shown(spark: SparkSession, name: str) -> str | None:
    """The table behind a name: the version its view shows, the name itself for a plain table, None if there is neither."""
    recover(spark, name)
    if not spark.catalog.tableExists(name):
        return None
    text = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'View Text'").first()
    return re.search(r"FROM\s+(\S+)", text["data_type"])[1] if text else name


def versions(spark: SparkSession, name: str) -> list[str]:
    """All stored versions, oldest first."""
    schema, _, table = name.rpartition(".")
    where = f" IN {schema}" if schema else ""
    rows = spark.sql(f"SHOW TABLES{where} LIKE '{table.lower()}{MARK}*'").collect()
    found = [r["tableName"] for r in rows if re.fullmatch(rf"{re.escape(table.lower())}{MARK}\d{{6}}_\w+", r["tableName"])]
    return [f"{schema}.{v}" if schema else v for v in sorted(found)]


def drop_stale(spark: SparkSession, name: str, keep: int = 1) -> list[str]:
    """Drop all versions but the one shown and the ``keep`` that came before it; returns those that stay."""
    current = shown(spark, name)
    if current is None:
        return []
    current = current.rpartition(".")[2].lower()
    every = versions(spark, name)
    number = lambda v: v.rpartition(".")[2]
    before = [v for v in every if number(v) < current]
    stay = [v for v in every if number(v) == current] + (before[-keep:] if keep else [])
    for version in every:
        if version not in stay:
            spark.sql(f"DROP TABLE IF EXISTS {version}")
    return stay


def _adopt(spark: SparkSession, name: str) -> None:
    """Make a plain table the first version of its name."""
    if shown(spark, name) == name:
        partitioned = bool(spark.sql(f"DESCRIBE {name}").filter("col_name = '# Partition Information'").take(1))
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}{ADOPTED}")
        if partitioned:
            # some catalogs keep the partition paths of the old name
            spark.sql(f"MSCK REPAIR TABLE {name}{ADOPTED} SYNC PARTITIONS")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}{ADOPTED}")


def recover(spark: SparkSession, name: str) -> None:
    """Finish an adoption that died after the rename: the only time when a name with data shows nothing."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}{ADOPTED}"):
        spark.sql(f"CREATE VIEW {name} AS SELECT * FROM {name}{ADOPTED}")
