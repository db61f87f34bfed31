"""Decisions that depend on size: what may be broadcast, how hot keys are salted, where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` holds at most ``max_rows`` rows and ``max_bytes`` of content.

    A plain aggregate: partial counts per task, two numbers to the driver.
    """
    width = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    seen = df.agg(F.count("*").alias("n"), F.sum(width).alias("b")).first()
    return seen["n"] <= max_rows and (seen["b"] or 0) <= max_bytes


def salted_join(
    left: DataFrame, right: DataFrame, key: str, spread_by: Column, salts: int = SALTS
) -> DataFrame:
    """Inner equi join in which one hot key of ``left`` is shared by ``salts`` tasks."""
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"]).drop("_salt")


def join_lookup(
    left: DataFrame, right: DataFrame, key: str, spread_by: Column, right_fits: bool
) -> DataFrame:
    """Inner equi join: broadcast when the right side was checked to be small, salted shuffle otherwise."""
    if right_fits:
        return left.join(F.broadcast(right), key)
    return salted_join(left, right, key, spread_by)


def sized(df: DataFrame) -> DataFrame:
    """``df`` computed once and cut off, with a broadcast hint when it turned out to be small.

    For the narrow side of a join whose other side carries payload: Spark would otherwise start to shuffle
    the payload before it knows that the narrow side is small.
    """
    done = cut_lineage(df)
    return F.broadcast(done) if fits(done) else done


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out to all cores when a scan has fewer splits than the cluster has cores.

    For plain scans ahead of work that costs CPU per row. On large tables the scan has splits enough and
    nothing happens.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


_FOLDERS: list[str] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; a temporary one only where that is unset. See ``release``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="corpusforge-")
    _FOLDERS.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _FOLDERS[-1]


def folders_named() -> list[str]:
    """The folders that ``shared_folder`` has named and ``release`` has not deleted, oldest first."""
    return list(_FOLDERS)


def release(spark: SparkSession, keep: list[str] | None = None, since: int = 0) -> None:
    """Delete the named folders after the first ``since``, but for those to ``keep``.

    For the end of a job whose result is written: frames that still read such a folder fail afterwards.
    """
    held = [f for f in _FOLDERS[since:] if f in (keep or [])]
    for folder in _FOLDERS[since:]:
        if folder not in held:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    _FOLDERS[since:] = held


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that a lost executor costs no recomputation of everything before."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))
    return df.checkpoint()
