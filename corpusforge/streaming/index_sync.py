"""An index kept in step with a stream of changes: triggered runs, a ledger of batches, latest version per key.

Each batch is stored once, below its number, and counts when its number stands in the ledger, which is the last thing
written. A batch that comes again is skipped if the ledger has it, and overwrites what it has left otherwise, so neither a
repeated batch nor a run that died half-way changes the index. Deleted keys are kept as marks until ``compact``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.scaling import cut_lineage
from corpusforge.streaming.incremental import run_upserts

ENTERS = ("insert", "update_postimage")
LEAVES = ("delete",)


@dataclass
class IndexSync:
    """An index in ``folder``, keyed by ``key``. ``embed`` turns changed rows into index rows; ``version`` is a column of the
    feed that tells later changes of a key from earlier ones, in whatever batch they arrive."""

    spark: SparkSession
    folder: str
    key: str
    embed: Callable[[DataFrame], DataFrame]
    version: str = "_version"
    kind: str = "_change_type"

    def _stored(self, name: str) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return self.spark.read.parquet(f"{self.folder}/{name}") if files.exists(path) else None

    def committed(self) -> set[int]:
        """Numbers of the batches that count; one number per run of the stream since the last compaction."""
        ledger = self._stored("ledger")
        return {r["batch"] for r in ledger.select("batch").collect()} if ledger is not None else set()

    def upsert(self, feed: DataFrame, batch: int) -> None:
        """Take in one batch of a change feed; for ``foreachBatch``."""
        if batch in self.committed():
            return
        # within a batch the last change of a key wins; preimages tell nothing new
        news = feed.filter(F.col(self.kind).isin(*ENTERS, *LEAVES))
        last = news.groupBy(F.col(self.key).alias("_key")).agg(F.max(F.struct(self.version, self._rank())).alias("_last"))
        current = news.join(
            last, F.col(self.key).eqNullSafe(F.col("_key")) & (F.struct(self.version, self._rank()) == F.col("_last"))
        ).drop("_key", "_last").dropDuplicates([self.key])
        current = cut_lineage(current)  # a stream's batch is read once
        entering = self.embed(current.filter(F.col(self.kind).isin(*ENTERS)))
        stamped = entering.join(current.select(F.col(self.key).alias("_key"), F.col(self.version).alias("_at")), F.col(self.key).eqNullSafe(F.col("_key")))
        rows = stamped.drop("_key").withColumn("_gone", F.lit(False))
        gone = current.filter(F.col(self.kind).isin(*LEAVES)).select(self.key, F.col(self.version).alias("_at"), F.lit(True).alias("_gone"))
        rows.unionByName(gone, allowMissingColumns=True).write.mode("overwrite").parquet(f"{self.folder}/deltas/batch={batch}")
        self.spark.range(1).select(F.lit(batch).cast("long").alias("number")).write.mode("overwrite").parquet(
            f"{self.folder}/ledger/batch={batch}"
        )

    def _rank(self):
        # a key that is deleted and inserted with one version number is there
        return F.when(F.col(self.kind).isin(*ENTERS), 1).otherwise(0).alias("_rank")

    def _latest(self) -> DataFrame | None:
        """Latest row of every key, marks of deleted ones included."""
        base, deltas, open_ = self._stored("base"), self._stored("deltas"), self.committed()
        if base is not None:
            newest = base.agg(F.max("upto")).first()[0]
            base = base.filter(F.col("upto") == newest).drop("upto")
            open_ -= {r["number"] for r in self._stored("folded").filter(F.col("upto") == newest).collect()}
        if deltas is not None and open_:
            counted = deltas.filter(F.col("batch").isin(sorted(open_))).drop("batch")
            base = counted if base is None else base.unionByName(counted, allowMissingColumns=True)
        if base is None:
            return None
        columns = [c for c in base.columns if c not in (self.key, "_at", "_gone")]
        newest = F.max_by(F.struct(*columns, "_gone"), F.struct("_at", ~F.col("_gone"))).alias("_row")
        grouped = base.groupBy(self.key).agg(newest, F.max("_at").alias("_at"))
        return grouped.select(self.key, *[F.col(f"_row.{c}").alias(c) for c in columns], "_at", F.col("_row._gone").alias("_gone"))

    def current(self) -> DataFrame:
        """The index as it stands."""
        latest = self._latest()
        if latest is None:
            raise ValueError("the index has taken in no batch yet")
        return latest.filter(~F.col("_gone")).drop("_at", "_gone")

    def run(self, feed: DataFrame, checkpoint: str):
        """Take in all batches that have arrived, and stop."""
        return run_upserts(feed, checkpoint, self.upsert)

    def compact(self) -> None:
        """Fold all batches into one base, so that readers meet each key once and leave these batches' rows unread.

        Batches stay in the ledger. The base counts as soon as its folder is complete, and which batches it holds is written before it.
        """
        done = self.committed()
        latest = self._latest()
        if done and latest is not None:
            upto = f"upto={max(done)}"
            numbers = self.spark.createDataFrame([(b,) for b in sorted(done)], "number long")
            numbers.write.mode("overwrite").parquet(f"{self.folder}/folded/{upto}")
            cut_lineage(latest).write.mode("overwrite").parquet(f"{self.folder}/base/{upto}")
