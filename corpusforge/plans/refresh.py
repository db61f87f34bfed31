"""The corpus refresh job: three legs, one unified corpus, one index kept in step with it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions.text import strict_concat
from corpusforge.operators import corpus as C
from corpusforge.operators import digests as DG
from corpusforge.operators import relational as R
from corpusforge.operators import search as S
from corpusforge.operators import state as ST
from corpusforge.sources import tables as TB
from corpusforge.sources import versions as VS

PAPERS, PAGES, ENTRIES = "papers", "pages", "entries"
CORPUS_BUCKETS = 8


@dataclass
class Landed:
    """What the sources have delivered so far."""

    papers: DataFrame  # schemas.PAPER without processed
    parsed: DataFrame  # path, parsed_content
    pages: DataFrame  # schemas.PAGE
    contest: DataFrame
    country: DataFrame
    song: DataFrame


class CorpusRefresh:
    """Runs against the tables of one catalog schema; every step may be repeated after a failure."""

    def __init__(
        self, spark: SparkSession, schema: str, as_of: dt.datetime, run_id: int,
        buckets: int = CORPUS_BUCKETS,
    ):
        self.spark, self.schema, self.as_of, self.run_id = spark, schema, as_of, run_id
        self.buckets = buckets

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def prepare(self) -> None:
        """Schema and state table, seeded with the two sources that are loaded as a whole."""
        TB.ensure_schema(self.spark, self.schema)
        state = self.name("sync_metadata")
        TB.ensure_table(self.spark, state, "source_table STRING, last_synced TIMESTAMP")
        seeds = self.spark.createDataFrame([(PAGES,), (ENTRIES,)], "source_table string")
        TB.overwrite(ST.seed_state(self.spark.table(state), seeds), state)

    def due(self, source: str) -> bool:
        one = self.spark.createDataFrame([(source,)], "source_table string")
        due = ST.refresh_due(one, self.table("sync_metadata"), self.as_of)
        return due.filter(F.col("source_table") == source).first()["due"]

    def stamp(self, source: str) -> None:
        one = self.spark.createDataFrame([(source,)], "source_table string")
        state = ST.stamp_sync(self.table("sync_metadata"), one, self.as_of)
        TB.overwrite(state, self.name("sync_metadata"))

    def load_papers(self, landed: Landed) -> bool:
        """Metadata of papers not seen before, then every known paper's document that has no chunks yet. False if none.

        What is to be done follows from what is stored and not from the run: documents that arrive late, or whose run died
        at any step, are taken up by the next one.
        """
        stamped = landed.papers.withColumns(
            {"processed": F.lit(self.run_id), "ingest_ts": F.lit(self.as_of)}
        )
        TB.insert_new(stamped, self.name("papers"), "arxiv_id")
        arrived = landed.parsed.withColumn("arxiv_id", C.tx.path_id("path"))
        arrived = arrived.join(self.table("papers").select("arxiv_id"), "arxiv_id", "left_semi")
        parsed = arrived.select("path", "parsed_content", F.lit(self.run_id).alias("processed"))
        TB.insert_new(C.broken_documents(parsed), self.name("broken_documents"), "path")
        TB.insert_new(C.sound_documents(parsed), self.name("parsed_documents"), "path")
        pending = self.table("parsed_documents")
        if self.exists("paper_chunks"):
            chunked = self.table("paper_chunks").select("arxiv_id").distinct()
            pending = pending.join(chunked, C.tx.path_id("path") == F.col("arxiv_id"), "left_anti")
        chunks = C.paper_chunks(pending, self.table("papers"))
        if self.exists("paper_chunks") and chunks.isEmpty():
            return False
        TB.insert_new(chunks, self.name("paper_chunks"), "id")
        return not self.table("paper_chunks").isEmpty()

    def load_pages(self, landed: Landed) -> bool:
        if not self.due(PAGES):
            return False
        TB.overwrite(C.section_chunks(landed.pages, unique_ids=True), self.name("page_chunks"))
        self.stamp(PAGES)
        return True

    def load_entries(self, landed: Landed) -> bool:
        if not self.due(ENTRIES):
            return False
        entries = R.star_join(landed.contest, landed.country, landed.song)
        summaries = R.entity_summary(entries)
        chunk_id = F.when(F.col("part") == 0, F.col("chunk_id")).otherwise(
            strict_concat("_", "chunk_id", "part")
        )
        TB.overwrite(summaries.select(chunk_id.alias("chunk_id"), "text"), self.name("entry_chunks"))
        self.stamp(ENTRIES)
        return True

    def rebuild(self, embed: Callable[[DataFrame], DataFrame]) -> None:
        """Union the chunk tables and bring the index up to date with what changed in the union."""
        kinds = {
            PAPERS: ("paper_chunks", "id"),
            PAGES: ("page_chunks", "chunk_id"),
            ENTRIES: ("entry_chunks", "chunk_id"),
        }
        unified = C.unify(
            {k: (self.table(t), key) for k, (t, key) in kinds.items() if self.exists(t)}
        )
        # the index is keyed by id
        unified = C.unique_ids(unified)
        corpus, index_name = self.name("corpus"), self.name("corpus_index")
        shown = VS.shown(self.spark, corpus)
        version = VS.write_version(unified, corpus, bucket_by=(self.buckets, "id"))
        new = self.spark.table(version)
        digests = self.digests_of(version)
        if shown and self.exists("corpus_index"):
            feed = DG.feed_between(self.spark.table(shown), new, "id", self.digests_of(shown), digests)
            TB.overwrite(feed, self.name("corpus_changes"))
            index = S.sync_index(self.table("corpus_index"), self.table("corpus_changes"), embed)
        else:
            index = embed(new)
        # the index first: applied to it again, the same changes do nothing, but a corpus ahead of its index would lose them
        TB.overwrite(index, index_name, bucket_by=(self.buckets, "id"))
        VS.switch(self.spark, corpus, version)
        kept = VS.drop_stale(self.spark, corpus)
        for name in self.spark.catalog.listTables(self.schema):
            if name.name.startswith("digests_") and name.name.removeprefix("digests_") not in {v.rpartition(".")[2] for v in kept}:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(name.name)}")

    def digests_of(self, version: str) -> DataFrame:
        """Digests of a version of the corpus, stored with it; made anew where a run has died before it wrote them."""
        name = self.name("digests_" + version.rpartition(".")[2])
        if self.spark.catalog.tableExists(name):
            return self.spark.table(name)
        return DG.store_digests(self.spark.table(version), "id", name, self.buckets)

    def run(self, landed: Landed, embed: Callable[[DataFrame], DataFrame]) -> dict[str, bool]:
        self.prepare()
        updated = {
            PAPERS: self.load_papers(landed),
            PAGES: self.load_pages(landed),
            ENTRIES: self.load_entries(landed),
        }
        if any(updated.values()):
            self.rebuild(embed)
        return updated
