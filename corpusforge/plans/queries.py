"""Every operator as a query over the given tables. Keys match those of ``oracle``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import text as tx
from corpusforge.operators import answers as A
from corpusforge.operators import corpus as C
from corpusforge.operators import digests as DG
from corpusforge.operators import postings as PO
from corpusforge.operators import profiling as P
from corpusforge.operators import relational as R
from corpusforge.operators import search as S
from corpusforge.operators import serving as V
from corpusforge.operators import state as ST
from corpusforge.operators import upsert as U
from corpusforge.operators import vector_index as VI
from corpusforge.plans import standins as si
from corpusforge.plans.standins import Tables
from corpusforge.scaling import cut_lineage, shared_folder
from corpusforge.schemas import DOCUMENT
from corpusforge.sources import files
from corpusforge.sources import tables as TB
from corpusforge.streaming import incremental as INC
from corpusforge.streaming import index_sync as ISY

AS_OF = dt.datetime(2024, 7, 28, 23, 30, tzinfo=dt.UTC)
HISTORY_YEAR = 2025

_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    _REGISTRY[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
    return fn


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


def _long(c: Column | str) -> Column:
    return tx.col(c).cast("long")


def _naive(state: DataFrame) -> DataFrame:
    return state.withColumn("last_synced", F.col("last_synced").cast("timestamp_ntz"))


# --- joins and profiles -------------------------------------------------------------------------


@query
def star_join(t: Tables) -> DataFrame:
    return si.entries(t).select(
        "orderkey", "linenumber", "host", "host_region", "country", "participant_region"
    )


@query
def dropped_dimension_keys(t: Tables) -> DataFrame:
    known = si.country(t).filter(F.col("region") != "EUROPE")
    return R.dropped_dimension_keys(si.contest(t), known, si.song(t))


@query
def entity_scoreboard(t: Tables) -> DataFrame:
    return R.scoreboard(si.entries(t)).withColumn("avg_place", F.round("avg_place", 6))


@query
def entity_profile(t: Tables) -> DataFrame:
    years = F.transform("years", lambda y: F.concat_ws("x", y["year"], y["n"]))
    return R.entity_profile(si.part_entries(t), "part_name").select(
        "entity", "participations", "wins", "avg_place", "best_place", "region",
        F.array_join(years, ",").alias("years"),
        F.array_join("languages", ",").alias("languages"),
        F.array_join("styles", ",").alias("styles"),
    )


@query
def entity_winners(t: Tables) -> DataFrame:
    return R.winner_parts(si.part_entries(t), "part_name").select(
        "entity", "part", "n_winners", R.winner_list(F.col("winning_entries")).alias("winners")
    )


@query
def entity_summary(t: Tables) -> DataFrame:
    return si.summaries(t)


# --- texts and chunks ---------------------------------------------------------------------------


@query
def chunk_documents(t: Tables) -> DataFrame:
    return si.document_chunks(t).select("doc_id", "chunk_idx", "chunk")


@query
def chunk_stats(t: Tables) -> DataFrame:
    return C.chunk_stats(si.document_chunks(t), "source", "chunk").select(
        "source", "total_chunks", F.round("avg_length", 6).alias("avg_length"),
        _long("min_length").alias("min_length"), _long("max_length").alias("max_length"),
        F.round("est_tokens", 6).alias("est_tokens"),
    )


def _section_rows(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "page_id", "level", F.array_join("path", " > ").alias("path"), "section_title", "title", "summary",
        "section_idx", "sub_chunk_idx", "chunk_id", "text",
    )


@query
def page_sections(t: Tables) -> DataFrame:
    return _section_rows(si.page_chunks(t))


@query
def page_tree(t: Tables) -> DataFrame:
    """Sections of pages that are built in other ways than the given ones."""
    return _section_rows(C.section_chunks(si.rich_pages(t)))


@query
def fetch_pages(t: Tables) -> DataFrame:
    wanted = t.events.select(F.col("user_id").alias("page_id")).distinct()
    return C.pages_for_keys(t.pages, wanted, "page_id").select(
        "page_id", "url", tx.url_id("url").alias("url_id"), C.page_title("html").alias("title")
    )


@query
def clean_text(t: Tables) -> DataFrame:
    broken = F.replace("text", F.lit("tion"), F.lit("ti-\n on"))
    return si.documents(t, "text").select("doc_id", tx.clean(broken).alias("text"))


@query
def parse_elements(t: Tables) -> DataFrame:
    return C.parsed_elements(si.parsed_documents(t)).select(
        F.col("paper_id").alias("doc_id"), "chunk_id", F.col("content").alias("text")
    )


@query
def broken_documents(t: Tables) -> DataFrame:
    junk = F.concat(F.lit("<"), "props")
    landed = F.when(F.col("event_type") == "error", junk).otherwise(F.col("props"))
    events = t.events.select("event_id", landed.alias("parsed_content"))
    return C.broken_documents(events)


@query
def props_extract(t: Tables) -> DataFrame:
    k = F.from_json("props", "k long")["k"]
    return t.events.select("event_id", k.alias("k"))


@query
def paper_chunks(t: Tables) -> DataFrame:
    return C.paper_chunks(si.parsed_documents(t), si.papers(t), si.RUN_ID)


@query
def unified_corpus(t: Tables) -> DataFrame:
    chunks = si.document_chunks(t).select(
        tx.strict_concat("_", "doc_id", "chunk_idx").alias("chunk_id"), F.col("chunk").alias("text")
    )
    summaries = si.summaries(t).select(
        F.when(F.col("part") == 0, F.col("chunk_id"))
        .otherwise(tx.strict_concat("_", "chunk_id", "part"))
        .alias("chunk_id"),
        "text",
    )
    return C.unify(
        {
            "documents": (chunks, "chunk_id"),
            "pages": (si.page_chunks(t), "chunk_id"),
            "summaries": (summaries, "chunk_id"),
        }
    )


@query
def duplicate_ids(t: Tables) -> DataFrame:
    """Ids that sections of one page share, because they have the same title."""
    return C.duplicate_ids(C.unify({"pages": (C.section_chunks(si.rich_pages(t)), "chunk_id")}))


# --- keyed changes and sync state ---------------------------------------------------------------


@query
def new_keys_only(t: Tables) -> DataFrame:
    return U.new_keys_only(t.documents.select("doc_id", "lang", "source"), t.labels, "doc_id")


@query
def merge_insert_only(t: Tables) -> DataFrame:
    return U.merge_insert_only(t.labels, t.documents.select("doc_id", "lang"), "doc_id")


@query
def change_feed(t: Tables) -> DataFrame:
    feed = U.change_feed(si.old_snapshot(t), si.new_snapshot(t), "doc_id")
    return feed.select("doc_id", F.col("_change_type").alias("change_type"), "text")


@query
def change_feed_copies(t: Tables) -> DataFrame:
    """Snapshots in which rows repeat, and keys with several versions of which some stay."""
    second = F.concat("text", F.lit("\n(second)"))
    old = si.old_snapshot(t)
    old = old.unionByName(old.filter("doc_id % 3 = 0")).unionByName(
        old.filter("doc_id % 5 = 0").withColumn("text", second)
    )
    feed = U.change_feed(old, si.new_snapshot(t), "doc_id")
    return feed.select("doc_id", F.col("_change_type").alias("change_type"), "text")


@query
def change_feed_digests(t: Tables) -> DataFrame:
    """The change feed from stored digests, in tables of the catalog that go when the changes are known."""
    old, new = si.old_snapshot(t), si.new_snapshot(t)
    names = [f"digests_{uuid.uuid4().hex}" for _ in range(2)]
    digests = [DG.store_digests(df, "doc_id", name) for df, name in zip((old, new), names, strict=True)]
    feed = DG.feed_between(old, new, "doc_id", *digests)
    for name in names:
        t.spark.sql(f"DROP TABLE {name}")
    return feed.select("doc_id", F.col("_change_type").alias("change_type"), "text")


@query
def index_sync_stream(t: Tables) -> DataFrame:
    """An index brought up by a stream: a first load, then the changes, and the first batch once more."""
    folder = shared_folder(t.spark, "index-stream")
    old, new = si.old_snapshot(t), si.new_snapshot(t)
    load = old.select("*", F.lit("insert").alias("_change_type"), F.lit(1).alias("_version"))
    load.write.parquet(f"{folder}/landed")
    sync = ISY.IndexSync(t.spark, f"{folder}/index", "doc_id", lambda df: df.select("doc_id", F.md5("text").alias("text_hash")))
    feed = INC.file_stream(t.spark, f"{folder}/landed", "doc_id LONG, text STRING, _change_type STRING, _version INT")
    sync.run(feed, f"{folder}/checkpoint")
    changes = U.change_feed(old, new, "doc_id").select("doc_id", "text", "_change_type", F.lit(2).alias("_version"))
    changes.write.mode("append").parquet(f"{folder}/landed")
    sync.run(feed, f"{folder}/checkpoint")
    sync.upsert(load, 0)
    sync.compact()
    return sync.current()


@query
def index_sync(t: Tables) -> DataFrame:
    def embed(df: DataFrame) -> DataFrame:
        return df.select("doc_id", F.md5("text").alias("text_hash"))

    feed = U.change_feed(si.old_snapshot(t), si.new_snapshot(t), "doc_id")
    return S.sync_index(embed(si.old_snapshot(t)), feed, embed, "doc_id")


@query
def seed_state(t: Tables) -> DataFrame:
    unsynced = si.sync_state(t).filter(F.col("last_synced") > F.lit(AS_OF))
    return _naive(ST.seed_state(unsynced, si.sync_sources(t)))


@query
def refresh_due(t: Tables) -> DataFrame:
    return ST.refresh_due(si.sync_sources(t), si.sync_state(t), AS_OF)


@query
def stamp_sync(t: Tables) -> DataFrame:
    due = ST.refresh_due(si.sync_sources(t), si.sync_state(t), AS_OF)
    loaded = due.filter(F.col("due") & F.col("source_table").isNotNull())
    return _naive(ST.stamp_sync(si.sync_state(t), loaded, AS_OF))


# --- profiles of tables -------------------------------------------------------------------------


@query
def table_profile(t: Tables) -> DataFrame:
    return P.table_profile(merge_insert_only(t)).select("column", "n", "nulls")


@query
def table_head(t: Tables) -> DataFrame:
    return P.head(t.documents.select("doc_id", "lang", "source", "n_chars"), "doc_id")


@query
def markdown_rows(t: Tables) -> DataFrame:
    return P.markdown_rows(entity_scoreboard(t).drop("avg_place"))


# --- search -------------------------------------------------------------------------------------


def _vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("id"), "embedding", "label")


def _query_vectors(t: Tables) -> DataFrame:
    return si.queries(t).filter(F.col("embedding").isNotNull()).select("qid", "embedding")


@query
def vector_topk(t: Tables) -> DataFrame:
    return S.vector_topk(_query_vectors(t), _vectors(t), 10)


@query
def vector_topk_filtered(t: Tables) -> DataFrame:
    return S.vector_topk(_query_vectors(t), _vectors(t), 5, {"label": 3})


@query
def vector_index_topk(t: Tables) -> DataFrame:
    """The exact ranking again, from a stored index whose cells are read only where they can matter."""
    index = VI.build(_vectors(t), shared_folder(t.spark, "vector-index"), keep=["label"])
    return VI.query_index(_query_vectors(t), index, 10, exact=True)


@query
def vector_index_filtered(t: Tables) -> DataFrame:
    index = VI.build(_vectors(t), shared_folder(t.spark, "vector-index"), keep=["label"])
    return VI.query_index(_query_vectors(t), index, 5, exact=True, filters={"label": 3})


@query
def vector_topk_probed(t: Tables) -> DataFrame:
    cells = S.mean_vectors(t.embeddings, "label").withColumnRenamed("label", "cell")
    corpus = S.assign_cells(_vectors(t), cells)
    return S.vector_topk(S.assign_cells(_query_vectors(t), cells, 2), corpus, 10)


@query
def keyword_topk(t: Tables) -> DataFrame:
    docs = si.documents(t, "text")
    return S.keyword_topk(si.queries(t).select("qid", "text"), docs, 10, id="doc_id")


@query
def keyword_topk_indexed(t: Tables) -> DataFrame:
    """The keyword search again, on postings in blocks written before."""
    index = PO.build(si.documents(t, "text"), shared_folder(t.spark, "postings"), "doc_id")
    return PO.blocked_topk(si.queries(t).select("qid", "text"), index, 10)


@query
def hybrid_topk(t: Tables) -> DataFrame:
    corpus = si.corpus(t).select("doc_id", "source", "text", "embedding")
    return S.search(si.queries(t), corpus, ["doc_id", "source"], 10, id="doc_id")


@query
def hybrid_deep(t: Tables) -> DataFrame:
    """More results than the usual depth of the fused rankings."""
    corpus = si.corpus(t).select("doc_id", "source", "text", "embedding")
    return S.search(si.queries(t), corpus, ["doc_id", "source"], 80, id="doc_id")


@query
def hybrid_exact(t: Tables) -> DataFrame:
    """The fusion of the whole rankings."""
    corpus = si.corpus(t).select("doc_id", "source", "text", "embedding")
    return S.search(si.queries(t), corpus, ["doc_id", "source"], 10, depth=None, id="doc_id")


@query
def tfidf_embed(t: Tables) -> DataFrame:
    """Whole vectors, by their entries other than zero."""
    return S.tfidf_entries(si.documents(t, "text"), id="doc_id").withColumnRenamed("id", "doc_id")


# --- answers and serving ------------------------------------------------------------------------


@query
def answer_checks(t: Tables) -> DataFrame:
    scored = A.score_answers(V.assistant_messages(t.conversations))
    return scored.select("conv_id", "turn", "word_count_check", "mentions_countries")


@query
def mixed_answers(t: Tables) -> DataFrame:
    """Answers that come as a string, a list of items or of strings, an object, or an empty list."""
    return A.score_answers(si.mixed_answers(t), "output", mixed=True).select(
        "conv_id", "turn", A.output_text(F.col("output")).alias("said"), "word_count_check", "mentions_countries"
    )


@query
def evaluation_report(t: Tables) -> DataFrame:
    scored = A.score_answers(V.assistant_messages(t.conversations))
    return A.report(scored).withColumn("mean", F.round("mean", 6))


@query
def lookup_with_fallback(t: Tables) -> DataFrame:
    return V.lookup_with_fallback(si.lookup_requests(t), si.summaries(t))


@query
def history_json(t: Tables) -> DataFrame:
    # read twice: for the sizes that the documents are cut by, and for the documents
    return V.history_json(cut_lineage(si.summaries(t)), HISTORY_YEAR)


@query
def tool_dispatch(t: Tables) -> DataFrame:
    # read twice: by the lookups, and for the size of the history
    return V.dispatch(si.tool_requests(t), cut_lineage(si.summaries(t)))


@query
def assistant_messages(t: Tables) -> DataFrame:
    return V.assistant_messages(t.conversations)


@query
def last_answers(t: Tables) -> DataFrame:
    return V.last_answers(t.conversations)


@query
def conversation_outcome(t: Tables) -> DataFrame:
    return V.conversation_outcome(t.conversations)


# --- files and streams --------------------------------------------------------------------------


@query
def csv_load(t: Tables) -> DataFrame:
    """Entries written as CSV with unreadable placements, quotes and line breaks, read back with a declared schema."""
    folder = shared_folder(t.spark, "entries-csv")
    place = F.when(F.col("l_linenumber") == 7, "DNF").otherwise(F.col("l_linenumber").cast("string"))
    t.lineitem.select(
        F.col("l_orderkey").alias("orderkey"), place.alias("final_place"),
        F.concat(F.lit('He said "hi", twice\n'), "l_returnflag").alias("language"),
        F.col("l_extendedprice").alias("price"),
    ).write.csv(folder, header=True, escape='"')
    schema = "orderkey LONG, final_place INT, language STRING, price DOUBLE"
    return files.read_csv(t.spark, folder, schema, multi_line=True)


@query
def record_load(t: Tables) -> DataFrame:
    """Paper records written as JSON lines and read back with a declared schema."""
    folder = shared_folder(t.spark, "papers-json")
    si.papers(t).write.json(folder)
    schema = "arxiv_id STRING, title STRING, summary STRING, authors ARRAY<STRING>, published LONG"
    return files.read_records(t.spark, folder, schema).withColumn(
        "authors", F.array_join("authors", ", ")
    )


@query
def binary_scan(t: Tables) -> DataFrame:
    """Documents without their texts, written as files of records and read back from the whole files' bytes."""
    folder = shared_folder(t.spark, "documents-files")
    t.documents.select("doc_id", "lang", "source", "n_chars").write.json(folder)
    content = F.decode("content", "UTF-8")
    lines = files.read_binary(t.spark, folder, "*.json").select(F.explode(F.split(content, "\n")).alias("line"))
    record = F.from_json("line", "doc_id LONG, lang STRING, source STRING, n_chars LONG").alias("r")
    return lines.filter("line <> ''").select(record).select("r.*")


@query
def stored_papers(t: Tables) -> DataFrame:
    """A schema and a table that are there already, papers of one run inserted by key twice, and a table that is kept."""
    schema = f"papers_{uuid.uuid4().hex}"
    name, kept = f"{schema}.papers", f"{schema}.kept"
    new = t.labels.withColumn("processed", F.lit(si.RUN_ID))
    for _ in range(2):
        TB.ensure_schema(t.spark, schema)
        TB.ensure_table(t.spark, name, "doc_id LONG, quality INT, toxic INT, processed LONG")
        TB.insert_new(new, name, "doc_id")
    there = t.spark.catalog.tableExists(name) and not t.spark.catalog.tableExists(kept)
    TB.create_if_absent(t.spark.table(name).limit(0), kept)
    TB.create_if_absent(t.spark.table(name), kept)
    missing = t.spark.table(name).join(t.spark.table(kept), "doc_id", "left_anti")
    result = cut_lineage(missing.filter(F.col("processed") == si.RUN_ID).withColumn("there", F.lit(there)))
    t.spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return result


@query
def output_messages(t: Tables) -> DataFrame:
    """The finished messages among the events that an agent streams."""
    done = V.output_messages(si.stream_events(t))
    return done.select("conv_id", "turn", F.col("item.text").alias("text"))


@query
def incremental_chunks(t: Tables) -> DataFrame:
    folder = shared_folder(t.spark, "incremental-chunks")
    # the glob finds the table as one file and as a folder of part files
    landed = INC.file_stream(t.spark, f"{t.folder}/documents.parque[t]", DOCUMENT)
    chunks = C.explode_chunks(landed.select("doc_id", "text"))
    INC.run_available(chunks, f"{folder}/chunks", f"{folder}/checkpoint")
    return t.spark.read.parquet(f"{folder}/chunks")
