"""The given tables in the roles of contests, entries, papers, requests and snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import documents as doc
from corpusforge.functions.dates import minute_stamp
from corpusforge.operators import corpus as C
from corpusforge.operators import relational as R
from corpusforge.scaling import spread
from corpusforge.schemas import DOCUMENT, PAGE

RUN_ID = 202501010000
# Fixed value: the first publication minute of the stand-in papers, 2020-01-01 as seconds.
FIRST_PAPER = 1_577_836_800


# Declared, so that opening a table reads no file.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey LONG, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey LONG, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP",
    "events": "event_id LONG, ts TIMESTAMP, user_id LONG, event_type STRING, value DOUBLE, props STRING",
    "documents": DOCUMENT,
    "labels": "doc_id LONG, quality INT, toxic INT",
    "embeddings": "vec_id LONG, embedding ARRAY<FLOAT>, label INT",
    "pages": PAGE,
    "benchmark": "item_id LONG, text STRING",
    "conversations": "conv_id LONG, turn LONG, role STRING, text STRING",
}


class Tables:
    """The parquet tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        # days and minute stamps are those of UTC, whatever clock the session was started with
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")


def country(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("country"), F.col("r_name").alias("region")
    )


def contest(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("orderkey"),
        F.year("o_orderdate").alias("year"),
        F.col("c_nationkey").alias("host"),
    )


def song(t: Tables) -> DataFrame:
    return spread(t.lineitem, "l_orderkey").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_partkey").alias("partkey"),
        F.col("s_nationkey").alias("country"),
        F.concat_ws("/", F.concat(F.lit("Order "), "l_orderkey"), "l_linenumber").alias("song_name"),
        F.col("s_name").alias("artist_name"),
        F.col("l_returnflag").alias("language"),
        F.col("l_linestatus").alias("style"),
        F.nullif("l_linenumber", F.lit(7)).alias("final_place"),
    )


def entries(t: Tables) -> DataFrame:
    return R.star_join(contest(t), country(t), song(t), key="orderkey")


def entity_name() -> Column:
    return F.concat_ws(" ", "p_name", "p_partkey")


def part_entries(t: Tables) -> DataFrame:
    parts = t.part.select(F.col("p_partkey").alias("partkey"), entity_name().alias("part_name"))
    return entries(t).join(parts, "partkey")


def summaries(t: Tables) -> DataFrame:
    return R.entity_summary(part_entries(t), "part_name")


def documents(t: Tables, *columns: str) -> DataFrame:
    """Documents for work that costs CPU per text."""
    return spread(t.documents.select("doc_id", *columns), "doc_id")


def document_chunks(t: Tables) -> DataFrame:
    return C.explode_chunks(documents(t, "source", "text"))


def page_chunks(t: Tables) -> DataFrame:
    return C.section_chunks(spread(t.pages.select("page_id", "html"), "page_id"))


def rich_pages(t: Tables) -> DataFrame:
    """Pages with headings of several levels, with a heading that nobody closes, two articles, one with attributes, or none."""
    replaced = lambda c, *pairs: reduce(lambda h, p: F.replace(h, F.lit(p[0]), F.lit(p[1])), pairs, c)
    html = replaced(
        F.col("html"), ("<br>", '<h2 class="k">Part &#38; &eacute;<br/>two</h2>'), (".</p><p>", ".</p><h4>Deep</h4><p>"),
        (", ", " &lt;&#x1F600;&nope;&#0; "),
    )
    kind = F.col("page_id") % 4
    shaped = (
        F.when(kind == 0, replaced(html, ("<article>", '<article class="main" id=a>')))
        .when(kind == 1, replaced(html, ("<article>", "<div>"), ("</article>", "</div>")))
        .when(kind == 2, replaced(html, ("</h1>", "</h1></article><article>")))
        .otherwise(replaced(html, ("</article>", "<h5>open</article>")))
    )
    return spread(t.pages.select("page_id", "html"), "page_id").select("page_id", shaped.alias("html"))


def parsed_documents(t: Tables) -> DataFrame:
    """Every document as parsed JSON: one element per line, short lines as headers."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            i.cast("string").alias("id"),
            F.when(F.length(line) < 20, "header").otherwise("text").alias("type"),
            line.alias("content"),
        ),
    )
    return documents(t, "source", "text").select(
        F.concat(F.lit("/landed/"), "source", F.lit("/"), "doc_id", F.lit(".pdf")).alias("path"),
        doc.to_parsed(lines).alias("parsed_content"),
        F.lit(RUN_ID).alias("processed"),
    )


def papers(t: Tables) -> DataFrame:
    """The labelled documents as papers, with a publication time that follows from their length."""
    return t.documents.join(t.labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("arxiv_id"),
        F.concat_ws(" ", "source", "doc_id").alias("title"),
        F.concat(F.lit("quality "), "quality").alias("summary"),
        F.array("source", "lang").alias("authors"),
        minute_stamp(F.timestamp_seconds(F.lit(FIRST_PAPER) + F.col("n_chars") * 4321)).alias("published"),
    )


def old_snapshot(t: Tables) -> DataFrame:
    return t.documents.filter(F.col("lang") != "de").select("doc_id", "text")


def new_snapshot(t: Tables) -> DataFrame:
    revised = F.concat("text", F.lit("\n(revised)"))
    changed = F.when(F.col("source") == "src3", revised).otherwise(F.col("text"))
    return t.documents.filter(F.col("lang") != "es").select("doc_id", changed.alias("text"))


def sync_sources(t: Tables) -> DataFrame:
    """Event kinds and document languages as names of sources."""
    kinds = t.events.select(F.col("event_type").alias("source_table"))
    languages = t.documents.select(F.col("lang").alias("source_table"))
    return kinds.unionByName(languages).distinct()


def sync_state(t: Tables) -> DataFrame:
    """Last event per kind as the time of the last sync; languages have no row."""
    return t.events.groupBy(F.col("event_type").alias("source_table")).agg(
        F.max(F.col("ts").cast("timestamp")).alias("last_synced")
    )


def queries(t: Tables) -> DataFrame:
    """The benchmark items as search queries; the vector of an item is the one of its number."""
    return t.benchmark.join(t.embeddings, F.col("item_id") == F.col("vec_id"), "left").select(
        F.col("item_id").alias("qid"), "text", "embedding"
    )


def corpus(t: Tables) -> DataFrame:
    """Documents with the vector of their number, where there is one."""
    docs = documents(t, "source", "text")
    return docs.join(t.embeddings, F.col("doc_id") == F.col("vec_id"), "left")


def lookup_requests(t: Tables) -> DataFrame:
    """Part names typed carelessly, and supplier names, which have no summary."""
    typed = F.concat(F.lit("  "), F.initcap(entity_name()), F.lit("\n"))
    return t.part.select(typed.alias("name")).unionByName(t.supplier.select(F.col("s_name").alias("name")))


def stream_events(t: Tables) -> DataFrame:
    """Conversation rows as the events of a stream: assistants' items, finished or begun, messages or tool calls."""
    kind = F.when(F.col("turn") % 4 == 3, "function_call").otherwise("message")
    step = F.when(F.col("role") == "assistant", "response.output_item.done").otherwise("response.output_item.added")
    return t.conversations.select("conv_id", "turn", step.alias("type"), F.struct(kind.alias("type"), "text").alias("item"))


def mixed_answers(t: Tables) -> DataFrame:
    """Assistant messages as JSON of the forms that an agent gives answers in."""
    item = F.struct(F.lit("message").alias("type"), "text")
    form = F.col("conv_id") % 6
    output = (
        F.when(form == 0, F.to_json(F.array(item)))
        .when(form == 1, F.to_json(F.array("text", F.lit("more"))))
        .when(form == 2, F.to_json(F.array(F.struct(F.lit("tool").alias("type")))))
        .when(form == 3, F.lit("[]"))
        .when(form == 4, F.concat(F.lit("12."), F.col("turn")))
        .otherwise(F.col("text"))
    )
    said = t.conversations.filter(F.col("role") == "assistant")
    return said.select("conv_id", "turn", output.alias("output"))


def tool_requests(t: Tables) -> DataFrame:
    """Events as tool calls: two kinds look a part up, one asks for the history, one forgets its
    argument, one names a tool that does not exist."""
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("long")
    parts = t.part.select(F.col("p_partkey"), entity_name().alias("country_name"))
    asked = t.events.withColumn("_k", k).join(parts, F.col("_k") == F.col("p_partkey"), "left")
    name = (
        F.when(kind.isin("view", "click", "signup"), "roast_country")
        .when(kind == "purchase", "predict_winner")
        .otherwise(kind)
    )
    arguments = F.when(
        kind.isin("view", "click"), F.to_json(F.struct("country_name"))
    ).otherwise("{}")
    return asked.select(
        F.col("event_id").alias("request_id"), name.alias("name"), arguments.alias("arguments")
    )
