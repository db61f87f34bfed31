"""Lookups, histories, tool requests and conversations as operators over tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.functions.text import request_slug

# Fixed value: the answer for an unknown key, with the line break and indent of its wording.
MISSING = """No data found for country: {name}.
                                    Maybe they never qualified?"""
HISTORY_TOOL = "predict_winner"
LOOKUP_TOOL = "roast_country"
TURN_CAP = 10

HISTORY_BYTES = 65_536
RANGE_DIGITS = 3


def _json(**fields: Column) -> Column:
    built = F.struct(*[c.alias(name) for name, c in fields.items()])
    return F.to_json(built, {"ignoreNullFields": "false"})


def lookup_with_fallback(requests: DataFrame, summaries: DataFrame, name: str = "name") -> DataFrame:
    """Every request with the summary of its key as JSON, or an error as JSON: ``found``, ``part``, ``json``.

    A summary of several parts answers with one row per part.
    """
    keyed = requests.withColumn("_slug", request_slug(name))
    stats = summaries.select(F.col("chunk_id").alias("_slug"), "part", F.col("text").alias("_text"))
    found = F.col("_text").isNotNull()
    before, after = MISSING.split("{name}")
    error = F.concat(F.lit(before), F.col(name), F.lit(after))
    return keyed.join(stats, "_slug", "left").select(
        *requests.columns,
        found.alias("found"),
        "part",
        F.when(found, _json(country=F.col(name), stats=F.col("_text")))
        .otherwise(_json(error=error))
        .alias("json"),
    )


def history_json(
    summaries: DataFrame, year: int, limit: int = HISTORY_BYTES, by: list[str] | None = None
) -> DataFrame:
    """All summaries as JSON documents of about ``limit`` bytes per group: ``(document, n, json)``, numbered from 0.

    Rows lie in the order of the digests of their keys, and a row belongs to the document that its first byte falls into. So a document
    is no longer than ``limit`` and its last row, however large the table is. Two passes: bytes per range of
    digests, whose sums are the offsets of the ranges, then offsets inside each range.
    """
    groups = by or []
    item = _json(country=F.col("chunk_id"), stat=F.col("text"))
    digest = F.md5(F.concat_ws("/", "chunk_id", "part"))
    rows = summaries.select(
        *groups, "chunk_id", "part", "text", digest.alias("_digest"), (F.octet_length(item) + 1).alias("_bytes")
    )
    rows = rows.withColumn("_range", F.left("_digest", F.lit(RANGE_DIGITS)))
    # at most 16 ** RANGE_DIGITS rows a group, whatever the table
    ranges = rows.groupBy(*groups, "_range").agg(F.sum("_bytes").alias("_all"))
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        *[F.col(g).alias(f"_{g}") for g in groups], F.col("_range").alias("_of"), F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_start")
    )
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups] + [F.col("_range") == F.col("_of")]
    placed = rows.join(F.broadcast(starts) if not groups else starts, reduce(lambda a, b: a & b, same))
    inside = Window.partitionBy(*groups, "_range").orderBy("_digest", "chunk_id", "part", "text")
    before = F.col("_start") + F.sum("_bytes").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_bytes")
    dealt = placed.withColumn("document", F.floor(before / limit).cast("long"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("chunk_id").alias("country"), "part", F.col("text").alias("stat"))))
    items = F.transform(ordered, lambda i: F.struct(i["country"], i["stat"]))
    return dealt.groupBy(*groups, "document").agg(
        F.count("*").alias("n"),
        _json(year=F.lit(year), historical_data=items).alias("json"),
    )


def history_keys(summaries: DataFrame, limit: int = HISTORY_BYTES) -> Column:
    """JSON that names the documents of ``history_json``: their numbers lie from ``first`` to ``last``."""
    size = F.octet_length(_json(country=F.col("chunk_id"), stat=F.col("text"))) + 1
    last = summaries.select(F.floor((F.sum(size) - 1) / limit).alias("last")).scalar()
    return _json(table=F.lit("history_json"), first=F.lit(0), last=last)


def dispatch(requests: DataFrame, summaries: DataFrame) -> DataFrame:
    """Answers of tool requests ``(request_id, name, arguments)``: ``(request_id, tool, part, output)``.

    Lookups are answered by one join. A history request is answered with the keys of the documents of ``history_json``, which
    are built once and not copied into every answer. Unknown tools and missing arguments become text.
    """
    parsed = requests.withColumn("_country", F.get_json_object("arguments", "$.country_name"))
    tool = F.col("name")
    is_lookup = tool.eqNullSafe(LOOKUP_TOOL) & F.col("_country").isNotNull()
    lookups = parsed.filter(is_lookup)
    answered = lookup_with_fallback(lookups, summaries, "_country").select(
        "request_id", tool.alias("tool"), "part", F.col("json").alias("output")
    )
    others = parsed.filter(~is_lookup)
    text = (
        F.when(tool == HISTORY_TOOL, history_keys(summaries))
        .when(
            tool == LOOKUP_TOOL,
            F.lit(f"Tool error: {LOOKUP_TOOL}() missing 1 required positional argument: 'country_name'"),
        )
        .otherwise(F.concat(F.lit("Unknown tool: "), F.coalesce(tool, F.lit("None"))))
    )
    return answered.unionByName(
        others.select(
            "request_id", tool.alias("tool"), F.lit(None).cast("long").alias("part"), text.alias("output")
        )
    )


def output_messages(events: DataFrame) -> DataFrame:
    """Finished message items of a table of stream events ``(type, item struct<type, ...>)``."""
    return events.filter(
        (F.col("type") == "response.output_item.done") & (F.col("item.type") == "message")
    )


def assistant_messages(conversations: DataFrame) -> DataFrame:
    return conversations.filter(F.col("role") == "assistant").select("conv_id", "turn", "text")


def last_answers(conversations: DataFrame) -> DataFrame:
    """The last assistant message of every conversation."""
    return (
        assistant_messages(conversations)
        .groupBy("conv_id")
        .agg(F.max("turn").alias("turn"), F.max_by("text", "turn").alias("text"))
    )


def conversation_outcome(conversations: DataFrame, cap: int = TURN_CAP) -> DataFrame:
    """Whether a conversation ended with the assistant, ran into the turn cap, or is open.

    Turn and speaker travel in one number, so that the aggregate hashes and never sorts.
    """
    by_assistant = F.when(F.col("role") == "assistant", 1).otherwise(0)
    ends = conversations.groupBy("conv_id").agg(
        F.count("*").alias("turns"), F.max(F.col("turn") * 2 + by_assistant).alias("_last")
    )
    return ends.select(
        "conv_id",
        "turns",
        F.when(F.col("_last") % 2 == 1, "answered")
        .when(F.col("turns") >= cap, "max_iterations")
        .otherwise("open")
        .alias("outcome"),
    )
