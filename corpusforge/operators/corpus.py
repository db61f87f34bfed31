"""From documents, pages and parsed papers to one table of keyed chunks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import text as tx
from corpusforge.functions.dates import stamp_day, stamp_month, stamp_year
from corpusforge.functions.documents import content_sections, heading, page_content, page_summary, page_title, text_elements
from corpusforge.scaling import sized


def explode_chunks(
    df: DataFrame, text: str = "text", size: int = tx.CHUNK_SIZE, index: str = "chunk_idx",
    chunk: str = "chunk", strict: bool = False,
) -> DataFrame:
    """One row per chunk in place of the text column.

    The outer form of explode keeps Catalyst from evaluating the packing a second time in an inferred
    filter; a null text gives no row.
    """
    keep = [c for c in df.columns if c != text]
    return df.select(
        *keep, F.posexplode_outer(tx.chunks(text, size, strict)).alias(index, chunk)
    ).filter(F.col(chunk).isNotNull())


def pages_for_keys(pages: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """One page per wanted key; a key without a page is dropped."""
    return pages.join(keys.select(key).distinct(), key, "left_semi")


def section_chunks(
    pages: DataFrame, key: str = "page_id", html: str = "html", size: int = tx.CHUNK_SIZE,
    unique_ids: bool = False, content: Callable[[Column], Column] = page_content,
    parser: Callable[[Column], Column] = content_sections, titled: Callable[[Column], Column] = heading,
) -> DataFrame:
    """Chunks of every section with text of every page, in document order, with page title and summary on each.

    ``content`` takes what matters from the page column, text or bytes; ``parser`` turns it into
    ``array<struct<level, path, section_title, text>>`` and ``titled`` into the page's title.
    The chunk id is key, section title and position in the section; sections of one page that share a
    title share ids, unless ``unique_ids`` adds the section number. Text ahead of all headings goes by the page's title.
    """
    page_cols = [c for c in pages.columns if c != html]
    # step by step: what is used twice is a column first, and nothing is left to be worked out behind the explode
    cleaned = pages.select(*page_cols, content(F.col(html)).alias("_content"))
    parsed = cleaned.select(*page_cols, titled(F.col("_content")).alias("title"), parser(F.col("_content")).alias("_sections"))
    summed = parsed.select(*page_cols, "title", page_summary(F.col("_sections")).alias("summary"), "_sections")
    sections = summed.select(
        *page_cols, "title", "summary", F.posexplode_outer("_sections").alias("section_idx", "section")
    ).filter(F.col("section").isNotNull())
    own = F.col("section.section_title")
    chunks = explode_chunks(
        sections.select(
            *page_cols, "title", "summary", "section_idx", "section.level", "section.path",
            F.when(F.col("section.level") == 0, F.col("title")).otherwise(own).alias("section_title"), F.col("section.text"),
        ),
        "text", size, "sub_chunk_idx", "chunk",
    )
    parts = [key, tx.slug("section_title"), "sub_chunk_idx"]
    if unique_ids:
        parts.append("section_idx")
    return chunks.withColumnRenamed("chunk", "text").withColumn(
        "chunk_id", tx.strict_concat("_", *parts)
    )


def parsed_elements(parsed: DataFrame, path: str = "path", json: str = "parsed_content") -> DataFrame:
    """``(paper_id, chunk_id, content)`` of the text elements of parsed documents."""
    return (
        parsed.select(
            tx.path_id(path).alias("paper_id"), F.explode_outer(text_elements(json)).alias("chunk")
        )
        .filter(F.col("chunk").isNotNull())
        .select("paper_id", "chunk.chunk_id", "chunk.content")
    )


def broken_documents(parsed: DataFrame, json: str = "parsed_content") -> DataFrame:
    """Parsed documents that are no JSON object, to be set aside instead of failing the run."""
    return parsed.filter(~_is_object(json))


def sound_documents(parsed: DataFrame, json: str = "parsed_content") -> DataFrame:
    """All documents but the broken ones."""
    return parsed.filter(_is_object(json))


def _is_object(json: str) -> Column:
    kind = F.schema_of_variant(F.try_parse_json(json))
    is_object = F.startswith(kind, F.lit("OBJECT")) & F.endswith(tx.strip(json), F.lit("}"))
    return F.coalesce(is_object, F.lit(False))


def paper_chunks(
    parsed: DataFrame, papers: DataFrame, run_id: int | None = None
) -> DataFrame:
    """Clean chunks of the papers of one run, with the metadata of the paper where it is known."""
    if run_id is not None:
        parsed = parsed.filter(F.col("processed") == run_id)
    metadata = papers.select(
        F.col("arxiv_id"),
        "title",
        "summary",
        F.concat_ws(", ", "authors").alias("authors"),
        stamp_year("published").alias("year"),
        stamp_month("published").alias("month"),
        stamp_day("published").alias("day"),
    )
    chunks = parsed_elements(parsed).select(
        F.col("paper_id").alias("arxiv_id"),
        "chunk_id",
        tx.clean("content").alias("text"),
        F.concat_ws("_", "paper_id", "chunk_id").alias("id"),
    )
    return chunks.join(metadata, "arxiv_id", "left")


def unify(sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Union of chunk tables as ``(id, text, source)``; ids are prefixed with the source name."""
    parts = [
        df.select(
            F.concat_ws("_", F.lit(name), F.col(id_col)).alias("id"), "text", F.lit(name).alias("source")
        )
        for name, (df, id_col) in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def chunk_stats(chunks: DataFrame, by: str = "source", text: str = "text") -> DataFrame:
    """Count, lengths and estimated tokens per source in one pass."""
    length = F.length(text)
    return chunks.groupBy(by).agg(
        F.count("*").alias("total_chunks"),
        F.avg(length).alias("avg_length"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
        # Fixed value: about four characters per token.
        (F.avg(length) / 4).alias("est_tokens"),
    )


def duplicate_ids(chunks: DataFrame, key: str = "id") -> DataFrame:
    return chunks.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def unique_ids(chunks: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """Chunks whose colliding ids carry a digest of their text; exact copies become one row.

    Only the colliding rows are touched, the others pass without a shuffle of their texts.
    """
    colliding = sized(duplicate_ids(chunks, key).select(key))
    apart = chunks.join(colliding, key, "left_semi").withColumn(
        key, F.concat_ws("_", key, F.sha2(text, 256))
    )
    alone = chunks.join(colliding, key, "left_anti")
    return alone.unionByName(apart.dropDuplicates([key]))
