"""Expressions over parsed documents: JSON elements and the sections of a web page."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusforge.functions.text import WS, col, let

PARSED_SCHEMA = "document struct<elements:array<struct<id:string,type:string,content:string>>>"


def text_elements(parsed: Column | str) -> Column:
    """``array<struct<chunk_id, content>>`` of the elements of type text; null for broken JSON.

    A missing id or content becomes an empty string.
    """
    elements = F.from_json(col(parsed), PARSED_SCHEMA)["document"]["elements"]
    return F.transform(
        F.filter(elements, lambda e: e["type"] == "text"),
        lambda e: F.struct(
            F.coalesce(e["id"], F.lit("")).alias("chunk_id"),
            F.coalesce(e["content"], F.lit("")).alias("content"),
        ),
    )


def to_parsed(elements: Column) -> Column:
    """JSON document around an ``array<struct<id, type, content>>``."""
    return F.to_json(F.struct(F.struct(elements.alias("elements")).alias("document")))


def _without_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]*>", "")


def page_title(html: Column | str) -> Column:
    return _without_tags(F.regexp_extract(col(html), "(?s)<h1>(.*?)</h1>", 1))


# --- the section tree of a page ------------------------------------------------------------------

_TAG_END = r"(?:[ \t\n\f\r/][^>]*)?>"
_HIDDEN = "|".join(f"<{t}{_TAG_END}.*?</{t}{_TAG_END}" for t in ("script", "style", "noscript", "template")) + "|<!--.*?-->"
_AROUND = "|".join(f"<{t}{_TAG_END}.*?</{t}{_TAG_END}" for t in ("head", "nav", "header", "footer", "aside", "form"))
# Elements that begin and end a line of their own.
_BLOCKS = (
    "address article aside blockquote body dd div dl dt fieldset figcaption figure footer form header hr html li main nav ol p "
    "pre section table tbody td tfoot th thead tr ul h1 h2 h3 h4 h5 h6"
).split()
_MARK = "\x01"  # no page may hold this character
# named references of one code point, as the standard library lists them
ENTITIES = {name: chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'"}


def decode_entities(text: Column) -> Column:
    """Character references as characters; what is none, or names no character, stays as it is."""
    named = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def character(name: Column) -> Column:
        """The character of a reference, null if it names none."""
        hexadecimal = F.lower(F.substring(name, 2, 1)) == "x"
        number = F.when(hexadecimal, F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(F.substring(name, 2, 7)).try_cast("int")
        numeric = let(
            number,
            lambda code: F.when(
                code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
            ),
        )
        return F.when(F.startswith(name, F.lit("#")), numeric).when(name != "", F.try_element_at(named, name))

    def decoded(piece: Column) -> Column:
        name = F.regexp_extract(piece, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        # inside a lambda nothing is worked out once for several places but by ``let``
        joined = let(name, lambda n: F.concat(character(n), F.substring(piece, F.char_length(n) + 2, F.char_length(piece))))
        return F.coalesce(joined, F.concat(F.lit("&"), piece))

    def whole(pieces: Column) -> Column:
        later = F.transform(F.slice(pieces, 2, F.size(pieces)), decoded)
        return F.concat(F.element_at(pieces, 1), F.array_join(later, ""))

    return F.when(F.contains(text, F.lit("&")), let(F.split(text, "&", -1), whole)).otherwise(text)


def _one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"{WS}+", " "))


def _inline_text(markup: Column) -> Column:
    return _one_line(decode_entities(F.regexp_replace(markup, "<[/!?a-zA-Z][^>]*>", "")))


def _block_text(markup: Column) -> Column:
    """Text of the blocks of a piece of markup, each on one line, with an empty line between."""
    broken = F.regexp_replace(markup, f"(?i)</?(?:{'|'.join(_BLOCKS)}){_TAG_END}", _MARK)
    spaced = F.regexp_replace(broken, f"(?i)<br{_TAG_END}", " ")
    blocks = F.transform(F.split(spaced, _MARK, -1), _inline_text)
    return F.array_join(F.filter(blocks, lambda b: b != ""), "\n\n")


def page_content(html: Column | str) -> Column:
    """Markup of all articles of a page; of the body, less what stands around an article, where there is none."""
    visible = F.regexp_replace(F.replace(col(html), F.lit(_MARK), F.lit("")), f"(?is){_HIDDEN}", "")

    def content(page: Column) -> Column:
        articles = F.regexp_extract_all(page, F.lit(f"(?is)<article{_TAG_END}(.*?)</article{_TAG_END}"), F.lit(1))
        inner = F.regexp_replace(page, f"(?is){_AROUND}", "")
        return F.when(F.size(articles) > 0, F.array_join(articles, "<hr>")).otherwise(inner)

    return let(visible, content)


def page_sections(html: Column | str) -> Column:
    """``content_sections`` of a page."""
    return content_sections(page_content(html))


def content_sections(content: Column) -> Column:
    """``array<struct<level, path, section_title, text>>``: the sections with text, in document order.

    A heading opens a section of its level, which holds the text up to the next heading of any level; ``path`` is the titles of the
    sections around it and its own. Text ahead of the first heading is a section of level 0 without a title.
    """
    marked = F.regexp_replace(content, r"(?i)<h([1-6][ \t\n\f\r/>])", f"{_MARK}<h$1")
    opening = r"(?is)^<h[1-6](?:[ \t\n\f\r/][^>]*)?>"

    def parsed(part: Column, i: Column) -> Column:
        def headed(closing: Column) -> Column:
            title = F.when(i == 0, "").otherwise(_inline_text(F.regexp_replace(closing, opening, "")))
            body = F.when(i == 0, part).otherwise(F.substring(part, F.char_length(closing) + 1, F.char_length(part)))
            return F.struct(level.alias("level"), title.alias("title"), _block_text(body).alias("text"))

        level = F.when(i == 0, 0).otherwise(F.substring(part, 3, 1).try_cast("int"))
        return let(F.regexp_extract(part, r"(?is)^(.*?</h[1-6][ \t\n\f\r]*>)", 1), headed)

    def nested(state: Column, one: Column) -> Column:
        here = F.struct(one["level"].alias("level"), one["title"].alias("title"))
        opened = F.concat(F.filter(state["open"], lambda o: o["level"] < one["level"]), F.array(here))
        return let(
            F.when(one["level"] > 0, opened).otherwise(state["open"]),
            lambda around: F.struct(
                around.alias("open"), F.concat(state["paths"], F.array(F.transform(around, lambda o: o["title"]))).alias("paths")
            ),
        )

    start = F.struct(
        F.array().cast("array<struct<level:int,title:string>>").alias("open"), F.array().cast("array<array<string>>").alias("paths")
    )

    def with_paths(parts: Column) -> Column:
        titles = F.transform(parts, lambda p: F.struct(p["level"].alias("level"), p["title"].alias("title")))
        paths = F.aggregate(titles, start, nested, lambda s: s["paths"])
        zipped = F.zip_with(
            parts, paths,
            lambda p, path: F.struct(p["level"].alias("level"), path.alias("path"), p["title"].alias("section_title"), p["text"].alias("text")),
        )
        return F.filter(zipped, lambda s: s["text"] != "")

    return let(F.transform(F.split(marked, _MARK, -1), parsed), with_paths)


def heading(content: Column) -> Column:
    """Text of the first heading of level 1 of a page's content, empty if there is none."""
    return _inline_text(F.regexp_extract(content, f"(?is)<h1{_TAG_END}(.*?)</h1", 1))


def page_summary(sections: Column) -> Column:
    """First paragraph ahead of all headings below level 1, of the result of ``page_sections``; empty if there is none."""
    lead = F.get(F.filter(sections, lambda s: s["level"] <= 1), F.lit(0))
    return F.coalesce(F.substring_index(lead["text"], "\n\n", 1), F.lit(""))
