"""Main text of web pages as the maximum-scoring run of words and tags.

A page is read as a sequence of words and tags. Words score positive, tags negative; how much is learnt from pages whose
article is marked: a tag that stands outside articles costs more than one that stands in them. One linear scan finds the
contiguous run with the largest sum, which is the content. Menus, forms, notices and the like, told by their
elements, classes, ids and roles, score nothing and are left out wherever they stand.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNSEEN = -0.1  # a tag that no labelled page has: less than a word, so that tables and lists stay where they stand
SAMPLE = 5000  # labelled pages from which weights are learnt, the smallest by a seeded hash

# fixed values: elements of HTML by their part in a page
ASIDE = frozenset(
    "head title nav header footer aside form button select textarea input dialog script style noscript template iframe "
    "svg object canvas audio video menu".split()
)
RAW = frozenset(["script", "style", "textarea", "title", "noscript", "iframe", "template"])
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer comment comments disqus cookie cookies consent gdpr notice alert "
    "newsletter subscribe signup share sharing social related recommended popup modal paywall widget toolbar pagination "
    "complementary contentinfo search".split()
)
CONTENT = frozenset(["article", "main"])

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|([^<]+|<)",
    re.DOTALL,
)
HINTS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORDS = re.compile(r"[^\W\d_]+")

Batches = Iterator[pa.RecordBatch]


def tokens(page: str) -> Iterator[tuple[str, str, bool]]:
    """(tag, text, aside): tag is like ``p`` or ``/p`` and empty for text; aside is whether the token is no content."""
    at, n = 0, len(page)
    inside, depth, depth_content = "", 0, 0  # the element that is left out just now
    while at < n:
        found = TOKEN.match(page, at)
        at = found.end()
        close, name, rest = found[1], found[2], found[3]
        if name is None:
            close, name, rest = found[4], found[5], found[6]
        if name is None:
            if found[7] is not None:
                yield "", found[7], bool(inside)
            continue
        name = name.lower()
        tag = close + name
        if not close and name in RAW and not rest.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
            continue
        depth_content = max(0, depth_content + (-1 if close else 1)) if name in CONTENT else depth_content
        if inside:
            if name in CONTENT and not close:
                inside = ""  # an article never lies in a menu that was not closed
            elif name == inside:
                # a paragraph or item in one of its kind means that the first was not closed
                depth += -1 if close else 0 if name in ("p", "li") else 1
                if depth == 0:
                    inside = ""
                yield tag, "", True
                continue
            elif inside == "p" and not close and name not in INLINE:
                inside = ""
            else:
                yield tag, "", True
                continue
        if not close and _aside(name, rest, depth_content > 0):
            if name not in VOID and not rest.endswith("/"):
                inside, depth = name, 1
            yield tag, "", True
            continue
        yield tag, "", False


def _aside(name: str, rest: str, in_content: bool) -> bool:
    if name in ASIDE:
        return not (name == "header" and in_content)  # the head of an article is its title
    if name in CONTENT or name in ("body", "html") or "=" not in rest:
        return False
    for hint in HINTS.finditer(rest):
        value = html.unescape(hint[1] or hint[2] or hint[3] or "").lower()
        if any(word in ASIDE_WORDS for word in WORDS.findall(value)):
            return True
    return False


def count_tags(batches: Batches) -> Batches:
    """(token, inside, n) over pages with a marked article; words count under the empty token."""
    totals: dict[tuple[str, bool], int] = {}
    for batch in batches:
        for page in batch.column(0).to_pylist():
            depth = 0
            for tag, text, aside in tokens(page or ""):
                if tag in ("/article", "/main"):
                    depth = max(0, depth - 1)
                if not aside:
                    key = (tag, depth > 0)
                    totals[key] = totals.get(key, 0) + (1 if tag else len(text.split()))
                if tag in ("article", "main"):
                    depth += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in totals], pa.string()), pa.array([k[1] for k in totals], pa.bool_()),
         pa.array(list(totals.values()), pa.int64())],
        ["token", "inside", "n"],
    )


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Words score up to 1, tags between -0.01 and the log odds that they stand in an article."""
    out = {}
    for token in {t for t, _ in counts} | {""}:
        into, beside = counts.get((token, True), 0), counts.get((token, False), 0)
        odds = math.log((into + 1) / (beside + math.e))
        out[token] = min(1.0, max(0.1, odds)) if token == "" else min(-0.01, odds)
    if not any(inside for _, inside in counts):
        out[""] = 1.0
    return out


def main_text(page: str, scores: dict[str, float]) -> str:
    """Blocks of the best run, white space within a block as one blank, blocks by line breaks."""
    sequence = list(tokens(page))
    best = (0.0, 0, 0)
    run, start = 0.0, 0
    for k, (tag, text, aside) in enumerate(sequence):
        if run <= 0:
            run, start = 0.0, k
        if not aside:
            run += scores.get(tag, UNSEEN) if tag else scores[""] * len(text.split())
        if run > best[0]:
            best = (run, start, k + 1)
    blocks: list[list[str]] = [[]]
    for tag, text, aside in sequence[best[1] : best[2]]:
        name = tag.removeprefix("/")
        if name == "br":
            blocks[-1].append(" ")
        elif tag and name not in INLINE:
            blocks.append([])
        elif not tag and not aside:
            blocks[-1].append(text)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract(shared) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        scores = shared.value
        for batch in batches:
            texts = [main_text(page or "", scores) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return run


def main_texts(pages: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Weights come from ``labelled`` (html with a marked article), by default from the pages that have one. Null and empty
    pages have an empty text. Rows may repeat and ids may be null. Columns beyond page_id, url and html are not looked
    at. Without labelled pages words score 1 and tags ``UNSEEN``. No rows give no rows.
    """
    spark = pages.sparkSession
    known = pages if labelled is None else labelled
    marked = known.filter(F.lower("html").rlike("<(article|main)[\\s>]")).select("html", F.xxhash64("html").alias("h"))
    sample = marked.filter(F.col("h").isNotNull()).select("h").distinct().orderBy("h").limit(SAMPLE)
    chosen = marked.join(F.broadcast(sample), "h", "left_semi").select("html")
    counted = chosen.mapInArrow(count_tags, "token string, inside boolean, n long")
    # as many as the sample has tag names
    totals = counted.groupBy("token", "inside").agg(F.sum("n").alias("n")).collect()
    shared = spark.sparkContext.broadcast(weights({(t, i): n for t, i, n in totals}))
    types = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(
        extract(shared), f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long"
    )
