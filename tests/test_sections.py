"""The section tree of pages against a parse with the standard library."""

import html as entities
import random
import re

from pyspark.sql import functions as F

from corpusforge.functions import documents as doc
from corpusforge.operators import corpus as C


def sections(spark, *pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id long, html string")
    rows = df.select("page_id", doc.page_sections("html").alias("s")).orderBy("page_id").collect()
    return [None if r["s"] is None else [(s["level"], list(s["path"]), s["section_title"], s["text"]) for s in r["s"]] for r in rows]


def test_headings_nest(spark):
    page = """<html><body><nav>menu</nav><article class="x"><h1 id=t>Top</h1><p>lead <b>b</b>old</p><p>second</p>
      <h2>A &amp; B</h2>text<div>block</div><h4>deep</h4><p>x</p><h3>less</h3>y<h2></h2><p>untitled</p><h3>empty</h3>   </article></body></html>"""
    assert sections(spark, page)[0] == [
        (1, ["Top"], "Top", "lead bold\n\nsecond"),
        (2, ["Top", "A & B"], "A & B", "text\n\nblock"),
        (4, ["Top", "A & B", "deep"], "deep", "x"),
        (3, ["Top", "A & B", "less"], "less", "y"),
        (2, ["Top", ""], "", "untitled"),
    ]


def test_all_articles_or_the_body(spark):
    two = "<body><aside>no</aside><article>one</article><p>between</p><ARTICLE id='2'><h2>T</h2>two</ARTICLE></body>"
    none = "<html><head><title>no</title></head><body><header>no</header><h2>T</h2><p>yes</p><footer>no</footer></body></html>"
    bare = "just <i>text</i>"
    assert sections(spark, two, none, bare, "", None) == [
        [(0, [], "", "one"), (2, ["T"], "T", "two")], [(2, ["T"], "T", "yes")], [(0, [], "", "just text")], [], None
    ]


def test_odd_markup(spark):
    pages = [
        "<article><h2>open<p>rest</article>",  # a heading that nobody closes
        "<article><pre>a\n b</pre><param>c</article>",
        "<article>1 < 2 <!-- <h2>no</h2> --><script>'<h2>no</h2>'</script> &lt;h2&gt; <style>p{}</style></article>",
        "<article>x<hr/>y<br/>z\x01w</article>",
    ]
    assert sections(spark, *pages) == [
        [(2, [""], "", "open\n\nrest")], [(0, [], "", "a b\n\nc")], [(0, [], "", "1 < 2 <h2>")], [(0, [], "", "x\n\ny zw")]
    ]


def test_entities_equal_the_standard_library(spark):
    rng = random.Random(1)
    known = ["&amp;", "&eacute;", "&#233;", "&#xE9;", "&#X1F600;", "&lt;", "&hellip;", "&apos;", "x", " ", "&", ";", "&nope;", "#"]
    texts = ["".join(rng.choice(known) for _ in range(12)) for _ in range(200)] + ["&#0;", "&#xD800;", "&#9999999;", "&", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", doc.decode_entities(F.col("t")).alias("d")).collect():
        want = re.sub(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", lambda m: keep(m[0]), r["t"])
        assert r["d"] == want


def keep(reference):
    number = re.fullmatch(r"&#(x?)([0-9a-fA-F]+);", reference.replace("X", "x", 1))
    if number:
        code = int(number[2], 16 if number[1] else 10)
        return chr(code) if 0 < code < 0xD800 or 0xDFFF < code < 0x110000 else reference
    return entities.unescape(reference) if reference[1:-1] in doc.ENTITIES else reference


def test_chunks_carry_title_summary_and_path(spark):
    page = "<article><h1>T</h1><p>lead</p><p>more</p><h2>S S</h2><p>" + "word. " * 300 + "</p></article>"
    df = spark.createDataFrame([(7, "u", page)], "page_id long, url string, html string")
    got = C.section_chunks(df).orderBy("section_idx", "sub_chunk_idx").collect()
    assert [(r["section_idx"], r["sub_chunk_idx"], r["chunk_id"]) for r in got] == [(0, 0, "7_t_0"), (1, 0, "7_s_s_0"), (1, 1, "7_s_s_1")]
    assert {(r["title"], r["summary"], r["url"]) for r in got} == {("T", "lead", "u")}
    assert [list(r["path"]) for r in got] == [["T"], ["T", "S S"], ["T", "S S"]]


def test_the_parser_is_an_argument(spark):
    df = spark.createDataFrame([(1, bytearray(b"<article><h1>T</h1>caf\xc3\xa9</article>"))], "page_id long, html binary")
    chunks = C.section_chunks(df, content=lambda c: doc.page_content(F.decode(c, "UTF-8"))).collect()
    assert [(r["title"], r["text"]) for r in chunks] == [("T", "café")]
    lines = lambda c: F.transform(
        F.split(c, "\n"), lambda t, i: F.struct(F.lit(2).alias("level"), F.array(t).alias("path"), t.alias("section_title"), t.alias("text"))
    )
    plain = spark.createDataFrame([(1, "a\nb")], "page_id long, html string")
    assert [r["chunk_id"] for r in C.section_chunks(plain, content=lambda c: c, parser=lines).orderBy("section_idx").collect()] == ["1_a_0", "1_b_0"]
