import json

from pyspark.sql import functions as F

from corpusforge.functions import documents as D
from corpusforge.operators import corpus as C


def parsed(spark, docs):
    return spark.createDataFrame(docs, "path string, parsed_content string, processed long")


def doc(*elements):
    return json.dumps({"document": {"elements": list(elements)}})


def test_elements(spark):
    rows = [
        ("/p/a.pdf", doc({"id": "1", "type": "text", "content": "x"}, {"type": "text", "content": "y"},
                         {"id": "3", "type": "table", "content": "z"}, {"id": 4, "type": "text"}), 1),
        ("/p/b.pdf", doc(), 1),
        ("/p/c.pdf", "{}", 1),
        ("/p/d.pdf", "{broken", 1),
    ]
    df = parsed(spark, rows)
    got = {tuple(r) for r in C.parsed_elements(df).collect()}
    assert got == {("a", "1", "x"), ("a", "", "y"), ("a", "4", "")}
    assert [r["path"] for r in C.broken_documents(df).collect()] == ["/p/d.pdf"]


def test_broken_documents_are_those_that_are_no_object(spark):
    texts = ['{"a": 1}', " {} ", "[1]", '"s"', "", None, '{"a": 1} x', '{"a": 1']
    df = parsed(spark, [(str(i), t, 1) for i, t in enumerate(texts)])
    assert {int(r["path"]) for r in C.broken_documents(df).collect()} == {2, 3, 4, 5, 6, 7}


def test_paper_chunks(spark):
    papers = spark.createDataFrame(
        [("a", "T", "S", ["x", "y"], 202305141207)],
        "arxiv_id string, title string, summary string, authors array<string>, published long",
    )
    element = {"id": "e", "type": "text", "content": "docu-\nments  here"}
    df = parsed(spark, [("/p/a.pdf", doc(element), 7), ("/p/b.pdf", doc(element), 7),
                        ("/p/c.pdf", doc(element), 8)])
    got = {r["id"]: r for r in C.paper_chunks(df, papers, 7).collect()}
    assert set(got) == {"a_e", "b_e"}
    a = got["a_e"]
    assert (a["text"], a["authors"], a["year"], a["month"], a["day"]) == ("documents here", "x, y", 2023, 5, 14)
    assert got["b_e"]["title"] is None


PAGE = (
    "<html><article><h1>A <b>B</b></h1>lead<!-- no --><p>one</p><script>x('</p>')</script>"
    "<p class='k'>   </p><p>two <i>x</i></p></article></html>"
)


def test_section_chunks(spark):
    pages = spark.createDataFrame([(7, PAGE), (8, "<html></html>"), (9, None)], "page_id long, html string")
    got = C.section_chunks(pages).orderBy("section_idx").collect()
    assert [(r["page_id"], r["text"], r["chunk_id"]) for r in got] == [(7, "lead\n\none\n\ntwo x", "7_a_b_0")]
    twice = pages.withColumn("html", F.replace("html", F.lit("<p>two"), F.lit("<h2>A B</h2><p>two")))
    assert [r["n"] for r in C.duplicate_ids(C.section_chunks(twice), "chunk_id").collect()] == [2]
    unique = C.section_chunks(twice, unique_ids=True)
    assert C.duplicate_ids(unique, "chunk_id").count() == 0


def test_pages_for_keys(spark):
    pages = spark.createDataFrame([(1, "u"), (2, "v")], "page_id long, url string")
    keys = spark.createDataFrame([(2,), (2,), (5,)], "page_id long")
    assert [tuple(r) for r in C.pages_for_keys(pages, keys, "page_id").collect()] == [(2, "v")]


def test_unify_and_stats(spark):
    a = spark.createDataFrame([("1", "aaaa"), ("1", "bb")], "id string, text string")
    b = spark.createDataFrame([("cccc", "1")], "text string, chunk_id string")
    both = C.unify({"a": (a, "id"), "b": (b, "chunk_id")})
    assert sorted(tuple(r) for r in both.collect()) == [
        ("a_1", "aaaa", "a"), ("a_1", "bb", "a"), ("b_1", "cccc", "b")
    ]
    stats = {r["source"]: r for r in C.chunk_stats(both).collect()}["a"]
    assert tuple(stats)[1:] == (2, 3.0, 2, 4, 0.75)


def test_unique_ids(spark):
    rows = [("x", "a", "s"), ("x", "b", "s"), ("x", "b", "s"), ("y", "a", "s")]
    df = spark.createDataFrame(rows, "id string, text string, source string")
    got = C.unique_ids(df).collect()
    assert len(got) == len({r["id"] for r in got}) == 3
    assert sorted(r["text"] for r in got) == ["a", "a", "b"]


def test_round_trip_of_parsed_json(spark):
    from pyspark.sql import functions as F

    df = spark.range(1).select(
        D.to_parsed(
            F.array(F.struct(F.lit("1").alias("id"), F.lit("text").alias("type"), F.lit('"q"\n').alias("content")))
        ).alias("j")
    )
    assert json.loads(df.first()["j"])["document"]["elements"][0]["content"] == '"q"\n'
