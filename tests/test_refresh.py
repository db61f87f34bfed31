import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import corpus as C
from corpusforge.plans.refresh import CorpusRefresh, Landed
from corpusforge.scaling import cut_lineage, fits, folders_named, release, salted_join, shared_folder
from corpusforge.streaming import incremental as INC

DOC = "doc_id long, text string"


def test_a_second_run_adds_nothing_and_new_files_do(spark, tmp_path):
    landed, target, checkpoint = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    texts = {i: "word. " * (100 * i) for i in range(1, 6)}
    first = spark.createDataFrame([(i, t) for i, t in texts.items() if i < 4], DOC)
    first.write.parquet(landed)

    def run():
        stream = C.explode_chunks(INC.file_stream(spark, landed, DOC))
        INC.run_available(stream, target, checkpoint)
        return spark.read.parquet(target).count()

    expected = C.explode_chunks(first).count()
    assert run() == run() == expected
    spark.createDataFrame([(i, t) for i, t in texts.items() if i >= 4], DOC).write.mode("append").parquet(landed)
    everything = C.explode_chunks(spark.createDataFrame(list(texts.items()), DOC))
    assert run() == everything.count()
    got = {tuple(r) for r in spark.read.parquet(target).collect()}
    assert got == {tuple(r) for r in everything.collect()}


def test_upserts_see_each_batch(spark, tmp_path):
    landed = str(tmp_path / "landed")
    spark.createDataFrame([(1, "a"), (2, "b")], DOC).write.parquet(landed)
    seen = []
    stream = INC.file_stream(spark, landed, DOC)
    for _ in range(2):
        INC.run_upserts(stream, str(tmp_path / "cp"), lambda df, _: seen.append(df.count()))
    assert sum(seen) == 2


@pytest.fixture
def landed(spark):
    def doc(text):
        return json.dumps({"document": {"elements": [{"id": "0", "type": "text", "content": text}]}})

    papers = spark.createDataFrame(
        [("p1", "One", ["x"], "s", "u", 202401010000), ("p2", "Two", ["y"], "s", "u", 202402010000)],
        "arxiv_id string, title string, authors array<string>, summary string, pdf_url string, published long",
    )
    parsed = spark.createDataFrame(
        [("/in/p1.pdf", doc("first pa-\nper")), ("/in/p2.pdf", doc("second")), ("/in/zz.pdf", doc("unknown"))],
        "path string, parsed_content string",
    )
    html = "<article><h1>T</h1><p>alpha</p><p>beta</p></article>"
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    country = spark.createDataFrame([("Norway", "North")], "country string, region string")
    contest = spark.createDataFrame([(2001, "Norway")], "year int, host string")
    song = spark.createDataFrame(
        [(2001, "Norway", "Fly", "Ann", "no", "pop", 1)],
        "year int, country string, song_name string, artist_name string, language string, style string, final_place int",
    )
    return Landed(papers, parsed, pages, contest, country, song)


def embed(df):
    return df.select("id", "text", "source", F.md5("text").alias("v"))


def test_corpus_refresh(spark, landed):
    day = dt.datetime(2024, 3, 1, tzinfo=dt.UTC)
    one = Landed(landed.papers.filter("arxiv_id = 'p1'"), *list(vars(landed).values())[1:])
    first = CorpusRefresh(spark, "refreshed", day, 202403010000)
    assert first.run(one, embed) == {"papers": True, "pages": True, "entries": True}
    ids = {r["id"]: r["text"] for r in first.table("corpus").collect()}
    assert ids["papers_p1_0"] == "first paper" and "entries_norway" in ids
    assert len(ids) == 3 and ids["pages_1_t_0_0"] == "alpha\n\nbeta"
    assert first.table("corpus_index").count() == 3

    idle = CorpusRefresh(spark, "refreshed", day + dt.timedelta(days=1), 202403020000)
    assert idle.run(one, embed) == {"papers": False, "pages": False, "entries": False}

    more = CorpusRefresh(spark, "refreshed", day + dt.timedelta(days=2), 202403030000)
    assert more.run(landed, embed) == {"papers": True, "pages": False, "entries": False}
    corpus = {r["id"]: r["text"] for r in more.table("corpus").collect()}
    assert set(corpus) == set(ids) | {"papers_p2_0"}
    index = {r["id"]: r["v"] for r in more.table("corpus_index").collect()}
    assert index == {r["id"]: r["v"] for r in embed(more.table("corpus")).collect()}
    assert more.table("papers").filter("ingest_ts IS NULL").count() == 0

    later = CorpusRefresh(spark, "refreshed", day + dt.timedelta(days=180), 202408280000)
    assert later.run(landed, embed) == {"papers": False, "pages": True, "entries": True}


def test_size_decisions(spark):
    df = spark.range(10)
    assert fits(df, 10) and not fits(df, 9) and not fits(df, 10, max_bytes=5)
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert cut_lineage(df).count() == 10


def test_salted_join_equals_plain_join(spark):
    left = spark.range(200).withColumn("k", F.when(F.col("id") < 150, 1).otherwise(F.col("id") % 5))
    right = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    salted = salted_join(left, right, "k", F.col("id"), 7).select("id", "k", "v")
    assert sorted(salted.collect()) == sorted(left.join(right, "k").select("id", "k", "v").collect())


def test_folders_of_a_job_are_released(spark):
    spark.range(3).write.parquet(shared_folder(spark, "before"))
    since = len(folders_named())
    paths = [shared_folder(spark, n) for n in ("one", "two", "three")]
    for path in paths[:2]:
        spark.range(5).write.parquet(path)
    kept = spark.read.parquet(paths[1])
    release(spark, paths[1:2], since)
    assert folders_named()[since:] == paths[1:2] and kept.count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(paths[0])
