"""Stored indexes against the scans: same results, fewer reads."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.operators import postings as PO
from corpusforge.operators import search as S
from corpusforge.operators import vector_index as VI
from tests.test_search import bm25, brute, frames, ranked, text_frames, texts, vectors  # noqa: F401


def clustered(spark, n=3000, dim=16, centres=40, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(centres, dim))
    points = middles[rng.integers(0, centres, n)] + rng.normal(size=(n, dim)) * 0.15
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in p], i % 4) for i, p in enumerate(points)]
    corpus = spark.createDataFrame(rows, "id long, embedding array<float>, label int")
    return corpus, corpus.filter("id % 60 = 0").select(F.col("id").alias("qid"), "embedding")


def test_cells_are_the_same_in_every_run(spark):
    corpus, _ = clustered(spark)
    one = VI.train_cells(corpus.repartition(7), 30)
    other = VI.train_cells(corpus.repartition(2, "label"), 30)
    assert one.shape == (30, 16) and np.array_equal(one, other)
    near = ((np.array([r["embedding"] for r in corpus.collect()])[:, None] - one[None]) ** 2).sum(axis=2).min(axis=1)
    assert near.mean() < 0.5  # a random vector is 2 away


def test_probing_finds_nearly_all_and_reads_few_cells(spark, tmp_path):
    corpus, q = clustered(spark)
    index = VI.build(corpus, str(tmp_path / "i"), n_cells=60)
    assert index.cells.agg(F.sum("n")).first()[0] == 3000
    exact = S.vector_topk(q, corpus, 10)
    assert index.probes <= 6
    few = VI.query_index(q, index, 10)
    counts = VI.recall(few, exact).agg(F.sum("n_found"), F.sum("n_true")).first()
    assert counts[0] >= 0.95 * counts[1] and counts[1] == 500
    one = VI.query_index(q.limit(1), index, 10, probes=4)
    # one query reads the folders of its four cells, and no other
    named = re.search(r"PartitionFilters: \[(.*?)\]", one._jdf.queryExecution().executedPlan().toString())[1]
    assert re.search(r"cell#\d+ IN \(\d+,\d+,\d+,\d+\)", named)


def test_probes_follow_the_recall_asked_for(spark, vectors, tmp_path):  # noqa: F811
    c, q = frames(spark, vectors)
    exact = S.vector_topk(q, c, 10)
    shares = []
    for i, recall in enumerate((0.5, 0.95, 1.0)):
        index = VI.build(c, str(tmp_path / str(i)), n_cells=20, recall=recall)
        found = VI.recall(VI.query_index(q, index, 10), exact).agg(F.sum("n_found") / F.sum("n_true")).first()[0]
        shares.append((index.probes, found))
    assert shares == sorted(shares) and shares[1][1] >= 0.9 and shares[0][0] < shares[1][0]


def test_exact_search_equals_the_scan_and_skips_cells(spark, tmp_path):
    corpus, q = clustered(spark)
    index = VI.build(corpus, str(tmp_path / "i"), n_cells=60, keep=["label"])
    for filters in (None, {"label": 2}):
        exact = VI.query_index(q, index, 7, probes=2, exact=True, filters=filters)
        assert ranked(exact) == ranked(S.vector_topk(q, corpus, 7, filters))
    assert ranked(VI.query_index(q, index, 7, exact=True, block=9)) == ranked(S.vector_topk(q, corpus, 7))
    cells = index.cells.orderBy("cell").toArrow()
    plan = VI._Plan(q.select("qid", F.col("embedding").alias("vector")).toArrow(), cells)
    floors = {r["qid"]: r["score"] for r in S.vector_topk(q, corpus, 7).filter("rank = 7").collect()}
    assert plan.open(floors, 7).mean() < 0.7  # the rest is proven to hold nothing


def test_exact_search_on_vectors_without_clusters(spark, vectors, tmp_path):  # noqa: F811
    c, q = frames(spark, vectors)
    index = VI.build(c, str(tmp_path / "i"))
    assert ranked(VI.query_index(q, index, 7, probes=1, exact=True)) == brute(vectors, 7)


def test_odd_vectors_are_not_indexed(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [1.0]), (None, [0.0, 1.0]), (7, []), (8, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").withColumn("cell", F.lit("clash"))
    index = VI.build(df, str(tmp_path / "i"))
    q = spark.createDataFrame([("a", [1.0, 0.1]), ("b", None), ("c", [1.0])], "qid string, embedding array<double>")
    found = VI.query_index(q, index, 5, exact=True)
    assert [(r["qid"], r["id"]) for r in found.orderBy("rank").collect()] == [("a", 1), ("a", None), ("a", 8)]
    empty = VI.build(df.limit(0), str(tmp_path / "e"))
    assert VI.query_index(q, empty, 5).count() == 0


def test_search_takes_ids_of_any_type_and_vectors_of_any_length(spark):
    c = spark.sql("SELECT DATE'2024-01-01' + CAST(id AS INT) AS id, array(1.0D, CAST(id AS DOUBLE)) AS embedding FROM range(5)")
    c = c.unionByName(spark.sql("SELECT DATE'2020-01-01' AS id, array(9.0D) AS embedding"))
    q = spark.createDataFrame([(1, [0.0, 1.0])], "qid int, embedding array<double>")
    found = S.vector_topk(q, c, 2).orderBy("rank").collect()
    assert [str(r["id"]) for r in found] == ["2024-01-05", "2024-01-04"]


def test_more_cells_than_a_task_holds_are_assigned_by_a_join(spark, monkeypatch):
    corpus, _ = clustered(spark, 400)
    cells = corpus.filter("id < 9").select(F.col("id").alias("cell"), "embedding")
    for n, name in ((1, "cell"), (3, "probe")):
        there = {r["id"]: r[name] for r in S.assign_cells(corpus, cells, n).collect()}
        monkeypatch.setattr(S, "MAX_CELLS", 4)
        assert {r["id"]: r[name] for r in S.assign_cells(corpus, cells, n).collect()} == there
        monkeypatch.undo()


@pytest.fixture(scope="module")
def topics(spark):
    """Texts in groups with words of their own, and one word that all share."""
    rng = random.Random(4)
    docs = {}
    for group in range(20):
        own = [f"g{group}w{i}" for i in range(12)]
        for _ in range(30):
            docs[len(docs)] = " ".join(rng.choices([*own, "the"], k=rng.randint(3, 40)))
    docs[len(docs)] = ""
    queries = {g: f"g{g}w1 g{g}w2 the" for g in range(0, 20, 3)} | {100: "the", 101: "absent", 102: ""}
    return queries, docs


@pytest.mark.parametrize("fit", [True, False])
def test_blocks_give_the_result_of_the_scan(spark, texts, tmp_path, monkeypatch, fit):  # noqa: F811
    q, d = text_frames(spark, texts)
    if not fit:
        monkeypatch.setattr(PO, "fits", lambda df: False)
    index = PO.build(d, str(tmp_path / "i"), block_postings=64, slices=8)
    assert ranked(PO.blocked_topk(q, index, 6, first=2)) == bm25(*texts, 6)


def test_blocks_that_cannot_reach_the_top_are_not_read(spark, topics, tmp_path):
    q, d = text_frames(spark, topics)
    index = PO.build(d, str(tmp_path / "i"), block_postings=80, slices=8)
    found, every, read = PO._search(q, index, 5, "qid", "text", 2)
    assert ranked(found) == bm25(*topics, 5)
    assert read.join(every, ["qid", "block"], "left_anti").count() == 0
    assert 0 < read.count() < 0.5 * every.count()
    assert index.table("peaks").agg(F.sum("n")).first()[0] == index.table("postings").count()


def test_large_groups_of_texts_are_split(spark, tmp_path):
    d = spark.range(300).select("id", F.lit("same words here").alias("text"))
    index = PO.build(d, str(tmp_path / "i"), block_postings=90, slices=4)
    sizes = [r["count"] for r in index.table("postings").groupBy("block").count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 300
    q = spark.createDataFrame([(1, "words")], "qid long, text string")
    assert ranked(PO.blocked_topk(q, index, 3)) == {(1, 0, 1), (1, 1, 2), (1, 2, 3)}


def test_feature_hashing_equals_its_definition(spark):
    import hashlib

    docs = {1: "a b a", 2: "b c", 3: "", 4: None}
    df = spark.createDataFrame(list(docs.items()), "id long, text string")
    got = {r["id"]: r["embedding"] for r in S.tfidf_vectors(df, 32).collect()}
    for i, words in ((1, {"a": 2, "b": 1}), (2, {"b": 1, "c": 1}), (3, {}), (4, {})):
        want = [0.0] * 32
        for w, tf in words.items():
            h = hashlib.md5(w.encode()).hexdigest()
            df_ = {"a": 1, "b": 2, "c": 1}[w]
            want[int(h[:8], 16) % 32] += (1 if int(h[8], 16) % 2 == 0 else -1) * tf * (math.log(5 / (df_ + 1)) + 1)
        norm = math.sqrt(sum(x * x for x in want)) or 1
        assert got[i] == pytest.approx([x / norm for x in want], abs=1e-6)
