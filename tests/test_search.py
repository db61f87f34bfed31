import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.operators import search as S


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(0)
    return rng.normal(size=(300, 8)).round(3), rng.normal(size=(12, 8)).round(3)


def frames(spark, vectors):
    corpus, queries = vectors
    c = spark.createDataFrame(
        [(f"d{i:03d}", [float(x) for x in v], i % 3) for i, v in enumerate(corpus)],
        "id string, embedding array<float>, label int",
    )
    q = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(queries)], "qid long, embedding array<float>"
    )
    return c, q


def brute(vectors, k, keep=lambda q, i: True):
    corpus, queries = (v.astype(np.float32).astype(np.float64) for v in vectors)
    out = set()
    for q, qv in enumerate(queries):
        scored = [(-round(float(qv @ v), 6), f"d{i:03d}") for i, v in enumerate(corpus) if keep(q, i)]
        out |= {(q, i, r + 1) for r, (_, i) in enumerate(sorted(scored)[:k])}
    return out


def ranked(df):
    return {(r["qid"], r["id"], r["rank"]) for r in df.collect()}


def test_vector_topk_is_exact(spark, vectors):
    c, q = frames(spark, vectors)
    assert ranked(S.vector_topk(q, c.repartition(5), 7)) == brute(vectors, 7)


def test_many_queries_go_in_blocks(spark, vectors, monkeypatch):
    c, q = frames(spark, vectors)
    monkeypatch.setattr(S._blocked, "__defaults__", (5, 40))
    assert ranked(S.vector_topk(q, c, 7, max_broadcast=3)) == brute(vectors, 7)


def test_filters_come_before_ranking(spark, vectors):
    c, q = frames(spark, vectors)
    found = S.vector_topk(q, c, 7, {"label": 1})
    assert ranked(found) == brute(vectors, 7, lambda _, i: i % 3 == 1)


def test_copies_tie_by_id(spark):
    c = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(500)], "id long, embedding array<float>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "qid long, embedding array<float>")
    assert ranked(S.vector_topk(q, c.repartition(4), 3)) == {(0, i, i + 1) for i in range(3)}


def test_no_queries_no_hits(spark, vectors):
    c, q = frames(spark, vectors)
    assert S.vector_topk(q.limit(0), c, 3).count() == 0


def test_probing_all_cells_is_exact_and_recall_is_good(spark, vectors):
    c, q = frames(spark, vectors)
    cells = S.mean_vectors(c.withColumn("cell", F.col("label")), "cell")
    assigned = S.assign_cells(c, cells)
    everything = S.vector_topk(S.assign_cells(q, cells, 3), assigned, 5)
    assert ranked(everything) == brute(vectors, 5)
    some = ranked(S.vector_topk(S.assign_cells(q, cells, 2), assigned, 5))
    hits = {(q, i) for q, i, _ in some} & {(q, i) for q, i, _ in brute(vectors, 5)}
    assert len(hits) >= 0.6 * 12 * 5


def bm25(queries, docs, k):
    words = {d: [w for w in re.split(r"[^a-z0-9]+", t.lower()) if w] for d, t in docs.items()}
    avg = sum(map(len, words.values())) / len(words)
    out = set()
    for q, text in queries.items():
        scores = {}
        for term in {w for w in re.split(r"[^a-z0-9]+", text.lower()) if w}:
            df = sum(term in w for w in words.values())
            for d, w in words.items():
                if tf := w.count(term):
                    idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                    norm = S.BM25_K1 * (1 - S.BM25_B + S.BM25_B * len(w) / avg)
                    scores[d] = scores.get(d, 0) + idf * tf * (S.BM25_K1 + 1) / (tf + norm)
        best = sorted((-round(s, 6), d) for d, s in scores.items())[:k]
        out |= {(q, d, r + 1) for r, (_, d) in enumerate(best)}
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(30)] + ["the"] * 30
    docs = {i: " ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) + "." for i in range(200)}
    docs[200] = ""
    queries = {i: " ".join(rng.choices(vocabulary, k=4)) for i in range(8)}
    return queries, docs


def text_frames(spark, texts):
    queries, docs = texts
    return (
        spark.createDataFrame(list(queries.items()), "qid long, text string"),
        spark.createDataFrame(list(docs.items()), "id long, text string"),
    )


def test_keyword_topk_is_bm25(spark, texts):
    q, d = text_frames(spark, texts)
    assert ranked(S.keyword_topk(q, d, 6)) == bm25(*texts, 6)


def test_keyword_topk_without_broadcast(spark, texts, monkeypatch):
    q, d = text_frames(spark, texts)
    monkeypatch.setattr(S, "fits", lambda df: False)
    assert ranked(S.keyword_topk(q, d, 6)) == bm25(*texts, 6)


@pytest.mark.parametrize("broadcast", [True, False])
def test_indexed_search_equals_the_scan(spark, texts, tmp_path, monkeypatch, broadcast):
    q, d = text_frames(spark, texts)
    S.word_index(d).write.partitionBy("bucket").parquet(str(tmp_path / "words"))
    S.corpus_totals(d).write.parquet(str(tmp_path / "totals"))
    index, totals = (spark.read.parquet(str(tmp_path / n)) for n in ("words", "totals"))
    monkeypatch.setattr(S, "fits", lambda df: broadcast)
    found = S.indexed_topk(q, index, totals, 6)
    assert ranked(found) == bm25(*texts, 6)
    if broadcast:
        assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_fusion(spark):
    a = spark.createDataFrame([(0, "x", 1), (0, "y", 2)], "qid int, id string, rank int")
    b = spark.createDataFrame([(0, "y", 1), (0, "z", 2)], "qid int, id string, rank int")
    got = S.fuse([a, b], 3).orderBy("rank").collect()
    assert [r["id"] for r in got] == ["y", "x", "z"]
    assert got[0]["score"] == round(1 / 61 + 1 / 62, 9)


def test_search_returns_the_wanted_columns(spark):
    corpus = spark.createDataFrame(
        [("a", "red fox", "wiki", [1.0, 0.0]), ("b", "blue whale", "wiki", [0.0, 1.0]),
         ("c", "red whale", "news", [0.5, 0.5])],
        "id string, text string, source string, embedding array<float>",
    )
    q = spark.createDataFrame(
        [(1, "red", [1.0, 0.0])], "qid int, text string, embedding array<float>"
    )
    hybrid = S.search(q, corpus, ["id", "source"], 2).orderBy("rank")
    assert hybrid.columns == ["qid", "id", "source", "score", "rank"]
    assert [r["id"] for r in hybrid.collect()] == ["a", "c"]
    assert [r["id"] for r in S.search(q, corpus, num_results=1, filters={"source": "news"}).collect()] == ["c"]
    ann = S.search(q, corpus, query_type="ann", num_results=3).orderBy("rank")
    assert ann.columns == ["qid", "id", "text", "score", "rank"]
    assert [r["id"] for r in ann.collect()] == ["a", "c", "b"]
    with pytest.raises(ValueError):
        S.search(q, corpus, query_type="other")


def test_tfidf_vectors_find_like_texts(spark, texts):
    _, docs = texts
    d = spark.createDataFrame(list(docs.items()), "id long, text string")
    v = S.tfidf_vectors(d, 64)
    rows = {r["id"]: r["embedding"] for r in v.collect()}
    assert len(rows) == len(docs) and all(len(e) == 64 for e in rows.values())
    assert abs(sum(x * x for x in rows[0]) - 1) < 1e-5 and not any(rows[200])
    some = v.filter("id < 20 AND id <> 200").select(F.col("id").alias("qid"), "embedding")
    assert {r["qid"]: r["score"] for r in S.vector_topk(some, v, 1).collect()} == pytest.approx(dict.fromkeys(range(20), 1.0), abs=1e-4)


def test_sync_index_embeds_changed_rows_only(spark):
    index = spark.createDataFrame([("a", "old"), ("b", "old"), ("c", "old")], "id string, v string")
    feed = spark.createDataFrame(
        [("a", "x", "update_postimage"), ("a", "w", "update_preimage"), ("b", "y", "delete"),
         ("d", "z", "insert")],
        "id string, text string, _change_type string",
    )
    got = S.sync_index(index, feed, lambda df: df.select("id", F.upper("text").alias("v")))
    assert sorted(tuple(r) for r in got.collect()) == [("a", "X"), ("c", "old"), ("d", "Z")]


def test_whole_rankings_are_fused(spark, vectors, texts):
    """Against a fusion of all places, with ties, texts without words and texts without vectors."""
    rng = random.Random(8)
    corpus, queries = vectors
    words = [f"w{i}" for i in range(6)]
    docs = {i: ([round(x, 1) for x in corpus[i % 60].tolist()] if i % 7 else None, " ".join(rng.choices(words, k=rng.randint(0, 8)))) for i in range(300)}
    asked = {q: (queries[q].round(1).tolist() if q % 4 else None, " ".join(rng.choices(words, k=2))) for q in range(8)}
    c = spark.createDataFrame([(i, t, v) for i, (v, t) in docs.items()], "id long, text string, embedding array<double>")
    q = spark.createDataFrame([(i, t, v) for i, (v, t) in asked.items()], "qid long, text string, embedding array<double>")
    by_word = bm25({i: t for i, (_, t) in asked.items()}, {i: t for i, (_, t) in docs.items()}, 300)
    scores = {}
    for i, d, rank in by_word:
        scores[i, d] = 1 / (60 + rank)
    for i, (qv, _) in asked.items():
        if qv is not None:
            order = sorted((-round(float(np.dot(qv, v)), 6), d) for d, (v, _) in docs.items() if v is not None)
            for rank, (_, d) in enumerate(order, 1):
                scores[i, d] = scores.get((i, d), 0) + 1 / (60 + rank)
    want = set()
    for i in asked:
        best = sorted((-round(s, 9), d) for (j, d), s in scores.items() if j == i)[:4]
        want |= {(i, d, rank) for rank, (_, d) in enumerate(best, 1)}
    assert ranked(S.search(q, c, ["id"], 4, depth=None)) == want
