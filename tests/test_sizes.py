"""What a task holds does not grow with the tables."""

import hashlib
import math

from pyspark.sql import functions as F

from corpusforge.functions.text import tokens, word_counts
from corpusforge.operators import postings as PO
from corpusforge.operators import search as S


def test_words_are_counted_in_the_row_of_a_text(spark):
    df = spark.createDataFrame([(1, "b a b c b a"), (2, "x"), (3, "")], "id long, text string").select("id", tokens("text").alias("w"))
    got = {r["id"]: r["n"] for r in df.select("id", word_counts(F.col("w")).alias("n")).collect()}
    assert got == {1: {"a": 2, "b": 3, "c": 1}, 2: {"x": 1}, 3: {"": 1}}
    none = spark.range(1).select(word_counts(F.expr("CAST(array() AS array<string>)")).alias("n"))
    assert none.first()["n"] == {}


def test_partitions_of_a_keyword_search_follow_the_number_of_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "TASK_TEXTS", 10)
    monkeypatch.setattr(S, "TASK_PAIRS", 100)
    queries = spark.createDataFrame([(1, "red fox"), (2, "blue")], "qid int, text string")
    rows = [(i, ["red red sky", "blue fox", "grey", ""][i % 4]) for i in range(200)] + [(200, None)]
    corpus = spark.createDataFrame(rows, "id long, text string")
    found = S.keyword_topk(queries, corpus, 60)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # 201 texts by ten to a task, and no other exchange of them
    assert "hashpartitioning(id#" in plan and ", 21), REPARTITION_BY_NUM" in plan and plan.count("hashpartitioning(id#") == plan.count("REPARTITION_BY_NUM")
    got = {(r["qid"], r["id"]) for r in found.collect()}
    assert got == {(1, i) for i in range(200) if i % 4 == 0} | {(1, i) for i in range(1, 40, 4)} | {(2, i) for i in range(1, 200, 4)}


def test_places_are_looked_up_in_batches(spark):
    """Ties by id, a query without candidates, and no row of the ranking taken through an expression per candidate."""
    rows = [(q, f"d{i:02d}", float(i % 5)) for q in (1, 2, 3) for i in range(40)]
    scored = spark.createDataFrame(rows, "qid int, id string, score double")
    candidates = scored.filter("qid < 3 AND id IN ('d00', 'd07', 'd39')")
    ranks = S._places(candidates, scored)
    assert "MapInArrow" in ranks._jdf.queryExecution().executedPlan().toString()
    order = sorted((-s, i) for q, i, s in rows if q == 1)
    want = {(q, i): place for q in (1, 2) for place, (_, i) in enumerate(order, 1) if i in ("d00", "d07", "d39")}
    assert {(r["qid"], r["id"]): r["rank"] for r in ranks.collect()} == want
    assert S._places(candidates.filter("qid > 3"), scored).collect() == []


def test_words_of_a_text_are_weighted_without_another_exchange(spark):
    """Words of one text and of many, copies of an id and texts without words; no word is shuffled to meet its frequency."""
    rows = [(i, f"red w{i} w{i} fox" if i % 2 else f"red own{i}") for i in range(30)] + [(30, ""), (31, None), (1, "red w1 w1 fox")]
    entries = S.tfidf_entries(spark.createDataFrame(rows, "id long, text string"), 64)
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(term#" not in plan
    got = {(r["id"], r["position"]): r["value"] for r in entries.collect()}
    want, texts = {}, {i: t for i, t in rows if t}
    df = {}
    for t in texts.values():
        for w in set(t.split()):
            df[w] = df.get(w, 0) + 1
    for i, t in texts.items():
        sums = {}
        for w in t.split() * (2 if i == 1 else 1):
            h = hashlib.md5(w.encode()).hexdigest()
            at, sign = int(h[:8], 16) % 64, 1 if int(h[8], 16) % 2 == 0 else -1
            sums[at] = sums.get(at, 0) + sign * (math.log(34 / (df[w] + 1)) + 1)
        length = math.sqrt(sum(x * x for x in sums.values()))
        want |= {(i, at): x / length for at, x in sums.items() if round(x / length, 6)}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)


def test_postings_are_not_shuffled_for_many_blocks(spark, tmp_path, monkeypatch):
    """Where blocks, words and queries do not fit together, blocks and words travel apart; the result is that of the scan."""
    rows = [(i, " ".join(f"w{(i * k) % 17}" for k in range(1, 2 + i % 9))) for i in range(120)]
    corpus = spark.createDataFrame(rows, "id long, text string")
    queries = spark.createDataFrame([(q, f"w{q} w{q + 3} w{q + 5}") for q in range(6)] + [(9, "none")], "qid long, text string")
    index = PO.build(corpus, str(tmp_path / "i"), block_postings=40, slices=4)
    monkeypatch.setattr(PO, "fits", lambda df: not {"block", "term"} <= set(df.columns))
    pairs, weights = PO.reading_plan(queries, index)
    plan = PO.score_blocks(pairs.filter("qid <> 2"), weights, index)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
    got = {tuple(r) for r in PO.score_blocks(pairs.filter("qid <> 2"), weights, index).collect()}
    want = {(r["qid"], r["id"], r["score"]) for r in S.keyword_scores(queries, corpus).filter("qid <> 2").collect()}
    assert got == want
    best = lambda df: {(r["qid"], r["id"], r["rank"]) for r in df.collect()}
    assert best(PO.blocked_topk(queries, index, 5)) == best(S.keyword_topk(queries, corpus, 5))
