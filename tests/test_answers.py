import json

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import answers as A
from corpusforge.operators import serving as V


def test_scorers(spark):
    texts = ["w " * 399, "w " * 400, "Ukulele", "", "I love NORWAY"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = A.score_answers(df).orderBy("i").collect()
    assert [r["word_count_check"] for r in got] == [True, False, True, True, True]
    assert [r["mentions_countries"] for r in got] == [False, False, True, False, True]
    means = {r["scorer"]: (r["n"], r["mean"]) for r in A.report(A.score_answers(df)).collect()}
    assert means == {"word_count_check": (5, 0.8), "mentions_countries": (5, 0.4)}


def test_own_scorers(spark):
    df = spark.createDataFrame([("a",), ("bb",)], "text string")
    scorers = {"short": lambda c: F.length(c) < 2}
    assert A.report(A.score_answers(df, scorers=scorers), ["short"]).first()["mean"] == 0.5


def test_output_text(spark):
    forms = {
        "plain words": "plain words", '"quoted"': "quoted", '[{"text": "x"}, {"text": "y"}]': "x", '[{"type": "t"}]': "", '[{"text": null}]': "",
        '["a", "b"]': "a", "[7]": "7", "[[1]]": "[1]", "[]": "[]", '{"text": "t"}': '{"text":"t"}', "12.5": "12.5", "true": "true", "": "",
    }
    df = spark.createDataFrame([(k,) for k in [*forms, None]], "o string")
    got = {r["o"]: r["t"] for r in df.select("o", A.output_text(F.col("o")).alias("t")).collect()}
    assert got == forms | {None: None}
    scored = A.score_answers(df, "o", mixed=True)
    assert scored.columns == ["o", *A.SCORERS]


@pytest.fixture(scope="module")
def summaries(spark):
    rows = [("united_kingdom", 0, "UK – story"), ("norway", 0, "N1"), ("norway", 1, "N2")]
    return spark.createDataFrame(rows, "chunk_id string, part long, text string")


def test_lookup(spark, summaries):
    names = spark.createDataFrame([("  United Kingdom ",), ("Norway",), ("Mars",)], "name string")
    got = {(r["name"], r["part"]): (r["found"], json.loads(r["json"]))
           for r in V.lookup_with_fallback(names, summaries).collect()}
    assert got[("  United Kingdom ", 0)] == (True, {"country": "  United Kingdom ", "stats": "UK – story"})
    assert got[("Norway", 1)][1]["stats"] == "N2"
    found, answer = got[("Mars", None)]
    assert not found and answer["error"].startswith("No data found for country: Mars.\n ")
    assert len(got) == 4


def test_history_holds_every_summary_once(spark):
    rows = [(f"c{i}", i % 2, f"täx {i}" * (i % 7)) for i in range(300)] + [("c1", 1, "täx 1")]
    df = spark.createDataFrame(rows, "chunk_id string, part long, text string")
    got = V.history_json(df, 2025, 1000).collect()
    assert sorted(r["document"] for r in got) == list(range(len(got))) and len(got) > 5
    head = len('{"year":2025,"historical_data":[]}')
    longest = max(len(json.dumps({"country": c, "stat": t}, ensure_ascii=False).encode()) for c, _, t in rows)
    assert max(len(r["json"].encode()) for r in got) <= head + 1000 + longest
    # ten times the rows make more documents, not longer ones
    more = df.crossJoin(spark.range(10)).withColumn("chunk_id", F.concat_ws("/", "chunk_id", "id")).drop("id")
    wide = V.history_json(more, 2025, 1000).collect()
    assert len(wide) > 9 * len(got) and max(len(r["json"].encode()) for r in wide) <= head + 1020 + longest
    by = V.history_json(df.withColumn("g", F.col("part")), 2025, 1000, by=["g"]).collect()
    assert {r["g"] for r in by} == {0, 1} and sum(r["n"] for r in by) == len(rows)
    items = [i for r in got for i in json.loads(r["json"])["historical_data"]]
    assert sorted((i["country"], i["stat"]) for i in items) == sorted((c, t) for c, _, t in rows)
    assert {json.loads(r["json"])["year"] for r in got} == {2025}


def test_dispatch(spark, summaries):
    rows = [
        (1, "roast_country", '{"country_name": "Norway"}'), (2, "predict_winner", "{}"),
        (3, "roast_country", "{}"), (4, "sing", "{}"), (5, "roast_country", '{"country_name": "Mars"}'),
    ]
    requests = spark.createDataFrame(rows, "request_id int, name string, arguments string")
    got = {}
    for r in V.dispatch(requests, summaries).collect():
        got.setdefault(r["request_id"], []).append(r["output"])
    assert sorted(json.loads(o)["stats"] for o in got[1]) == ["N1", "N2"]
    assert got[4] == ["Unknown tool: sing"]
    # the answer's keys join to the documents, however many there are
    named = json.loads(got[2][0])
    assert named == {"table": "history_json", "first": 0, "last": 0}
    last = json.loads(summaries.select(V.history_keys(summaries, 30)).first()[0])["last"]
    documents = [r["document"] for r in V.history_json(summaries, 2025, 30).collect()]
    assert min(documents) == 0 and max(documents) <= last and len(documents) > 1
    assert got[3][0].startswith("Tool error: ") and "No data found" in got[5][0]


def test_conversations(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "q"),
            *[(3, i, "user", "q") for i in range(10)], (4, 1, "assistant", "x"), (4, 5, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {r["conv_id"]: r["outcome"] for r in V.conversation_outcome(df).collect()} == {
        1: "answered", 2: "open", 3: "max_iterations", 4: "answered"
    }
    assert {r["conv_id"]: r["text"] for r in V.last_answers(df).collect()} == {1: "a", 4: "y"}
    assert V.assistant_messages(df).count() == 3


def test_output_messages(spark):
    rows = [("response.output_item.done", ("message",)), ("response.output_item.done", ("function_call",)),
            ("response.text.delta", ("message",))]
    df = spark.createDataFrame(rows, "type string, item struct<type:string>")
    assert V.output_messages(df).count() == 1
