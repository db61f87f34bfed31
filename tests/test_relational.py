import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpusforge.functions import dates
from corpusforge.operators import relational as R

SONG = (
    "year int, country string, song_name string, artist_name string, "
    "language string, style string, final_place int"
)


@pytest.fixture(scope="module")
def country(spark):
    return spark.createDataFrame(
        [("United Kingdom", "Western Europe"), ("Portugal", "Western Europe")],
        "country string, region string",
    )


def test_star_join(spark, country):
    contest = spark.createDataFrame([(2023, "United Kingdom")], "year int, host string")
    song = spark.createDataFrame([(2023, "Portugal")], "year int, country string")
    joined = R.star_join(contest, country, song)
    assert joined.count() == 1
    row = joined.first()
    assert row["host_region"] == row["participant_region"] == "Western Europe"
    assert set(joined.columns) == {"year", "host", "host_region", "country", "participant_region"}


def test_star_join_drops_unknown_and_null_keys(spark, country):
    contest = spark.createDataFrame(
        [(1, "Portugal"), (2, "Atlantis"), (3, None)], "year int, host string"
    )
    song = spark.createDataFrame(
        [(1, "Portugal"), (1, "Portugal"), (1, None), (1, "Mu"), (2, "Portugal")],
        "year int, country string",
    )
    assert R.star_join(contest, country, song).count() == 2
    lost = R.dropped_dimension_keys(contest, country, song).collect()
    assert {(r["side"], r["key"], r["n"]) for r in lost} == {
        ("host", "Atlantis", 1), ("host", None, 1), ("participant", None, 1), ("participant", "Mu", 1)
    }


def entries(spark, rows):
    df = spark.createDataFrame(rows, SONG)
    return df.withColumn("participant_region", F.lit("West"))


def test_scoreboard(spark):
    rows = [(y, "A", None, None, None, None, p) for y, p in zip(range(6), [1, 1, 2, 3, 4, None])]
    rows += [(y, "B", None, None, None, None, 2) for y in range(4)]
    got = R.scoreboard(entries(spark, rows)).collect()
    assert [(r["country"], r["participations"], r["wins"], r["avg_place"]) for r in got] == [
        ("A", 5, 2, 2.2)
    ]


ROWS = [
    (2001, "Norway", "Fly", "Ann", "no", "pop", 1),
    (1999, "Norway", "Sea", None, None, "folk", 1),
    (2001, "Norway", "Air", "Bo", "en", "pop", 1),
    (2000, "Norway", "Ice", "Cy", "no", None, 6),
    (2000, "Malta", "Sun", "Di", None, None, None),
    (2003, "Malta", "Sky", "Di", "en", "pop", None),
]


def test_profile(spark):
    got = {r["entity"]: r for r in R.entity_profile(entries(spark, ROWS)).collect()}
    norway, malta = got["Norway"], got["Malta"]
    assert (norway["participations"], norway["wins"], norway["best_place"]) == (4, 3, 1)
    assert norway["avg_place"] == 2.2  # 9 / 4, rounded half to even
    assert [(y["year"], y["n"]) for y in norway["years"]] == [(1999, 1), (2000, 1), (2001, 2)]
    assert (norway["languages"], norway["styles"]) == (["en", "no"], ["folk", "pop"])
    assert (malta["wins"], malta["avg_place"], malta["best_place"]) == (0, None, None)
    assert (malta["languages"], malta["styles"]) == (["en"], ["pop"])
    plain = R.entity_profile(entries(spark, ROWS)).select(
        "entity", R.expand_years(F.col("years")).alias("y")
    )
    assert {r["entity"]: r["y"] for r in plain.collect()}["Norway"] == [1999, 2000, 2001, 2001]


def test_profile_takes_the_region_of_the_first_year(spark):
    df = spark.createDataFrame(ROWS[:4], SONG).withColumn(
        "participant_region", F.when(F.col("year") > 1999, "late")
    )
    assert R.entity_profile(df).first()["region"] is None


def test_summary_text(spark):
    got = {r["chunk_id"]: r["text"] for r in R.entity_summary(entries(spark, ROWS)).collect()}
    assert got["norway"] == (
        "Norway has participated in Eurovision4 times (1999–2001), representing West. They have won 3 "
        "time(s): 'Sea' by None (1999, None, folk), 'Air' by Bo (2001, en, pop), 'Fly' by Ann (2001, no, "
        "pop).  Their average placement is 2.2,  with a best placement of 1. They have performed in: en, "
        "no. Their musical styles include: folk, pop."
    )
    assert got["malta"] == (
        "Malta has participated in Eurovision2 times (2000–2003), representing West. They have never won."
        "   They have performed in: en. Their musical styles include: pop."
    )
    tidy = {r["chunk_id"]: r["text"] for r in R.entity_summary(entries(spark, ROWS), tidy=True).collect()}
    assert "in Eurovision 2 times" in tidy["malta"] and "  " not in tidy["norway"]


def hot_rows():
    hot = [(2000 + i % 4, "Hot", f"s{i:04d}", "x", "en", "pop", 1) for i in range(300)]
    return hot + [(2000, "Cold", f"c{i}", "y", "en", "pop", i) for i in range(1, 6)]


def test_a_hot_entity_is_split_and_stays_whole(spark):
    df = entries(spark, hot_rows())
    parts = R.winner_parts(df, per_part=20).collect()
    hot = sorted((r["part"], r["winning_entries"]) for r in parts if r["entity"] == "Hot")
    assert len(hot) > 4 and hot[0][0] >= 1 and max(len(w) for _, w in hot) < 60
    flat = [w for _, ws in hot for w in ws]
    assert [w["year"] for w in flat] == sorted(w["year"] for w in flat)
    assert {w["song_name"] for w in flat} == {f"s{i:04d}" for i in range(300)} and len(flat) == 300
    assert [r["part"] for r in parts if r["entity"] == "Cold"] == [0]


def test_copies_of_an_entry_are_split_and_stay_whole(spark):
    copies = [(2000, "Hot", "same", "x", "en", "pop", 1)] * 500
    others = [(2000, "Hot", "other", "x", "en", "pop", 1), (1999, "Hot", None, "x", "en", "pop", 1)]
    parts = R.winner_parts(entries(spark, copies + others), per_part=50).orderBy("part").collect()
    assert len(parts) > 3 and max(r["n_winners"] for r in parts) < 300
    songs = [w["song_name"] for r in parts for w in r["winning_entries"]]
    assert songs[0] is None and songs.count("same") == 500 and songs.count("other") == 1
    assert sum(r["n_winners"] for r in parts) == 502 == len(songs)
    small = R.winner_parts(entries(spark, copies[:3] + others)).collect()
    assert [w["song_name"] for w in small[0]["winning_entries"]] == [None, "other", "same", "same", "same"]


def test_a_hot_summary_reads_like_the_whole_one(spark):
    df = entries(spark, hot_rows())
    whole = {r["chunk_id"]: r["text"] for r in R.entity_summary(df).collect()}
    split = R.entity_summary(df, per_part=20).collect()
    cold = [r for r in split if r["chunk_id"] == "cold"]
    assert [(r["part"], r["text"]) for r in cold] == [(0, whole["cold"])]
    hot = [r["text"] for r in sorted(split, key=lambda r: r["part"]) if r["chunk_id"] == "hot"]
    lists = sorted(", ".join(hot[1:-1]).split("), "))
    head, rest = whole["hot"].split("time(s): ")
    assert hot[0] == head + "time(s): " and rest.endswith(hot[-1])
    assert sorted(s.rstrip(")") for s in lists) == sorted(
        s.rstrip(")") for s in rest.removesuffix(hot[-1]).split("), ")
    )


def test_parts_of_a_summary_are_those_of_the_winners(spark):
    rows = hot_rows() + [(None, "Hot", "early", "x", "en", "pop", 1)] * 45 + [(None, "Hot", "lost", "y", "de", "folk", 3)]
    df = entries(spark, rows)
    listed = R.winner_parts(df, per_part=20).select("part", R.winner_list(F.col("winning_entries")).alias("text"))
    expected = {r["part"]: r["text"] for r in listed.filter("entity = 'Hot'").collect()}
    split = {r["part"]: r["text"] for r in R.entity_summary(df, per_part=20).filter("chunk_id = 'hot'").collect()}
    opening, closing = split.pop(0), split.pop(346)
    assert split == expected and len(split) > 10
    assert opening.startswith("Hot has participated in Eurovision346 times (2000–2003)")
    assert "performed in: de, en." in closing and "styles include: folk, pop." in closing


def test_a_summary_takes_its_entries_once(spark):
    plan = R.entity_summary(entries(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "Join" not in plan
    # by all that is shown, and by entity
    assert plan.count("Exchange hashpartitioning") == 2


def test_dates(spark):
    df = spark.createDataFrame([(202305141207, dt.datetime(2023, 5, 14, 12, 7))], "s long, t timestamp")
    row = df.select(
        dates.stamp_year("s"), dates.stamp_month("s"), dates.stamp_day("s"), dates.minute_stamp("t")
    ).first()
    assert tuple(row) == (2023, 5, 14, 202305141207)
