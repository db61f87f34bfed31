import datetime as dt
import random

from pyspark.sql import functions as F

from corpusforge.operators import profiling as P
from corpusforge.operators import state as ST
from corpusforge.operators import upsert as U
from corpusforge.sources import files
from corpusforge.sources import tables as TB

KV = "k long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_new_keys_ignore_nulls_in_the_target(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], KV)
    existing = spark.createDataFrame([(1,), (None,)], "k long")
    assert rows(U.new_keys_only(source, existing, "k")) == rows(
        spark.createDataFrame([(2, "b"), (None, "c")], KV)
    )


def test_merging_twice_equals_once(spark):
    target = spark.createDataFrame([(1, "a")], KV)
    source = spark.createDataFrame([(1, "x"), (2, "b")], KV)
    once = U.merge_insert_only(target, source, "k")
    assert rows(once) == [(1, "a"), (2, "b")]
    assert rows(U.merge_insert_only(once, source, "k")) == rows(once)


def test_change_feed_kinds(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (5, "")], KV)
    new = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d"), (5, None)], KV)
    assert rows(U.change_feed(old, new, "k")) == sorted(
        [
            (2, "b", "update_preimage"), (2, "c", "update_postimage"), (3, None, "delete"),
            (4, "d", "insert"), (5, "", "update_preimage"), (5, None, "update_postimage"),
        ],
        key=str,
    )


def test_change_feed_turns_old_into_new(spark):
    rng = random.Random(1)
    for _ in range(3):
        old = {k: rng.choice("abc") for k in rng.sample(range(60), 40)}
        new = {k: rng.choice("abc") for k in rng.sample(range(60), 40)}
        a, b = (spark.createDataFrame(list(d.items()), KV) for d in (old, new))
        feed = U.change_feed(a, b, "k")
        assert rows(U.apply_changes(a, feed, "k")) == rows(b)


def test_copies_of_a_row_do_not_multiply(spark):
    old = spark.createDataFrame([(1, "a")] * 50, KV)
    new = spark.createDataFrame([(1, "b")] * 70, KV)
    assert rows(U.change_feed(old, new, "k")) == [(1, "a", "update_preimage"), (1, "b", "update_postimage")]


NOW = dt.datetime(2024, 7, 1, tzinfo=dt.UTC)


def test_refresh_rule(spark):
    stamps = {
        "null": None,
        "just_not": NOW - dt.timedelta(days=179, hours=23),
        "exactly": NOW - dt.timedelta(days=180),
    }
    state = spark.createDataFrame(list(stamps.items()), "source_table string, last_synced timestamp")
    sources = spark.createDataFrame([(s,) for s in [*stamps, "missing"]], "source_table string")
    got = {r["source_table"]: r["due"] for r in ST.refresh_due(sources, state, NOW).collect()}
    assert got == {"null": True, "just_not": False, "exactly": True, "missing": True, None: True}


def test_seed_fills_an_empty_state_only(spark):
    sources = spark.createDataFrame([("a",), ("b",)], "source_table string")
    empty = spark.createDataFrame([], "source_table string, last_synced timestamp")
    seeded = ST.seed_state(empty, sources)
    assert rows(seeded) == [("a", None), ("b", None)]
    other = spark.createDataFrame([("c", NOW)], "source_table string, last_synced timestamp")
    assert [r["source_table"] for r in ST.seed_state(other, sources).collect()] == ["c"]


def test_stamp_updates_and_inserts(spark):
    state = spark.createDataFrame([("a", None), ("b", NOW)], "source_table string, last_synced timestamp")
    later = NOW + dt.timedelta(days=1)
    synced = spark.createDataFrame([("a",), ("new",)], "source_table string")
    got = {
        r["source_table"]: r["s"]
        for r in ST.stamp_sync(state, synced, later)
        .select("source_table", F.date_format("last_synced", "MM-dd").alias("s"))
        .collect()
    }
    assert got == {"a": "07-02", "b": "07-01", "new": "07-02"}


def test_overwrite_reads_the_table_it_replaces(spark):
    TB.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], KV), "t_over", bucket_by=(2, "k"))
    TB.overwrite(spark.table("t_over").filter("k = 1"), "t_over")
    assert rows(spark.table("t_over")) == [(1, "a")]


def test_overwrite_partitions(spark):
    TB.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], KV), "t_part", partition_by=["k"])
    plan = spark.table("t_part").filter("k = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan and spark.table("t_part").count() == 2


def test_insert_new_is_repeatable(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    for _ in range(2):
        TB.insert_new(df, "t_insert", "k")
    assert rows(spark.table("t_insert")) == [(1, "a"), (2, "b")]
    TB.create_if_absent(spark.createDataFrame([(9, "z")], KV), "t_insert")
    assert spark.table("t_insert").count() == 2


def test_append_goes_by_name_and_widen_adds_columns(spark):
    TB.ensure_table(spark, "t_append", KV)
    TB.append(spark.createDataFrame([("a", 1)], "v string, k long"), "t_append")
    wide = TB.widen(spark.createDataFrame([(3,)], "k long"), "t_append")
    TB.append(wide, "t_append")
    assert rows(spark.table("t_append")) == [(1, "a"), (3, None)]


def test_bucketed_tables_aggregate_without_a_shuffle(spark):
    TB.overwrite(spark.range(100).selectExpr("id AS k", "'x' AS v"), "t_bucket", bucket_by=(4, "k"))
    plan = spark.table("t_bucket").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_table_profile_and_markdown(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], KV)
    assert rows(P.table_profile(df)) == [("k", "bigint", 2, 0), ("v", "string", 2, 1)]
    assert [r["line"] for r in P.markdown_rows(df).collect()] == ["| 1 |  |", "| 2 | b |"]
    assert P.markdown_header(["k", "v"]) == "| k | v |\n| --- | --- |"
    assert [r["k"] for r in P.head(df, "k", 1).collect()] == [1]


def test_csv_tolerates_bad_bytes_and_fields(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_bytes(b"year,country\n2023,Malm\xff\nxx,Oslo\n,Rome\n")
    got = files.read_csv(spark, str(path), "year INT, country STRING").collect()
    assert [tuple(r) for r in got] == [(2023, "Malm�"), (None, "Oslo"), (None, "Rome")]


def test_records_and_binary_files(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"arxiv_id": "1", "authors": ["x"]}\n{"arxiv_id": "2"}\n')
    got = files.read_records(spark, str(tmp_path / "r.json"), "arxiv_id STRING, authors ARRAY<STRING>")
    assert [tuple(r) for r in got.orderBy("arxiv_id").collect()] == [("1", ["x"]), ("2", None)]
    (tmp_path / "a.pdf").write_bytes(b"12345")
    row = files.read_binary(spark, str(tmp_path)).first()
    assert row["path"].endswith("a.pdf") and bytes(row["content"]) == b"12345"
