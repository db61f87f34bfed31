"""Replacement of tables, change feeds between versions and index runs that stop at any step."""

import datetime as dt
import random

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusforge.operators import digests as DG
from corpusforge.operators import upsert as U
from corpusforge.plans import refresh as RF
from corpusforge.sources import tables as TB
from corpusforge.sources import versions as VS
from corpusforge.streaming.incremental import file_stream
from corpusforge.streaming.index_sync import IndexSync
from tests.test_refresh import embed, landed  # noqa: F401

KV = "k long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


class Stop(Exception):
    pass


def stopping(monkeypatch, owner, name, at):
    """Let the ``at``-th call of a function fail before it does anything."""
    real, calls = getattr(owner, name), [0]

    def call(*args, **kwargs):
        calls[0] += 1
        if calls[0] == at:
            raise Stop
        return real(*args, **kwargs)

    monkeypatch.setattr(owner, name, call)


@pytest.mark.parametrize("plain", [True, False])
def test_a_stop_at_any_step_shows_the_old_table_or_the_new_one(spark, monkeypatch, plain):
    old, new = [(1, "old")], [(1, "new"), (2, "new")]
    for step in range(1, 30):
        name = f"t_stop_{plain}_{step}".lower()
        (spark.createDataFrame(old, KV).write.saveAsTable if plain else lambda n: TB.overwrite(spark.createDataFrame(old, KV), n))(name)
        df = spark.createDataFrame(new, KV)
        with monkeypatch.context() as patched:
            stopping(patched, SparkSession, "sql", step)
            try:
                TB.overwrite(df, name)
                done = True
            except Stop:
                done = False
        # a reader looks a name up through ``shown``, which mends a stop in the middle of an adoption
        assert VS.shown(spark, name) is not None
        assert rows(spark.table(name)) in (old, new)
        TB.overwrite(df, name)
        assert rows(spark.table(name)) == new and len(VS.versions(spark, name)) <= 2
        if done:
            assert step > 3
            return
    raise AssertionError("the replacement never ended")


def test_a_stop_while_writing_leaves_the_old_table(spark, monkeypatch):
    TB.overwrite(spark.createDataFrame([(1, "old")], KV), "t_write")
    broken = spark.range(3).select(F.raise_error(F.lit("died")).cast("long").alias("k"), F.lit("x").alias("v"))
    with pytest.raises(Exception, match="died"):
        TB.overwrite(broken, "t_write")
    assert rows(spark.table("t_write")) == [(1, "old")]


def test_versions_are_dropped_one_replacement_later(spark):
    for i in range(4):
        TB.overwrite(spark.createDataFrame([(i, "x")], KV), "t_many")
        reader = spark.table("t_many")
        TB.overwrite(spark.createDataFrame([(100 + i, "x")], KV), "t_many")
        assert rows(reader) == [(i, "x")]  # planned on the version before
    assert len(VS.versions(spark, "t_many")) == 2
    TB.append(spark.createDataFrame([("y", 7)], "v string, k long"), "t_many")
    assert rows(spark.table("t_many")) == [(103, "x"), (7, "y")]


def test_null_keys_are_inserted_once(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], KV)
    for _ in range(3):
        TB.insert_new(df, "t_null", "k")
    assert rows(spark.table("t_null")) == [(1, "a"), (None, "b")]


# --- change feeds -------------------------------------------------------------------------------


def test_digests_give_the_same_feed(spark):
    rng = random.Random(1)
    for i in range(3):
        sides = [[(rng.choice([None, *range(25)]), rng.choice("abc")) for _ in range(40)] for _ in range(2)]
        old, new = (spark.createDataFrame(s, KV) for s in sides)
        kept = [DG.store_digests(df, "k", f"t_digest_{i}_{n}", 4) for n, df in enumerate((old, new))]
        assert rows(DG.feed_between(old, new, "k", *kept)) == rows(U.change_feed(old, new, "k"))


def test_comparing_digests_moves_no_row(spark):
    df = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    kept = [DG.store_digests(d, "k", f"t_moved_{n}", 4) for n, d in enumerate((df, df.filter("k > 3")))]
    touched = DG.touched_keys(*kept)
    assert touched.count() == 4 and DG.compare_digests(*kept).count() == 4
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 2


def test_payload_is_scanned_once_a_side_and_not_shuffled(spark, tmp_path):
    for name, low in (("old", 0), ("new", 3)):
        spark.range(low, 300).select(F.col("id").alias("k"), F.repeat(F.lit("text "), F.lit(50)).alias("v")).write.parquet(str(tmp_path / name))
    old, new = (spark.read.parquet(str(tmp_path / n)) for n in ("old", "new"))
    kept = [DG.store_digests(d, "k", f"t_scan_{n}", 4) for n, d in enumerate((old, new))]
    feed = DG.feed_between(old, new, "k", *kept)
    assert feed.count() == 3
    plan = feed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 or plan.count("parquet") == 2


# --- the refresh --------------------------------------------------------------------------------


def test_a_refresh_that_stops_anywhere_is_made_good_by_the_next(spark, landed, monkeypatch):  # noqa: F811
    day = dt.datetime(2024, 3, 1, tzinfo=dt.UTC)
    wanted, stopped = None, 0
    for step in (0, 3, 7, 11, 13, 40):
        schema = f"stopped_{step}"
        with monkeypatch.context() as patched:
            stopping(patched, type(landed.papers), "join", step)
            try:
                RF.CorpusRefresh(spark, schema, day, 1).run(landed, embed)
            except Stop:
                stopped += 1
        job = RF.CorpusRefresh(spark, schema, day + dt.timedelta(hours=step), 2)
        job.run(landed, embed)
        if not job.exists("corpus"):  # the legs were done, the union was not
            job.rebuild(embed)
        state = rows(job.table("corpus")), rows(job.table("corpus_index"))
        wanted = wanted or state
        assert state == wanted and len(state[0]) == 4
    assert stopped >= 4


def test_late_and_broken_documents(spark, landed):  # noqa: F811
    day = dt.datetime(2024, 3, 1, tzinfo=dt.UTC)
    fields = vars(landed)
    late = RF.Landed(**fields | {"parsed": landed.parsed.filter("path not like '%p2%'")})
    job = RF.CorpusRefresh(spark, "late", day, 1)
    assert job.run(late, embed)["papers"]
    assert {r["arxiv_id"] for r in job.table("paper_chunks").collect()} == {"p1"}
    broken = landed.parsed.withColumn("parsed_content", F.when(F.col("path").contains("p2"), "<junk").otherwise(F.col("parsed_content")))
    again = RF.CorpusRefresh(spark, "late", day, 2)
    assert not again.run(RF.Landed(**fields | {"parsed": broken}), embed)["papers"]
    assert [r["path"] for r in again.table("broken_documents").collect()] == ["/in/p2.pdf"]
    assert again.table("parsed_documents").count() == 1
    mended = RF.CorpusRefresh(spark, "late", day, 3)
    assert mended.run(landed, embed)["papers"]
    assert {r["arxiv_id"] for r in mended.table("paper_chunks").collect()} == {"p1", "p2"}
    assert not RF.CorpusRefresh(spark, "late", day, 4).run(landed, embed)["papers"]


# --- triggered index runs -----------------------------------------------------------------------

FEED = "k long, v string, _change_type string, _version int"


def index(spark, folder):
    return IndexSync(spark, str(folder), "k", lambda df: df.select("k", F.upper("v").alias("V")))


def test_batches_count_once_and_in_the_order_of_their_versions(spark, tmp_path):
    sync = index(spark, tmp_path / "i")
    with pytest.raises(ValueError):
        sync.current()
    first = spark.createDataFrame([(1, "a", "insert", 1), (2, "b", "insert", 1), (None, "n", "insert", 1), (3, "c", "insert", 1)], FEED)
    second = spark.createDataFrame(
        [(1, "a", "update_preimage", 2), (1, "x", "update_postimage", 2), (2, "b", "delete", 2), (4, "d", "insert", 2), (4, "e", "update_postimage", 3)], FEED
    )
    stale = spark.createDataFrame([(1, "old", "update_postimage", 1), (5, "f", "delete", 1)], FEED)
    want = [(1, "X"), (3, "C"), (4, "E"), (None, "N")]
    sync.upsert(first, 0)
    sync.upsert(second, 1)
    assert rows(sync.current()) == want
    sync.upsert(first, 0)
    sync.upsert(stale, 2)
    assert rows(sync.current()) == want
    for _ in range(2):
        sync.compact()
        assert rows(sync.current()) == want and sync.committed() == {0, 1, 2}
    scans = sync.current()._jdf.queryExecution().optimizedPlan().toString()
    assert "batch" not in scans  # what the base holds is not read again
    sync.upsert(spark.createDataFrame([(2, "back", "insert", 4), (3, None, "delete", 4)], FEED), 3)
    assert rows(sync.current()) == [(1, "X"), (2, "BACK"), (4, "E"), (None, "N")]


def test_a_batch_that_dies_before_the_ledger_does_not_count(spark, tmp_path, monkeypatch):
    sync = index(spark, tmp_path / "i")
    sync.upsert(spark.createDataFrame([(1, "a", "insert", 1)], FEED), 0)
    change = spark.createDataFrame([(1, "b", "update_postimage", 2)], FEED)
    with monkeypatch.context() as patched:
        stopping(patched, SparkSession, "range", 1)
        with pytest.raises(Stop):
            sync.upsert(change, 1)
    assert rows(sync.current()) == [(1, "A")]
    sync.upsert(change, 1)
    assert rows(sync.current()) == [(1, "B")]


def test_a_stream_of_changes_equals_the_batch(spark, tmp_path):
    old = spark.createDataFrame([(i, f"t{i}") for i in range(30)], KV)
    new = spark.createDataFrame([(i, f"t{i % 20}") for i in range(10, 40)], KV)
    folder = str(tmp_path / "landed")
    old.selectExpr("*", "'insert' AS _change_type", "1 AS _version").write.parquet(folder)
    sync = index(spark, tmp_path / "i")
    stream = file_stream(spark, folder, FEED)
    sync.run(stream, str(tmp_path / "cp"))
    U.change_feed(old, new, "k").withColumn("_version", F.lit(2)).select("k", "v", "_change_type", "_version").write.mode("append").parquet(folder)
    for _ in range(2):
        sync.run(stream, str(tmp_path / "cp"))
    assert rows(sync.current()) == rows(new.select("k", F.upper("v").alias("V")))
    assert sync.committed() == {0, 1}
