"""Every registered query against its SQL counterpart, and the shape of its plan."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from corpusforge.plans import queries
from corpusforge.plans.oracle import statements
from corpusforge.plans.queries import registry

QUERIES, SQL = registry(), statements()


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(table, columns):
    rows = zip(*[table.column(c).to_pylist() for c in columns], strict=True)
    plain = [tuple("\0null" if v is None or v != v else str(v) for v in r) for r in rows]
    return sorted(plain)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, small, name):
    df = QUERIES[name](spark, small)
    got = df.toArrow()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    expected = db.sql(SQL[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(expected.column_names)
    assert canonical(got, columns) == canonical(expected, columns)
    assert got.num_rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["chunk_documents", "clean_text", "page_sections", "paper_chunks", "keyword_topk"])
def test_text_work_stays_in_the_jvm(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_history_builds_its_summaries_once(spark, small):
    plan = QUERIES["history_json"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "ExistingRDD" in plan


def test_line_items_are_read_once_for_the_corpus(spark, small):
    plan = QUERIES["unified_corpus"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [l_orderkey") == 1


def test_line_items_are_read_once_for_the_tools(spark, small, monkeypatch):
    cut = []
    monkeypatch.setattr(queries, "cut_lineage", lambda df: cut.append(df) or df)
    QUERIES["tool_dispatch"](spark, small)
    plan = cut[0]._jdf.queryExecution().executedPlan().toString()
    assert len(cut) == 1 and plan.count("FileScan parquet [l_orderkey") == 1


def test_filters_reach_the_scan(spark, small):
    plan = QUERIES["vector_topk_filtered"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(label,3)" in plan


def test_only_needed_columns_are_read(spark, small):
    plan = QUERIES["new_keys_only"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "quality" not in plan


def test_top_k_is_cut_before_the_last_exchange(spark, small):
    plan = QUERIES["keyword_topk"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
