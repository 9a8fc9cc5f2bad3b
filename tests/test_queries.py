"""The registered queries: contract, plans, and agreement with SQL on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as entry

TINY = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(TINY), reason="the supplied tables are absent")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_sql_text_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_tables
def test_flagship(spark):
    found = entry.entry(spark).collect()
    assert [r["rank"] for r in sorted(found, key=lambda r: r["rank"])] == list(range(1, len(found) + 1))


@needs_tables
@pytest.mark.parametrize(
    "name", ["watch_new_pairs", "ctr_by_model", "click_attribution", "recommend_topn", "recommend_unseen", "candidate_pairs", "feature_table"]
)
def test_plans_have_no_nested_loops_and_no_python(spark, name):
    text = plan_text(entry.queries()[name](spark, TINY))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in text, word


@needs_tables
def test_scans_read_only_what_they_need(spark):
    text = plan_text(entry.queries()["popularity_total"](spark, TINY))
    columns = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {"event_type", "value", "props"}
    assert "EqualTo(event_type,view)" in text


@needs_tables
@pytest.mark.parametrize(
    "name",
    ["popularity_top10", "popularity_summary", "online_metrics", "click_attribution", "rollout_linear", "item_item_top", "mean_embedding", "window_latency_pct"],
)
def test_agrees_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from check_queries import TABLES, compare

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{TINY}/{table}.parquet')")
    good, note = compare(spark, connection, TINY, name, entry.queries()[name], entry.oracle_sql()[name])
    assert good, note
