"""Every registered query against its SQL on the smallest tables, and plan rules."""

import os
import re
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from check_oracles import TABLES, plain

from regweave.plans import load_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_queries()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if not name.startswith(("name_similarity", "same_name_union", "segregated_grids")):
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas", plan)
    got = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        res = sql.execute(ORACLES[name])
        columns = [d[0] for d in res.description]
        assert sorted(columns) == sorted(df.columns)
        assert plain(got, df.columns) == plain(res.fetchall(), columns)
    else:
        assert got


def test_only_the_similarity_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"name_similarity"}
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def explain(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = explain(QUERIES["usi_join"](spark, FOLDER))
    assert "l_tax" not in plan and "o_totalprice" not in plan
    assert re.search(r"PushedFilters: \[[^\]]*l_returnflag", plan)


def test_top_pick_limits_before_the_shuffle(spark):
    plan = explain(QUERIES["composite_rank"](spark, FOLDER))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_first_pick_aggregates_before_the_shuffle(spark):
    plan = explain(QUERIES["first_wins"](spark, FOLDER))
    assert "partial_min_by" in plan


def test_point_lookup_filter_reaches_every_branch(spark):
    plan = QUERIES["point_lookup"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    aggregate = plan.index("Aggregate")
    assert plan.count("= K42", aggregate) >= 3


def test_document_assembly_never_collects(spark):
    for name in ("network_doc", "talkgroup_doc", "node_doc"):
        assert "collect_list" not in explain(QUERIES[name](spark, FOLDER))
