"""The plans that the queries are meant to have."""

import os
import re

import pytest

from corpusloom.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,columns", [("content_cache", "doc_id:bigint,text:string"), ("magic_check", "doc_id:bigint,quality:int"), ("safe_filename", "page_id:bigint,url:string"), ("daily_counters", "ts:timestamp_ntz,event_type:string"), ("orphan_text", "doc_id:bigint,lang:string")])
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, name)


def test_filters_reach_the_scan(spark):
    assert re.search(r"PushedFilters: \[.*EqualTo\(quality,1\)", plan(spark, "reconcile"))


@pytest.mark.parametrize("name", ["content_hash", "metadata_card", "chunk_pack", "chunk_hard_split", "upsert_snapshot", "incremental_diff", "knn_topk", "audit_actions", "migrate_legacy", "safe_filename", "date_normalize"])
def test_no_python_in_expressions(spark, name):
    assert not re.search("Python|Arrow|Pandas", plan(spark, name))


def test_top_k_is_limited_before_the_shuffle(spark):
    p = plan(spark, "knn_topk")
    assert "WindowGroupLimit" in p and p.index("Final") < p.index("Partial") and "SinglePartition" not in p.split("Partial")[1].split("Exchange")[0]
