"""Plan properties every registered query must keep."""
import re

import pytest

import __spark_entry__ as E

from conftest import SF001

_NAMES = sorted(E.queries())
# queries that write files / run a stream inside the call are checked elsewhere
_SIDE_EFFECTS = {"ticket_stream", "csv_roundtrip", "document_scan", "image_data_url"}


def _plan(spark, name):
    return E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in _NAMES if n not in _SIDE_EFFECTS])
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(spark, name)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan), name


@pytest.mark.parametrize("name", ["knn_topk", "rerank_topk", "retrieval_context"])
def test_topk_uses_group_limit(spark, name):
    assert "WindowGroupLimit" in _plan(spark, name)


def test_lineitem_scan_is_pruned(spark):
    plan = _plan(spark, "cohort_lab_summary")
    m = re.search(r"FileScan parquet \[([^\]]*l_orderkey[^\]]*)\]", plan)
    assert m and "l_shipdate" not in m.group(1) and "l_extendedprice" not in m.group(1)


def test_case_filter_pushed_to_scan(spark):
    plan = _plan(spark, "cohort_cases")
    assert re.search(r"DataFilters: \[.*StartsWith", plan)
