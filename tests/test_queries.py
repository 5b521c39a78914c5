"""Registered queries: the same rows as their SQL, and plans that stay distributed."""

import math
import os
import re
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as registered  # noqa: E402

from papyrine import workload  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
HOOKS = {"extract_pages_hook", "classify_hook", "extract_markdown_hook", "extract_pages_binary", "page_files"}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def comparable(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_query_equals_its_sql(spark, oracle, name):
    got = registered.queries()[name](spark, SF_DIR)
    want = oracle.sql(registered.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert comparable(got.collect(), got.columns) == comparable(want.fetchall(), want.columns)


def test_every_query_has_sql():
    assert set(workload.queries()) == set(workload.oracle_sql())
    assert workload.queries().keys() <= registered.queries().keys()
    assert registered.oracle_sql().keys() <= registered.queries().keys()


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["doc_id", "page_count", "is_relevant", "extracted_text"]
    assert df.count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_plan_stays_distributed(spark, name):
    plan = plan_of(registered.queries()[name](spark, SF_DIR))
    if name not in HOOKS:  # by the names of the plan's nodes, as names of character references are in it as well
        nodes = re.findall(r"^[\s:+*()\d-]*([A-Za-z]\w*)", plan, re.M)
        assert nodes and not [node for node in nodes if "Python" in node or "Arrow" in node]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # One partition is fine after a partial aggregate, and for the offsets of partitions, of which there are few.
    for step, below in re.findall(r"Exchange SinglePartition.*\n(.*)\n(.*)", plan):
        assert "HashAggregate" in step + below or "SortAggregate" in step + below or "ObjectHash" in step + below, plan
