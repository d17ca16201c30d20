"""Registered queries against their SQL texts, and the shape of their plans."""

import os

import pytest

import __spark_entry__ as entry
from tests.parity import compare, connect

QUICK = ("cleaning_plans", "describe_plans", "metric_plans", "sink_plans")
ALL = entry.queries()
EVERY = os.environ.get("RAREGRAIN_ALL_QUERIES", "1") == "1"  # 0: only the quick modules
NAMES = [n for n, f in ALL.items() if f.__module__.startswith("raregrain.plans")
         and (EVERY or f.__module__.endswith(QUICK))]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf, name):
    assert compare(spark, con, sf, ALL[name], entry.oracle_sql().get(name)) is None


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(ALL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["clean_lots", "rate_by_all", "mann_whitney", "average_precision", "stratified_folds"])
def test_no_cartesian_product(spark, sf, name):
    plan = ALL[name](spark, sf)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark, sf):
    plan = ALL["class_balance"](spark, sf)._jdf.queryExecution().toString()
    line = next(x for x in plan.splitlines() if "lineitem.parquet" in x and "ReadSchema" in x)
    assert "l_extendedprice" not in line.split("ReadSchema")[1]
