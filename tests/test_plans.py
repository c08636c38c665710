"""What the plans must look like, whatever the size of the data."""

import pytest
from conftest import DATA

import __spark_entry__ as entry_point
from strata.operators import joins
from strata.plans import stateful

QUERIES = entry_point.QUERIES
PURE = sorted(n for n, fn in QUERIES.items() if fn.__module__ != stateful.__name__)
SF = f"{DATA}/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def large(spark, monkeypatch):
    """Plan as if no side were small enough to broadcast."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins.is_small, "__defaults__", (0,))
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (None, 0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", PURE)
def test_no_broadcast_or_cross_join_is_needed(spark, large, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin"):
        assert operator not in text
    assert "BatchEvalPython" not in text


def test_small_sites_are_broadcast_and_readings_are_not(spark):
    text = plan(spark, "production_by_site")
    assert "BuildRight" in text and "BuildLeft" not in text
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["latest_per_key", "audit_latest", "scd2_history", "net_changes"])
def test_hot_keys_are_cut_before_the_shuffle(spark, name):
    assert "row_number(), 1, Partial" in plan(spark, name)


def test_dates_and_columns_reach_the_scan(spark):
    text = plan(spark, "tons_last_90d")
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text


def test_top_k_needs_no_full_sort(spark):
    for name in ("top_sites", "lowest_health", "similar_topk", "partition_counts"):
        assert "TakeOrderedAndProject" in plan(spark, name)


def test_documents_split_without_a_shuffle(spark):
    assert "Exchange" not in plan(spark, "document_chunks")
