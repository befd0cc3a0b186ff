"""Plan-shape guards: the physical plans keep the properties the design relies on."""

import re

import pytest

from tillroll import Tables, registry

from .conftest import SF_SMALL

registry.load_all()


def _plan(spark, name):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # whole lists of pushed filters
    try:
        df = registry.QUERIES[name](Tables(spark, SF_SMALL))
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_cross_products_or_expand(spark, name):
    plan = _plan(spark, name)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|\bExpand\b", plan), plan


def test_status_filter_reaches_the_scan(spark):
    plan = _plan(spark, "monthly_revenue")
    assert "PushedFilters: [In(o_orderstatus, [F,O])" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string," in plan


def test_date_window_reaches_the_scan(spark):
    plan = _plan(spark, "daily_sales_running")
    assert "GreaterThanOrEqual(o_orderdate," in plan


@pytest.mark.parametrize("name", ["recommend_products", "top_products_by_category"])
def test_per_group_top_k_is_limited_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in _plan(spark, name)


def test_month_of_a_view_reaches_the_orders_scan(spark):
    plan = _plan(spark, "view_filter_month")
    assert "GreaterThanOrEqual(o_orderdate,2001-07-01" in plan and "LessThan(o_orderdate,2001-08-01" in plan


@pytest.mark.parametrize("name,pushed", [("customer_ltv_of", "EqualTo(o_custkey,7)"), ("purchase_history_of", "EqualTo(o_custkey,7)"),
                                         ("recommend_products_for", "EqualTo(l_partkey,11)")])
def test_key_of_a_single_call_reaches_the_scan(spark, name, pushed):
    assert pushed in _plan(spark, name)


@pytest.mark.parametrize("name,table,scans", [("churn_risk", "orders", 1), ("best_sellers", "lineitem", 1),
                                              ("order_total_reconcile", "lineitem", 1), ("category_performance", "lineitem", 1),
                                              ("mv_category_performance", "lineitem", 1), ("mv_category_performance_corrected", "lineitem", 1),
                                              ("dq_foreign_key", "orders", 5), ("rfm_segments", "orders", 1),
                                              ("refreshed_monthly_revenue", "orders", 0), ("trend_decompose", "lineitem", 1)])
def test_facts_are_read_no_more_than_needed(spark, name, table, scans):
    plan = registry.QUERIES[name](Tables(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    first = {"orders": "o_orderkey", "lineitem": "l_orderkey"}[table]
    assert len(re.findall(rf"Relation \[{first}#", plan)) <= scans, plan
