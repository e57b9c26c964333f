"""Plan shapes that matter at scale: pruning, pushdown, join kinds, group limits."""

import os

import pytest

from tallyline.operators import customers, filters, metrics, ordering, sales
from tallyline.plans.catalogue import QUERIES
from tallyline.sources import readers, sinks
from tallyline.sources.readers import Tables

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, shop, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("star"))
    sinks.land(Tables(shop), out)
    return readers.load_tables(spark, out, "parquet", names=tuple(shop))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_status_filter_and_columns_reach_the_scan(stored):
    text = plan(metrics.monthly_revenue(stored["fact_orders"]))
    assert "In(order_status, [Completed,Shipped])" in text
    read = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "channel" not in read and "customer_id" not in read and "total_amount" in read


def test_lookup_pushes_the_customer_id(stored):
    text = plan(sales.customer_clv_lookup(stored["dim_customers"], stored["fact_orders"],
                                          stored["fact_order_items"], "c1"))
    assert text.count("EqualTo(customer_id,c1)") >= 2


def test_missing_rows_are_anti_joins(stored):
    assert "LeftAnti" in plan(filters.orphans(stored["fact_orders"], "order_id", stored["fact_order_items"], "order_id"))


def test_rank_limit_runs_before_the_exchange(stored):
    text = plan(sales.top_products_ranked(stored["fact_order_items"], stored["dim_products"]))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")


def test_top_k_is_a_heap_per_task(stored):
    text = plan(sales.top_customers(stored["dim_customers"], stored["fact_orders"], stored["fact_order_items"]))
    assert "TakeOrderedAndProject" in text


def test_lines_are_combined_before_they_meet_orders(spark, stored):
    """Below the join with orders, lines are aggregated by order id."""
    text = plan(sales.regional_sales(stored["dim_customers"], stored["fact_orders"], stored["fact_order_items"]))
    assert "keys=[order_id" in text and text.count("partial_sum(line_revenue") == 1


@pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="test data absent")
@pytest.mark.parametrize("name", ["executive_kpis", "customer_clv", "product_performance", "cohort_retention",
                                  "geographic_performance", "quality_report", "churn_features", "dq_amount_outliers",
                                  "product_pareto", "customer_features", "revenue_forecast_by_category"])
def test_no_all_pairs_join(spark, name):
    text = plan(QUERIES[name](spark, DIRECTORY))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_bucketed_scan_has_no_global_window(spark):
    rows = spark.range(5000).selectExpr("id", "id % 3 AS v")
    text = plan(ordering.prefix_scan(rows, "v", "id", ["v"], rows_per_bucket=500))
    # the only window without a bucket orders the one-row-per-bucket totals
    windows = [x for x in text.split("\n") if "Window [" in x and "_bucket" not in x]
    assert not windows
