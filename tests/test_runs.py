"""Whole runs: SQL names, the analytics report and the churn workflow."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import m, rows
from tallyline.operators import sales
from tallyline.plans.reports import run_analytics, run_churn
from tallyline.plans.views import register_views
from tallyline.sources.bindings import Binding
from tallyline.sources.readers import Tables

DIRECTORY = "/root/testdata/sf0.01"


def test_sql_names(spark, shop):
    names = register_views(spark, shop, "2023-12-31")
    assert {"fact_orders", "order_summary", "customer_rfm_base", "store_performance"} <= set(names)
    got = spark.sql("SELECT order_status, COUNT(*) FROM order_summary GROUP BY 1 HAVING SUM(line_item_count) = 2")
    assert rows(got) == [("Completed", 1)]
    assert rows(spark.sql("SELECT * FROM customer_clv_lookup('c1')")) == [("c1", 2, m("50.00"), m("25.00"), m("405.56"))]
    assert rows(spark.table("product_performance")) == rows(
        sales.product_performance(shop["dim_products"], shop["fact_order_items"], shop["fact_reviews"]))


def test_analytics_run_writes_every_block(spark, shop, tmp_path):
    written = run_analytics(Tables(shop), str(tmp_path))
    for name in written:
        assert os.path.isdir(tmp_path / name) or os.path.isdir(tmp_path / "report" / name)
    assert spark.read.parquet(f"{tmp_path}/customer_features").count() == 4
    with pytest.raises(ValueError):
        run_analytics(Tables(shop), str(tmp_path / "second"), fail_below=99.5)
    assert not os.path.exists(tmp_path / "second")


@pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="test data absent")
def test_churn_run(spark, tmp_path):
    b = Binding(spark, DIRECTORY)
    tables = Tables({"dim_customers": b.customers, "dim_products": b.products, "fact_orders": b.orders,
                     "fact_order_items": b.lines, "fact_returns": b.returns})
    run_churn(tables, str(tmp_path), "2001-01-29", rounds=2)
    scores = spark.read.option("header", True).csv(f"{tmp_path}/scores")
    assert scores.count() == 967
    tiers = {r.risk_tier: r.customers for r in spark.read.json(f"{tmp_path}/report/risk_tiers").collect()}
    assert set(tiers) == {"Low", "Medium", "High", "Critical", "Total"} and tiers.pop("Total") == sum(tiers.values()) == 967
    facts = spark.read.json(f"{tmp_path}/report/run_facts").first()
    assert facts.n_train + facts.n_test == facts.n_scored == 967 and facts.horizon_days == 183
    assert spark.read.json(f"{tmp_path}/report/decile_lift").count() == 10
    assert os.path.isdir(tmp_path / "model")
