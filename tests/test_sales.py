import pytest
from pyspark.sql import functions as F

from conftest import d, m, rows
from tallyline.operators import sales, windows


def test_top_customers_excludes_cancelled_and_unlined_orders(shop):
    got = sales.top_customers(shop["dim_customers"], shop["fact_orders"], shop["fact_order_items"])
    assert [tuple(r) for r in got.orderBy(F.desc("lifetime_revenue")).collect()] == [
        ("c1", "Ada Li", "FR", "Gold", 2, m("50.00"), m("25.00")),
        ("c2", "Bo Ek", "DE", "New", 1, m("10.00"), m("10.00")),
        ("c3", None, "FR", "Gold", 1, m("5.00"), m("5.00"))]
    one = sales.top_customers(shop["dim_customers"], shop["fact_orders"], shop["fact_order_items"], k=1)
    assert rows(one, "customer_id") == [("c1",)]


def test_product_ranks(spark, shop):
    got = sales.top_products_ranked(shop["fact_order_items"], shop["dim_products"], k=2)
    assert rows(got, "product_id", "total_revenue", "units_sold", "rank_in_category", "rank_overall") == [
        ("p1", m("20.00"), 2, 1, 2), ("p2", m("80.00"), 4, 1, 1)]


def test_rank_in_category_equals_the_full_window(spark):
    data = [(f"p{i:03d}", f"c{i % 3}", i * 37 % 23) for i in range(90)]
    products = spark.createDataFrame([(p, p, c) for p, c, _ in data], "product_id string, product_name string, category string")
    items = spark.createDataFrame([(p, m(v), 1) for p, _, v in data], "product_id string, line_revenue decimal(12,2), quantity int")
    got = {r.product_id: (r.rank_in_category, r.rank_overall)
           for r in sales.top_products_ranked(items, products, 20).collect()}
    for p, c, v in data:
        overall = 1 + sum(w > v for _, _, w in data)
        inside = 1 + sum(w > v for _, k, w in data if k == c)
        assert (overall <= 20) == (p in got)
        if p in got:
            assert got[p] == (inside, overall)


def test_monthly_and_quarterly_growth(spark, shop):
    items = shop["fact_order_items"]
    assert rows(sales.monthly_revenue_mom(items)) == [
        (d("2023-03-01"), m("30.00"), None, None), (d("2023-04-01"), m("30.00"), m("30.00"), m("0.00")),
        (d("2023-05-01"), m("45.00"), m("30.00"), m("50.00"))]
    assert rows(sales.rolling_revenue(items), "month", "rolling_avg") == [
        (d("2023-03-01"), m("30.00")), (d("2023-04-01"), m("30.00")), (d("2023-05-01"), m("35.00"))]
    two = items.unionByName(items.withColumn("order_date", F.add_months("order_date", 12))
                            .withColumn("line_revenue", (F.col("line_revenue") * 2).cast("decimal(12,2)")))
    yoy = {(r.yr, r.qtr): r.yoy_growth_pct for r in sales.quarterly_revenue_yoy(two).collect()}
    assert yoy[(2024, 2)] == m("100.00") and yoy[(2023, 1)] is None


def test_retention_uses_calendar_months(spark):
    orders = spark.createDataFrame([
        ("a", d("2023-01-31"), "o1"), ("a", d("2023-02-01"), "o2"), ("b", d("2023-01-05"), "o3"),
        ("b", d("2023-04-02"), "o4"), ("a", d("2023-04-09"), "o5"), (None, d("2023-02-03"), "o6"),
        ("a", d("2023-02-20"), "o7")], "customer_id string, order_date date, order_id string"
    ).withColumn("order_status", F.lit("Completed"))
    assert rows(sales.monthly_retention(orders)) == [
        (d("2023-01-01"), 2, 0, None), (d("2023-02-01"), 1, 1, m("50.00")), (d("2023-04-01"), 2, 0, m("0.00"))]


def test_customer_value(shop):
    args = shop["dim_customers"], shop["fact_orders"], shop["fact_order_items"]
    got = {r.customer_id: r for r in sales.customer_clv(*args).collect()}
    assert got["c1"].customer_lifespan_days == 45 and got["c1"].estimated_annualized_clv == m("405.56")
    assert got["c3"].customer_lifespan_days == 0 and got["c3"].estimated_annualized_clv == m("1825.00")
    looked_up = sales.customer_clv_lookup(*args, "c1").collect()
    assert [tuple(r) for r in looked_up] == [("c1", 2, m("50.00"), m("25.00"), m("405.56"))]
    assert sales.customer_clv_lookup(*args, "nobody").count() == 0


def test_turnover_skips_empty_stock(spark, shop):
    inv = spark.createDataFrame([("s1", "p1", 10), ("s2", "p1", 20), ("s1", "p2", 0)],
                                "store_id string, product_id string, stock_on_hand int")
    got = sales.inventory_turnover(shop["dim_products"], shop["fact_order_items"], inv)
    # cost of goods 8, mean stock value 15 * 4
    assert rows(got, "product_id", "total_cogs", "avg_inventory_value", "inventory_turnover_ratio") == [
        ("p1", m("8.00"), 60.0, m("0.13"))]


def test_channel_region_category(shop):
    orders, items = shop["fact_orders"], shop["fact_order_items"]
    assert rows(sales.basket_size_by_channel(orders, items)) == [
        ("In-Store", 3, 4, m("1.33"), m("15.00")), ("Online", 2, 2, m("1.00"), m("30.00"))]
    assert rows(sales.regional_sales(shop["dim_customers"], orders, items)) == [
        ("DE", 2, 1, m("50.00"), m("25.00")), ("FR", 3, 2, m("55.00"), m("18.33"))]
    assert rows(sales.category_margin(items, shop["dim_products"])) == [
        ("Home", m("85.00"), m("56.00"), m("29.00"), m("34.12")),
        ("Office", m("20.00"), m("8.00"), m("12.00"), m("60.00"))]


@pytest.mark.parametrize("per_bucket", [1, 1000])
def test_pareto_classes(shop, per_bucket):
    got = sales.product_pareto(shop["fact_order_items"], shop["dim_products"], rows_per_bucket=per_bucket)
    assert rows(got, "product_id", "cumulative_revenue_pct", "cumulative_product_pct", "abc_class") == [
        ("p1", m("95.24"), m("66.67"), "C"), ("p2", m("76.19"), m("33.33"), "A"), ("p3", m("100.00"), m("100.00"), "C")]


def test_views_keep_the_unmatched_side(shop):
    orders, items = shop["fact_orders"], shop["fact_order_items"]
    summary = {r.order_id: r for r in sales.order_summary(orders, shop["dim_customers"], items).collect()}
    assert len(summary) == 6
    assert (summary["o6"].line_item_count, summary["o6"].total_profit) == (0, None)
    assert (summary["o1"].line_item_count, summary["o1"].total_profit) == (2, m("13.50"))
    stores = rows(sales.store_performance(shop["dim_stores"], orders, items),
                  "store_id", "total_orders", "total_revenue", "avg_order_value")
    assert stores == [("s1", 2, m("40.00"), m("20.00")), ("s2", 1, m("5.00"), m("5.00")), ("s3", 0, None, None)]


def test_reviews_do_not_multiply_sales(shop):
    got = {r.product_id: r for r in sales.product_performance(
        shop["dim_products"], shop["fact_order_items"], shop["fact_reviews"]).collect()}
    assert (got["p2"].units_sold, got["p2"].total_revenue, got["p2"].avg_rating, got["p2"].review_count) == (
        4, m("80.00"), m("3.67"), 3)
    assert (got["p1"].units_sold, got["p1"].avg_rating, got["p1"].review_count) == (2, None, 0)


def test_daily_summary_rfm_base_and_refresh(spark, shop, tmp_path):
    assert rows(sales.daily_sales_summary(shop["fact_order_items"]))[0] == (
        d("2023-03-01"), 1, 2, m("30.00"), m("13.50"))
    base = sales.customer_rfm_base(shop["dim_customers"], shop["fact_orders"], shop["fact_order_items"], "2023-12-31")
    assert rows(base)[0] == ("c1", d("2023-04-15"), 260, 2, m("50.00"))
    sales.refresh_all(shop, str(tmp_path), "2023-12-31")
    sales.refresh_all(shop, str(tmp_path), "2023-12-31")
    assert rows(spark.read.parquet(f"{tmp_path}/customer_rfm_base")) == rows(base)


def test_positional_and_calendar_change(spark):
    df = spark.createDataFrame([(d("2024-01-01"), 100), (d("2024-02-01"), 110), (d("2024-04-01"), 121)], "month date, v int")
    near = {str(r.month): r.c for r in windows.pct_change(df, "v", "month", 1, "c").collect()}
    dense = {str(r.month): r.c for r in windows.pct_change(df, "v", "month", 1, "c", dense=True).collect()}
    assert near["2024-04-01"] == pytest.approx(10) and dense["2024-04-01"] is None
    assert near["2024-01-01"] is None and dense["2024-02-01"] == pytest.approx(10)
