from pyspark.sql import functions as F

from conftest import d, m, rows
from tallyline.functions import derive
from tallyline.functions.columns import ratio, report_edge


def test_line_money_and_order_totals(spark, shop):
    items = spark.createDataFrame([("o1", m("19.99"), m("7.5"), 3, m("0.15")), ("o2", m("0.05"), m("0.01"), 1, m("0.50"))],
                                  "order_id string, unit_price decimal(10,2), unit_cost decimal(10,2), quantity int, "
                                  "discount_pct decimal(5,4)")
    priced = derive.line_money(items)
    # 19.99 * 3 * 0.85 = 50.9745; 0.05 * 0.5 = 0.025 rounds half up
    assert rows(priced, "line_revenue", "line_cost", "line_profit") == [
        (m("0.03"), m("0.01"), m("0.02")), (m("50.97"), m("22.50"), m("28.47"))]
    totals = {r.order_id: r.total_amount for r in derive.order_totals(shop["fact_orders"], priced).collect()}
    assert totals["o1"] == m("50.97") and totals["o6"] == 0 and len(totals) == 6


def test_statuses_and_bands(spark):
    inv = spark.createDataFrame([(0, 5), (4, 5), (5, 5)], "stock_on_hand int, reorder_point int")
    assert [r.stock_status for r in derive.stock_status(inv).collect()] == ["Out of Stock", "Low Stock", "In Stock"]
    rev = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, None)], "rating int")
    assert [r.sentiment for r in derive.rating_sentiment(rev).collect()] == [
        "Negative", "Negative", "Neutral", "Positive", "Positive", None]
    cust = spark.createDataFrame([(d("2023-10-04"),), (d("2023-10-03"),), (d("2023-01-01"),), (d("2022-12-31"),),
                                  (d("2021-01-01"),)], "signup_date date")
    banded = derive.tenure_band(cust, F.to_date(F.lit("2024-01-01")))
    assert [r.tenure_band for r in banded.collect()] == [0, 1, 2, 2, 3]
    ship = spark.createDataFrame([(3, 3), (4, 3)], "actual_transit_days int, promised_delivery_days int")
    assert rows(derive.delay_rate(ship)) == [(2, 1, 50.0)]


def test_rates_survive_zero_denominators(spark):
    c = spark.createDataFrame([(0, 0, 0, m("0.00"), m("9.00")), (1000, 20, 3, m("10.00"), m("25.00"))],
                              "impressions int, clicks int, conversions int, budget_usd decimal(12,2), "
                              "revenue_generated_usd decimal(12,2)")
    assert rows(derive.campaign_rates(c), "ctr_pct", "conversion_rate_pct", "roas") == [
        (m("2.000"), m("15.000"), m("2.50")), (None, m("0.000"), None)]
    p = spark.createDataFrame([(m("0.00"), m("1.00")), (m("8.00"), m("5.00"))],
                              "unit_price decimal(10,2), unit_cost decimal(10,2)")
    assert rows(derive.product_margin(p), "margin_pct") == [(m("37.50"),), (None,)]


def test_text_and_names(spark):
    df = spark.createDataFrame([("  nEW york ", "Ada", "Li"), (None, "Cy", None)], "city string, first_name string, last_name string")
    assert rows(derive.standardize_text(df, ["city"]), "city") == [("New York",), (None,)]
    assert rows(df.select(derive.full_name())) == [("Ada Li",), (None,)]


def test_dim_date_rules(spark):
    days = {str(r.full_date): r for r in derive.dim_date(spark, "2021-01-01", "2025-12-31").collect()}
    assert len(days) == 1826
    first = days["2021-01-01"]
    assert (first.date_sk, first.day_of_week, first.day_name, first.week_of_year) == (20210101, 5, "Friday", 53)
    assert (first.fiscal_year, first.fiscal_quarter, first.is_weekend) == (2020, 1, False)
    assert (days["2024-02-29"].fiscal_year, days["2024-02-29"].day_of_year) == (2024, 60)
    assert days["2023-12-31"].is_weekend and days["2023-12-31"].month_name == "December"
    aligned = {str(r.full_date): r.fiscal_quarter
               for r in derive.dim_date(spark, "2024-01-01", "2024-12-31", aligned=True).collect()}
    assert (aligned["2024-01-31"], aligned["2024-02-01"], aligned["2024-05-01"]) == (4, 1, 2)


def test_ratio_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(m("100.01"), 2), (m("1.00"), 0)], "a decimal(12,2), n int")
    assert [r[0] for r in df.select(ratio("a", "n", digits=2)).collect()] == [m("50.01"), None]


def test_report_edge_types(spark):
    df = spark.createDataFrame([(m("1.50"), d("2024-01-02"), 3, float("nan"))], "a decimal(12,2), b date, c int, e double")
    assert report_edge(df).dtypes == [("a", "double"), ("b", "string"), ("c", "bigint"), ("e", "double")]
    assert tuple(report_edge(df).first()) == (1.5, "2024-01-02", 3, None)
