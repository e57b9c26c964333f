import json

import pytest
from pyspark.sql import functions as F

from conftest import d, m, rows
from tallyline.operators import forecast, metrics
from tallyline.sources.readers import Tables
from tallyline.sources.sinks import write_report


@pytest.fixture(scope="module")
def enriched(shop):
    return metrics.items_enriched(shop["fact_order_items"], shop["fact_orders"], shop["dim_products"])


def test_enriched_lines(enriched):
    assert rows(enriched, "order_item_id", "customer_id", "category") == [
        ("i1", "c1", "Office"), ("i2", "c1", "Home"), ("i3", "c1", "Home")]


def test_kpis(shop, enriched):
    k = metrics.executive_kpis(shop["fact_orders"], enriched, shop["fact_returns"]).first()
    assert (k.total_revenue, k.gross_profit, k.total_orders, k.unique_customers) == (m("50.00"), m("21.00"), 2, 1)
    assert k.gross_margin_pct == pytest.approx(42) and k.avg_order_value == 25.0
    assert k.repeat_purchase_rate_pct == 100.0 and k.return_rate_pct == 50.0
    assert k.revenue_yoy_pct == 0.0
    assert (k.date_start, k.date_end) == (d("2023-03-01"), d("2023-04-15"))


def test_kpis_of_no_orders(shop, enriched):
    k = metrics.executive_kpis(shop["fact_orders"].where("false"), enriched.where("false")).first()
    assert k.gross_margin_pct == 0 and k.avg_order_value == 0 and k.return_rate_pct == 0


def test_yoy_compares_the_last_two_years_present(spark, shop, enriched):
    later = shop["fact_orders"].withColumn("order_date", F.add_months("order_date", 36)).withColumn(
        "total_amount", (F.col("total_amount") * 3).cast("decimal(12,2)")).withColumn("order_id", F.concat("order_id", F.lit("x")))
    k = metrics.executive_kpis(shop["fact_orders"].unionByName(later), enriched).first()
    assert k.revenue_yoy_pct == pytest.approx(200)


def test_monthly_series_and_trend(shop):
    monthly = metrics.monthly_revenue(shop["fact_orders"])
    trend = metrics.monthly_trend(monthly)
    assert rows(trend, "month", "revenue", "orders", "revenue_mom_pct", "revenue_yoy_pct") == [
        ("2023-03", m("30.00"), 1, None, None), ("2023-04", m("20.00"), 1, -33.33, None)]


def test_null_groups_are_dropped(spark, shop, enriched):
    orders = shop["fact_orders"].withColumn("order_status", F.lit("Completed"))
    geo = metrics.geographic_performance(orders, shop["dim_customers"])
    assert rows(geo, "country", "revenue", "orders", "customers") == [("DE", m("50.00"), 2, 1), ("FR", m("55.00"), 4, 2)]
    nulled = orders.withColumn("channel", F.when(F.col("order_id") != "o1", F.col("channel")))
    assert rows(metrics.channel_mix(nulled), "channel", "orders") == [("In-Store", 2), ("Online", 3)]
    cat = metrics.category_performance(enriched.withColumn("category", F.when(F.col("category") == "Home", "Home")))
    assert rows(cat, "category", "revenue", "units", "margin_pct", "revenue_share_pct") == [
        ("Home", m("40.00"), 2, m("37.50"), m("100.00"))]
    reasons = metrics.returns_analysis(shop["fact_returns"])
    assert rows(reasons["by_reason"]) == [("Broken", 1, m("5.00"), m("100.00"))]
    assert rows(reasons["summary"]) == [(2, m("6.00"), m("50.00"))]


@pytest.mark.parametrize("per_bucket", [1, 1000])
def test_abc_partitions_the_products_sold(shop, enriched, per_bucket):
    abc = metrics.product_abc(enriched, shop["dim_products"], rows_per_bucket=per_bucket)
    assert rows(abc["classified"], "product_id", "abc_class") == [("p1", "C"), ("p2", "A")]
    assert abc["summary"].agg(F.sum("products")).first()[0] == abc["sold"].first()[0] == 2
    assert rows(abc["top"], "product_id") == [("p1",), ("p2",)]


def test_marketing_with_zero_spend(spark):
    c = spark.createDataFrame([("k1", "mail", m("0.00"), m("9.00"), 0, 0, 0), ("k2", "web", m("10.00"), m("25.00"), 1000, 20, 5),
                               ("k3", "web", m("10.00"), m("5.00"), 1000, 20, 5)],
                              "campaign_id string, channel string, budget_usd decimal(12,2), revenue_generated_usd decimal(12,2), "
                              "impressions bigint, clicks bigint, conversions bigint")
    out = metrics.marketing_performance(c)
    assert rows(out["by_channel"], "channel", "campaigns", "roas", "ctr_pct", "cvr_pct") == [
        ("mail", 1, None, None, None), ("web", 2, m("1.50"), m("2.00"), m("25.00"))]
    assert out["funnel"].first().blended_roas == m("1.95")


def test_forecast_recovers_exact_series_per_key(spark):
    season = [1.0, 1.2, 0.8, 1.0, 1.0, 1.0, 0.9, 1.1, 1.0, 1.0, 1.3, 0.7]
    def value(level, slope, i):
        return (level + slope * i) * season[i % 12]
    months = [d(f"{2021 + i // 12}-{i % 12 + 1:02d}-01") for i in range(36)]
    data = [(k, mo, value(lv, 0.0, i)) for k, lv in (("a", 100.0), ("b", 500.0)) for i, mo in enumerate(months)]
    series = spark.createDataFrame(data, "k string, month date, revenue double")
    got = {(r.k, r.month): r.revenue_forecast for r in forecast.revenue_forecast(series, ["k"], 6).collect()}
    assert len(got) == 12
    # the fitted trend of a flat seasonal series is close to flat: the season dominates
    for k, level in (("a", 100.0), ("b", 500.0)):
        for h in range(6):
            assert got[(k, f"2024-{h + 1:02d}")] == pytest.approx(level * season[h], rel=0.06)


def test_forecast_of_pure_trend_and_floor(spark):
    up = spark.createDataFrame([(d(f"2023-{i + 1:02d}-01"), 10.0 * (i + 1)) for i in range(12)], "month date, revenue double")
    assert [r.revenue_forecast for r in forecast.revenue_forecast(up, horizon=2).orderBy("month").collect()] == [130.0, 140.0]
    down = spark.createDataFrame([(d(f"2023-{i + 1:02d}-01"), 30.0 - 10 * i) for i in range(4)], "month date, revenue double")
    assert min(r.revenue_forecast for r in forecast.revenue_forecast(down).collect()) == 0.0


def test_correlations_need_four_periods(spark):
    revenue = spark.createDataFrame([(d(f"2023-0{i}-01"), 10.0 * i) for i in range(1, 6)], "period date, revenue double")
    drivers = spark.createDataFrame(
        [(d(f"2023-0{i}-01"), "up", 2.0 * i) for i in range(1, 6)] + [(d(f"2023-0{i}-01"), "down", -1.0 * i) for i in range(1, 5)]
        + [(d(f"2023-0{i}-01"), "short", 1.0 * i) for i in range(1, 4)], "period date, driver string, value double")
    assert rows(forecast.driver_correlations(revenue, drivers)) == [("down", -1.0, 4), ("up", 1.0, 5)]


def test_compute_all_blocks_are_consistent(spark, shop, tmp_path):
    blocks = metrics.compute_all(Tables(shop))
    k = blocks["executive_kpis"].first()
    assert float(k.gross_margin_pct) == pytest.approx(100 * float(k.gross_profit) / float(k.total_revenue))
    assert blocks["abc_summary"].agg(F.sum("products")).first()[0] == blocks["products_sold"].first()[0]
    assert blocks["meta"].first().tables_loaded == len(shop)
    assert float(blocks["category_performance"].agg(F.sum("revenue_share_pct")).first()[0]) == pytest.approx(100, abs=0.5)
    report = {n: blocks[n] for n in ("executive_kpis", "monthly_trend", "quality_score", "returns_by_reason")}
    write_report(report, str(tmp_path))
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/monthly_trend").collect()]
    assert {x["month"]: x["revenue_mom_pct"] for x in lines} == {"2023-03": None, "2023-04": -33.33}
