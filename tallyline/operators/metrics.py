"""Metric blocks of the executive report, each a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyline.functions.columns import month_of, ratio
from tallyline.functions.derive import REVENUE_STATUSES
from tallyline.operators.customers import cohort_retention, customer_features, rfm_summary
from tallyline.operators.filters import revenue_orders
from tallyline.operators.forecast import driver_correlations, monthly_driver, revenue_forecast
from tallyline.operators.ordering import ROWS_PER_BUCKET, cumulative_share, share_of_total, top_k
from tallyline.operators.quality import quality_report, quality_score
from tallyline.operators.windows import pct_change
from tallyline.session import cut_lineage, never_broadcast
from tallyline.sources.readers import run_meta


def monthly_revenue(orders: DataFrame, dense: bool = False,
                    status_in: Sequence[str] = REVENUE_STATUSES) -> DataFrame:
    """Month, revenue, orders, change against 12 and 1 rows before (months with `dense`)."""
    monthly = (revenue_orders(orders, status_in).groupBy(month_of("order_date").alias("month"))
               .agg(F.sum("total_amount").alias("revenue"), F.count_distinct("order_id").alias("orders")))
    yearly = pct_change(monthly, "revenue", "month", 12, "revenue_yoy_pct", dense=dense)
    return pct_change(yearly, "revenue", "month", 1, "revenue_mom_pct", dense=dense)


def monthly_trend(monthly: DataFrame) -> DataFrame:
    """Report form of the monthly series: `yyyy-MM`, two decimals, null where undefined."""
    def clean(c):
        return F.round(F.when(~F.isnan(c), F.col(c)), 2).alias(c)
    return monthly.select(F.date_format("month", "yyyy-MM").alias("month"),
                          F.round("revenue", 2).alias("revenue"), "orders",
                          clean("revenue_yoy_pct"), clean("revenue_mom_pct"))


def items_enriched(items: DataFrame, orders: DataFrame, products: DataFrame,
                   status_in: Sequence[str] = REVENUE_STATUSES) -> DataFrame:
    """Lines of revenue orders with order attributes and product category and brand."""
    keep = [c for c in ("order_id", "customer_id", "store_id", "channel", "order_status")
            if c in orders.columns]
    kept = revenue_orders(orders, status_in).select(*keep)
    lines = items.drop(*[c for c in keep if c != "order_id"])
    return (lines.join(never_broadcast(kept), "order_id")
            .join(never_broadcast(products.select("product_id", "category", "brand")), "product_id", "left"))


def combined_per_product(enriched: DataFrame) -> DataFrame:
    """Lines summed per product and category, under the line column names.

    The blocks below only add lines up, so they accept this frame in place of the lines:
    one pass over the facts serves them all.
    """
    return enriched.groupBy("product_id", "category").agg(
        F.sum("line_revenue").alias("line_revenue"), F.sum("line_profit").alias("line_profit"),
        F.sum("quantity").alias("quantity"))


def executive_kpis(orders: DataFrame, enriched: DataFrame, returns: DataFrame | None = None,
                   status_in: Sequence[str] = REVENUE_STATUSES) -> DataFrame:
    """One row of headline figures.

    Order figures come from one pass per customer; a customer's orders are combined
    before they are counted. Parts are joined as scalar subqueries.
    """
    rev = revenue_orders(orders, status_in)
    per_customer = rev.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("n"), F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    known = F.col("customer_id").isNotNull()
    order_side = per_customer.agg(
        F.sum("n").alias("total_orders"), F.count("customer_id").alias("unique_customers"),
        (ratio(F.count_if(known & (F.col("n") > 1)), F.count("customer_id")) * 100).alias("repeat_purchase_rate_pct"),
        F.min("lo").alias("date_start"), F.max("hi").alias("date_end"))
    item_side = enriched.agg(F.struct(F.sum("line_revenue").alias("r"), F.sum("line_profit").alias("p")))
    by_year = rev.groupBy(F.year("order_date").alias("y")).agg(F.sum("total_amount").alias("v"))
    change = by_year.withColumn("before", F.lag("v").over(Window.orderBy("y")))
    latest = change.agg(F.max_by(F.coalesce((ratio("v", "before") - 1) * 100, F.lit(0.0)), "y"))
    out = order_side.withColumn("_items", item_side.scalar()).withColumn("revenue_yoy_pct", latest.scalar())
    returned = (F.lit(0) if returns is None else
                returns.agg(F.count_distinct("order_id")).scalar())
    out = out.withColumns({"_returned": returned, "total_revenue": F.col("_items.r"),
                           "gross_profit": F.col("_items.p")})
    return out.select(
        "total_revenue", "gross_profit",
        F.coalesce(ratio("gross_profit", "total_revenue", scale=100), F.lit(0.0)).alias("gross_margin_pct"),
        "total_orders", "unique_customers",
        F.coalesce(ratio("total_revenue", "total_orders"), F.lit(0.0)).alias("avg_order_value"),
        "repeat_purchase_rate_pct",
        F.coalesce(ratio("_returned", "total_orders", scale=100), F.lit(0.0)).alias("return_rate_pct"),
        "revenue_yoy_pct", "date_start", "date_end")


def geographic_performance(orders: DataFrame, customers: DataFrame,
                           status_in: Sequence[str] = REVENUE_STATUSES) -> DataFrame:
    per_customer = revenue_orders(orders, status_in).groupBy("customer_id").agg(
        F.sum("total_amount").alias("revenue"), F.count_distinct("order_id").alias("orders"))
    geo = (per_customer.join(never_broadcast(customers.select("customer_id", "country")), "customer_id")
           .where(F.col("country").isNotNull()).groupBy("country")
           .agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"),
                F.count("customer_id").alias("customers"))
           .withColumns({"avg_order_value": ratio("revenue", "orders", digits=2),
                         "revenue_per_customer": ratio("revenue", "customers", digits=2)}))
    return share_of_total(geo, "revenue", "revenue_share_pct")


def category_performance(enriched: DataFrame) -> DataFrame:
    cat = (enriched.where(F.col("category").isNotNull()).groupBy("category")
           .agg(F.sum("line_revenue").alias("revenue"), F.sum("line_profit").alias("profit"),
                F.sum("quantity").alias("units"))
           .withColumn("margin_pct", ratio("profit", "revenue", scale=100, digits=2)))
    return share_of_total(cat, "revenue", "revenue_share_pct")


def product_abc(enriched: DataFrame, products: DataFrame, a: float = 80, b: float = 95, top: int = 10,
                rows_per_bucket: int = ROWS_PER_BUCKET) -> dict[str, DataFrame]:
    """`classified` products by cumulative revenue (ties by product_id), the `summary` per
    class, the `top` sellers, and the `sold` count."""
    totals = enriched.groupBy("product_id").agg(F.sum("line_revenue").alias("revenue"),
                                                F.sum("line_profit").alias("profit"))
    named = totals.join(never_broadcast(products.select("product_id", "product_name", "category")), "product_id", "left")
    ranked = cumulative_share(named, "revenue", "product_id", rows_per_bucket=rows_per_bucket)
    reached = ratio("running_revenue", "grand_total", scale=100)
    classified = (ranked.withColumn("cum_revenue_pct", reached)
                  .withColumn("abc_class", F.when(F.col("cum_revenue_pct") <= a, "A")
                                            .when(F.col("cum_revenue_pct") <= b, "B").otherwise("C"))
                  .select("product_id", "product_name", "category", "revenue", "profit",
                          "cum_revenue_pct", "abc_class"))
    summary = classified.groupBy("abc_class").agg(F.count("product_id").alias("products"),
                                                  F.sum("revenue").alias("revenue"))
    summary = share_of_total(summary, "products", "product_share_pct")
    summary = share_of_total(summary, "revenue", "revenue_share_pct")
    leaders = top_k(named, "revenue", "product_id", top).select(
        "product_id", "product_name", "category", "revenue", "profit")
    return {"classified": classified, "summary": summary, "top": leaders,
            "sold": totals.agg(F.count("product_id").alias("n_products_sold"))}


def channel_mix(orders: DataFrame, status_in: Sequence[str] = REVENUE_STATUSES) -> DataFrame:
    mix = (revenue_orders(orders, status_in).where(F.col("channel").isNotNull()).groupBy("channel")
           .agg(F.sum("total_amount").alias("revenue"), F.count_distinct("order_id").alias("orders"))
           .withColumn("avg_order_value", ratio("revenue", "orders", digits=2)))
    return share_of_total(mix, "revenue", "revenue_share_pct")


def marketing_performance(campaigns: DataFrame) -> dict[str, DataFrame]:
    """Spend, reach and return `by_channel`, and the one-row `funnel` of all campaigns."""
    sums = [F.sum("budget_usd").alias("spend"), F.sum("revenue_generated_usd").alias("revenue"),
            F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
            F.sum("conversions").alias("conversions")]
    by_channel = (campaigns.where(F.col("channel").isNotNull()).groupBy("channel")
                  .agg(*sums, F.count("campaign_id").alias("campaigns"))
                  .withColumns({"roas": ratio("revenue", "spend", digits=2),
                                "ctr_pct": ratio("clicks", "impressions", scale=100, digits=2),
                                "cvr_pct": ratio("conversions", "clicks", scale=100, digits=2)}))
    funnel = campaigns.agg(*sums).select(
        "impressions", "clicks", "conversions", F.col("spend").alias("total_spend"),
        F.col("revenue").alias("total_revenue"), ratio("revenue", "spend", digits=2).alias("blended_roas"))
    return {"by_channel": by_channel, "funnel": funnel}


def returns_analysis(returns: DataFrame) -> dict[str, DataFrame]:
    """One-row `summary` with the restock rate, and counts and refunds `by_reason`."""
    restock = (ratio(F.count_if("restocked"), F.count("restocked"), scale=100, digits=2)
               if "restocked" in returns.columns else F.lit(None).cast("double"))
    summary = returns.agg(F.count(F.lit(1)).alias("total_returns"),
                          F.sum("refund_amount").alias("total_refunds"), restock.alias("restock_rate_pct"))
    by_reason = (returns.where(F.col("return_reason").isNotNull()).groupBy("return_reason")
                 .agg(F.count("return_id").alias("returns"), F.sum("refund_amount").alias("refund_amount")))
    return {"summary": summary, "by_reason": share_of_total(by_reason, "returns", "share_pct")}


def compute_all(tables: Mapping[str, DataFrame], max_periods: int = 12) -> dict[str, DataFrame]:
    """Every block of the report as a lazy DataFrame, with the quality gate and run data.

    What several blocks read is stored once: the per-product sums of the enriched lines, the
    base of the customer features, the monthly series and the quality checks.
    """
    orders, customers = tables["fact_orders"], tables["dim_customers"]
    enriched = items_enriched(tables["fact_order_items"], orders, tables["dim_products"])
    per_product = cut_lineage(combined_per_product(enriched))
    features = customer_features(customers, orders)
    monthly = cut_lineage(monthly_revenue(orders))
    report = cut_lineage(quality_report(tables))
    abc = product_abc(per_product, tables["dim_products"])
    blocks = {
        "executive_kpis": executive_kpis(orders, per_product, tables.get("fact_returns")),
        "monthly_trend": monthly_trend(monthly),
        "rfm_segments": rfm_summary(features),
        "cohort_retention": cohort_retention(customers, orders, max_periods),
        "geographic": geographic_performance(orders, customers),
        "category_performance": category_performance(per_product),
        "abc_summary": abc["summary"], "top_products": abc["top"], "products_sold": abc["sold"],
        "channel_mix": channel_mix(orders),
        "forecast": revenue_forecast(monthly),
        "quality_checks": report, "quality_score": quality_score(report),
        "meta": run_meta(tables),
        "customer_features": features, "items_enriched": enriched,
    }
    drivers = []
    if "fact_marketing_campaigns" in tables:
        campaigns = tables["fact_marketing_campaigns"]
        marketing = marketing_performance(campaigns)
        blocks["marketing_by_channel"] = marketing["by_channel"]
        blocks["marketing_funnel"] = marketing["funnel"]
        drivers.append(monthly_driver(campaigns, "start_date", "budget_usd", "Marketing spend"))
    if "fact_website_traffic" in tables:
        drivers.append(monthly_driver(tables["fact_website_traffic"], "traffic_date", "visitors",
                                      "Website visitors"))
    if drivers:
        series = drivers[0] if len(drivers) == 1 else drivers[0].unionByName(drivers[1])
        blocks["correlations"] = driver_correlations(
            monthly.select(F.col("month").alias("period"), "revenue"), series)
    if "fact_returns" in tables:
        returned = returns_analysis(tables["fact_returns"])
        blocks["returns_summary"] = returned["summary"]
        blocks["returns_by_reason"] = returned["by_reason"]
    return blocks

