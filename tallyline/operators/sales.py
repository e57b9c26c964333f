"""Sales queries and views.

Lines are summed per order before they meet orders, and orders per customer before they
meet customers. Every shuffle therefore carries map-side combined rows, and a customer,
product, store or country that owns a large share of the facts is a single row by the
time it is joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline.functions.columns import mean, month_of, ratio, status_filter, total
from tallyline.functions.derive import CANCELLED, full_name
from tallyline.operators.ordering import cumulative_share, top_k, top_ranked
from tallyline.operators.windows import growth, moving_avg
from tallyline.sources.sinks import write_table


def _per_order(items: DataFrame, **measures: Column) -> DataFrame:
    return items.groupBy("order_id").agg(*[c.alias(n) for n, c in measures.items()])


def _customer_sales(orders: DataFrame, items: DataFrame, status_in=None, status_not_in=None,
                    dates: bool = False) -> DataFrame:
    """Per customer: distinct orders that have lines, and line revenue."""
    per_order = _per_order(items, revenue=F.sum("line_revenue"))
    kept = orders.where(status_filter("order_status", status_in, status_not_in))
    aggs = [F.count_distinct("order_id").alias("total_orders"), F.sum("revenue").alias("revenue")]
    if dates:
        aggs += [F.min("order_date").alias("first_purchase"), F.max("order_date").alias("last_purchase")]
    columns = ["order_id", "customer_id", *(["order_date"] if dates else [])]
    return kept.select(*columns).join(per_order, "order_id").groupBy("customer_id").agg(*aggs)


def top_customers(customers: DataFrame, orders: DataFrame, items: DataFrame,
                  status_in: Sequence[str] | None = None,
                  status_not_in: Sequence[str] | None = (CANCELLED,), k: int = 20) -> DataFrame:
    """The k customers with the highest lifetime revenue, ties by customer_id."""
    sales = _customer_sales(orders, items, status_in, status_not_in)
    named = customers.select("customer_id", full_name().alias("customer_name"), "country", "customer_segment")
    ranked = top_k(sales.join(named, "customer_id"), "revenue", "customer_id", k)
    return ranked.select("customer_id", "customer_name", "country", "customer_segment", "total_orders",
                         F.col("revenue").alias("lifetime_revenue"),
                         ratio("revenue", "total_orders", digits=2).alias("avg_order_value"))


def _product_revenue(items: DataFrame, products: DataFrame, *columns: str) -> DataFrame:
    per_product = items.groupBy("product_id").agg(F.sum("line_revenue").alias("total_revenue"),
                                                  F.sum("quantity").alias("units_sold"))
    return per_product.join(products.select("product_id", *columns), "product_id")


def top_products_ranked(items: DataFrame, products: DataFrame, k: int = 20) -> DataFrame:
    """Products ranked at most k overall, with their rank inside the category.

    Every product ahead of a listed one is listed too, so the rank in the category can be
    taken over the listed rows: no window ever sees a whole category.
    """
    revenue = _product_revenue(items, products, "product_name", "category")
    listed = top_ranked(revenue, "total_revenue", k)
    in_category = Window.partitionBy("category").orderBy(F.col("total_revenue").desc())
    return listed.withColumn("rank_in_category", F.rank().over(in_category)).select(
        "product_id", "product_name", "category", "total_revenue", "units_sold",
        "rank_in_category", "rank_overall")


def _monthly(items: DataFrame) -> DataFrame:
    return items.groupBy(month_of("order_date").alias("month")).agg(F.sum("line_revenue").alias("revenue"))


def monthly_revenue_mom(items: DataFrame) -> DataFrame:
    return growth(_monthly(items), "revenue", "month", "prev_month_revenue", "mom_growth_pct")


def quarterly_revenue_yoy(items: DataFrame) -> DataFrame:
    quarterly = (items.groupBy(F.year("order_date").alias("yr"), F.quarter("order_date").alias("qtr"))
                 .agg(F.sum("line_revenue").alias("revenue")))
    return growth(quarterly, "revenue", "yr", "revenue_same_qtr_prior_year", "yoy_growth_pct", by=["qtr"])


def rolling_revenue(items: DataFrame, months: int = 3) -> DataFrame:
    return moving_avg(_monthly(items), "revenue", "month", months, "rolling_avg")


def monthly_retention(orders: DataFrame, status_in: Sequence[str] | None = None,
                      status_not_in: Sequence[str] | None = (CANCELLED,)) -> DataFrame:
    """Active customers per month, those also active one calendar month earlier, and the
    rate against the previous listed month's active customers.

    A customer's previous active month comes from a window over the distinct months of
    that customer, which replaces a self-join of the customer-month set.
    """
    kept = orders.where(status_filter("order_status", status_in, status_not_in))
    active = kept.select(month_of("order_date").alias("month"), "customer_id").distinct()
    before = F.lag("month").over(Window.partitionBy("customer_id").orderBy("month"))
    flagged = active.withColumn(
        "retained", F.col("customer_id").isNotNull() & (before == F.add_months("month", -1)))
    monthly = flagged.groupBy("month").agg(
        F.count("customer_id").alias("active_customers"),
        F.count_if("retained").alias("retained_from_prior_month"))
    previous = F.lag("active_customers").over(Window.orderBy("month"))
    return monthly.withColumn(
        "retention_rate_pct", ratio("retained_from_prior_month", previous, scale=100, digits=2))


def _annualised(revenue: str = "revenue", days: str = "customer_lifespan_days") -> Column:
    # scaled by 365 inside the exact division, at least one day of lifespan
    return ratio(revenue, F.greatest(F.col(days), F.lit(1)), scale=365, digits=2)


def customer_clv(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Lifespan, orders, revenue and annualised value per customer with a line."""
    sales = _customer_sales(orders, items, dates=True)
    return (sales.join(customers.select("customer_id", "customer_segment"), "customer_id")
            .withColumn("customer_lifespan_days", F.datediff("last_purchase", "first_purchase"))
            .select("customer_id", "customer_segment", "first_purchase", "last_purchase",
                    "customer_lifespan_days", "total_orders", F.col("revenue").alias("total_revenue"),
                    ratio("revenue", "total_orders", digits=2).alias("avg_order_value"),
                    _annualised().alias("estimated_annualized_clv")))


def customer_clv_lookup(customers: DataFrame, orders: DataFrame, items: DataFrame,
                        customer_id) -> DataFrame:
    """The value row of one customer; the id filter reaches the customer and order scans."""
    mine = orders.where(F.col("customer_id") == customer_id)
    owned = items.join(mine.select("order_id"), "order_id", "left_semi")
    row = customer_clv(customers.where(F.col("customer_id") == customer_id), mine, owned)
    return row.select("customer_id", "total_orders", "total_revenue", "avg_order_value",
                      F.col("estimated_annualized_clv").alias("estimated_annual_clv"))


def inventory_turnover(products: DataFrame, items: DataFrame, inventory: DataFrame,
                       k: int = 50) -> DataFrame:
    """Cost of goods sold over average inventory value; the k highest, ties by product."""
    cogs = items.groupBy("product_id").agg(F.sum("line_cost").alias("cogs"))
    stock = inventory.groupBy("product_id").agg(F.sum("stock_on_hand").alias("stock"),
                                                F.count("stock_on_hand").alias("places"))
    # the unit cost is one value per product, so the mean of stock times cost factors
    value = ratio(F.col("stock") * F.col("unit_cost"), "places")
    turnover = F.try_divide(F.col("cogs").cast("decimal(20,2)") * F.col("places").cast("decimal(8,0)"),
                            F.col("stock").cast("decimal(20,0)") * F.col("unit_cost").cast("decimal(10,2)"))
    joined = (products.select("product_id", "product_name", "category", "unit_cost")
              .join(stock, "product_id").where(F.col("unit_cost") * F.col("stock") > 0)
              .join(cogs, "product_id", "left"))
    rows = joined.select("product_id", "product_name", "category",
                         F.coalesce("cogs", F.lit(0)).cast("decimal(22,2)").alias("total_cogs"),
                         value.alias("avg_inventory_value"),
                         F.round(turnover, 2).alias("inventory_turnover_ratio"))
    return top_k(rows, "inventory_turnover_ratio", "product_id", k)


def basket_size_by_channel(orders: DataFrame, items: DataFrame) -> DataFrame:
    per_order = _per_order(items, lines=F.count(F.lit(1)), revenue=F.sum("line_revenue"))
    grouped = (orders.select("order_id", "channel").join(per_order, "order_id").groupBy("channel")
               .agg(F.count_distinct("order_id").alias("total_orders"),
                    F.sum("lines").alias("total_line_items"), F.sum("revenue").alias("revenue")))
    return grouped.select("channel", "total_orders", "total_line_items",
                          ratio("total_line_items", "total_orders", digits=2).alias("avg_basket_size"),
                          ratio("revenue", "total_orders", digits=2).alias("avg_order_value"))


def category_margin(items: DataFrame, products: DataFrame) -> DataFrame:
    per_product = items.groupBy("product_id").agg(
        F.sum("line_revenue").alias("revenue"), F.sum("line_cost").alias("cost"),
        F.sum("line_profit").alias("profit"))
    return (per_product.join(products.select("product_id", "category"), "product_id")
            .groupBy("category")
            .agg(F.sum("revenue").alias("revenue"), F.sum("cost").alias("cost"),
                 F.sum("profit").alias("profit"))
            .withColumn("margin_pct", ratio("profit", "revenue", scale=100, digits=2)))


def regional_sales(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    sales = _customer_sales(orders, items)
    return (sales.join(customers.select("customer_id", "country"), "customer_id").groupBy("country")
            .agg(F.sum("total_orders").alias("total_orders"),
                 F.count("customer_id").alias("unique_customers"),
                 F.sum("revenue").alias("total_revenue"))
            .withColumn("avg_order_value", ratio("total_revenue", "total_orders", digits=2)))


def product_pareto(items: DataFrame, products: DataFrame, a: float = 0.80, b: float = 0.95,
                   rows_per_bucket: int | None = None) -> DataFrame:
    """Cumulative revenue and product shares from the best seller down, and the A/B/C
    class. Products of equal revenue share one cumulative revenue."""
    revenue = (_product_revenue(items, products, "product_name")
               .select("product_id", "product_name", F.col("total_revenue").alias("revenue")))
    options = {} if rows_per_bucket is None else {"rows_per_bucket": rows_per_bucket}
    ranked = cumulative_share(revenue, "revenue", "product_id", frame="range", **options)
    reached = ratio("running_revenue", "grand_total")
    return ranked.select(
        "product_id", "product_name", "revenue",
        ratio("running_revenue", "grand_total", scale=100, digits=2).alias("cumulative_revenue_pct"),
        ratio("row_number", "total_rows", scale=100, digits=2).alias("cumulative_product_pct"),
        F.when(reached <= a, "A").when(reached <= b, "B").otherwise("C").alias("abc_class"))


def order_summary(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their customer's attributes, line count and profit; orders without
    lines stay, with count 0 and a null profit."""
    per_order = _per_order(items, line_item_count=F.count(F.lit(1)), total_profit=F.sum("line_profit"))
    who = customers.select("customer_id", "customer_segment", F.col("country").alias("customer_country"))
    keep = [c for c in ("order_id", "order_date", "customer_id", "channel", "order_status",
                        "payment_method", "total_amount") if c in orders.columns]
    return (orders.select(*keep).join(who, "customer_id").join(per_order, "order_id", "left")
            .withColumn("line_item_count", F.coalesce("line_item_count", F.lit(0))))


def product_performance(products: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Units, revenue and profit next to the review mean and count. Both branches are
    aggregated before they join, so lines and reviews do not multiply each other."""
    sold = items.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"), F.sum("line_revenue").alias("total_revenue"),
        F.sum("line_profit").alias("total_profit"))
    # distinct reviews in two combinable steps: (product, review), then product
    rated = (reviews.groupBy("product_id", "review_id")
             .agg(F.sum("rating").alias("s"), F.count("rating").alias("n"))
             .groupBy("product_id")
             .agg(ratio(F.sum("s"), F.sum("n"), digits=2).alias("avg_rating"),
                  F.count("review_id").alias("review_count")))
    keep = [c for c in ("product_id", "product_name", "category", "subcategory", "brand")
            if c in products.columns]
    return (products.select(*keep).join(sold, "product_id", "left").join(rated, "product_id", "left")
            .withColumn("review_count", F.coalesce("review_count", F.lit(0))))


def store_performance(stores: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders, revenue and order value per store; stores without sales stay. Orders
    without lines count as orders."""
    per_order = _per_order(items, revenue=F.sum("line_revenue"))
    sales = (orders.select("order_id", "store_id").join(per_order, "order_id", "left")
             .groupBy("store_id")
             .agg(F.count_distinct("order_id").alias("total_orders"), F.sum("revenue").alias("total_revenue")))
    keep = [c for c in ("store_id", "store_name", "store_type", "country", "city") if c in stores.columns]
    return (stores.select(*keep).join(sales, "store_id", "left")
            .withColumn("total_orders", F.coalesce("total_orders", F.lit(0)))
            .withColumn("avg_order_value", ratio("total_revenue", "total_orders", digits=2)))


def daily_sales_summary(items: DataFrame) -> DataFrame:
    per_order = items.groupBy("order_date", "order_id").agg(
        F.sum("quantity").alias("units"), F.sum("line_revenue").alias("revenue"),
        F.sum("line_profit").alias("profit"))
    return per_order.groupBy("order_date").agg(
        F.count("order_id").alias("order_count"), F.sum("units").alias("units_sold"),
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"))


def customer_rfm_base(customers: DataFrame, orders: DataFrame, items: DataFrame, as_of: str,
                      status_in: Sequence[str] | None = None,
                      status_not_in: Sequence[str] | None = (CANCELLED,)) -> DataFrame:
    """Last order, days since it at `as_of`, order count and line revenue per customer."""
    sales = _customer_sales(orders, items, status_in, status_not_in, dates=True)
    return (sales.join(customers.select("customer_id"), "customer_id", "left_semi")
            .select("customer_id", F.col("last_purchase").alias("last_order_date"),
                    F.datediff(F.to_date(F.lit(as_of)), "last_purchase").alias("recency_days"),
                    F.col("total_orders").alias("frequency"), F.col("revenue").alias("monetary")))


def refresh_all(tables: Mapping[str, DataFrame], out: str, as_of: str) -> None:
    """Rebuild the stored daily summary and RFM base."""
    base = out.rstrip("/")
    write_table(daily_sales_summary(tables["fact_order_items"]), f"{base}/daily_sales_summary")
    write_table(customer_rfm_base(tables["dim_customers"], tables["fact_orders"],
                                  tables["fact_order_items"], as_of), f"{base}/customer_rfm_base")
