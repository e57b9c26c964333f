"""SQL names for the tables and views, so that queries can be written in SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators import sales


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame], as_of: str) -> list[str]:
    """Temporary views for every table, and for the derived views whose tables are present.

    With customers, orders and lines there is also the table function
    `customer_clv_lookup(id)`. Returns the registered names.
    """
    frames = dict(tables)
    items, orders, customers = (tables.get(t) for t in ("fact_order_items", "fact_orders", "dim_customers"))
    if items is not None:
        frames["daily_sales_summary"] = sales.daily_sales_summary(items)
        if "dim_products" in tables and "fact_reviews" in tables:
            frames["product_performance"] = sales.product_performance(
                tables["dim_products"], items, tables["fact_reviews"])
        if orders is not None and "dim_stores" in tables:
            frames["store_performance"] = sales.store_performance(tables["dim_stores"], orders, items)
    has_value = not (items is None or orders is None or customers is None)
    if has_value:
        frames["order_summary"] = sales.order_summary(orders, customers, items)
        frames["customer_rfm_base"] = sales.customer_rfm_base(customers, orders, items, as_of)
        frames["customer_clv"] = sales.customer_clv(customers, orders, items)
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    if has_value:
        kind = customers.schema["customer_id"].dataType.simpleString()
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION customer_clv_lookup(wanted {kind})
            RETURNS TABLE (customer_id {kind}, total_orders BIGINT, total_revenue DECIMAL(22,2),
                           avg_order_value DECIMAL(22,2), estimated_annual_clv DECIMAL(22,2))
            RETURN SELECT customer_id, total_orders, total_revenue, avg_order_value, estimated_annualized_clv
                   FROM customer_clv WHERE customer_id = customer_clv_lookup.wanted""")
    return list(frames)
