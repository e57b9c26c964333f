"""The order-management test tables seen as canonical retail tables.

Columns without a counterpart are proxies derived from the given data; each is listed in
the README. Nations and regions may be broadcast, tables that grow are not.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.functions.columns import cents, from_cents
from tallyline.session import never_broadcast
from tallyline.sources.readers import Tables

# Layouts of the given tables.
LAYOUTS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
}

# The online channel, and literals of the inventory and shipping proxies.
ONLINE_PRIORITY = "1-URGENT"
REORDER_POINT = 40
PROMISED_DAYS = 30

# Tables that are joined or grouped from several given rows; the others are plain scans.
DERIVED = ("dim_customers", "fact_orders", "fact_order_items", "fact_returns", "fact_marketing_campaigns",
           "fact_website_traffic")

# Line revenue in whole cents: price times (1 - discount), rounded half up.
_REVENUE = f"FLOOR(({cents('l_extendedprice')} * (100 - {cents('l_discount')}) + 50) / 100)"
_LINE_ID = "CONCAT_WS('-', l_orderkey, l_linenumber)"
_COST = f"({cents('p_retailprice')} * CAST(l_quantity AS BIGINT))"
_ITEM = [f"{_LINE_ID} AS order_item_id", "l_orderkey AS order_id", "l_partkey AS product_id",
         "l_suppkey AS store_id", "CAST(l_quantity AS INT) AS quantity", f"{from_cents(_REVENUE)} AS line_revenue",
         f"{from_cents(_COST)} AS line_cost", f"{from_cents(f'({_REVENUE} - {_COST})')} AS line_profit"]
_UNIT_PRICE = from_cents(f"FLOOR({cents('l_extendedprice')} / l_quantity + 0.5)")


class Binding:
    """Canonical frames over one data directory; every frame is lazy."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        """A given table under its declared layout, so that no job reads file footers."""
        return self.spark.read.schema(LAYOUTS[name]).parquet(f"{self.directory}/{name}.parquet")

    def given(self, name: str) -> DataFrame:
        """Any given table under the layout its files declare."""
        return self.raw(name) if name in LAYOUTS else self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    @cached_property
    def _countries(self) -> DataFrame:
        """25 nations with their region."""
        return (self.raw("nation")
                .join(self.raw("region"), F.expr("n_regionkey = r_regionkey"), "left")
                .selectExpr("n_nationkey", "n_name AS country", "r_name AS acquisition_channel"))

    @cached_property
    def customers(self) -> DataFrame:
        return (self.raw("customer")
                .join(self._countries, F.expr("c_nationkey = n_nationkey"), "left")
                .selectExpr("c_custkey AS customer_id", "SUBSTRING_INDEX(c_name, '#', 1) AS first_name",
                            "SUBSTRING_INDEX(c_name, '#', -1) AS last_name", "country",
                            "acquisition_channel", "c_mktsegment AS customer_segment",
                            "CAST(FLOOR(c_acctbal / 100) AS INT) AS age",
                            "c_acctbal > 5000 AS is_loyalty_member"))

    @cached_property
    def customers_signed_up(self) -> DataFrame:
        """Customers with `signup_date`: the date of their first order of any status."""
        first = (self.raw("orders").groupBy(F.col("o_custkey").alias("customer_id"))
                 .agg(F.expr("CAST(MIN(o_orderdate) AS DATE) AS signup_date")))
        return self.customers.join(never_broadcast(first), "customer_id", "left")

    @cached_property
    def products(self) -> DataFrame:
        unit = cents("p_retailprice")
        return self.raw("part").selectExpr(
            "p_partkey AS product_id", "p_name AS product_name", "p_type AS category",
            "p_size AS subcategory", "p_brand AS brand",
            f"{from_cents(f'({unit} + p_size * 100)')} AS unit_price", f"{from_cents(unit)} AS unit_cost")

    @cached_property
    def stores(self) -> DataFrame:
        return (self.raw("supplier")
                .join(self._countries, F.expr("s_nationkey = n_nationkey"), "left")
                .selectExpr("s_suppkey AS store_id", "s_name AS store_name", "country",
                            "acquisition_channel AS city"))

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS order_id", "o_custkey AS customer_id", "CAST(o_orderdate AS DATE) AS order_date",
            "o_orderpriority AS channel",
            "CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Shipped' "
            "WHEN 'P' THEN 'Cancelled' END AS order_status",
            f"{from_cents(cents('o_totalprice'))} AS total_amount")

    @cached_property
    def orders_in_store(self) -> DataFrame:
        """Orders with `store_id`: the lowest supplier of the lines, "ONLINE" if no line."""
        store = (self.raw("lineitem").groupBy(F.col("l_orderkey").alias("order_id"))
                 .agg(F.expr("CAST(MIN(l_suppkey) AS STRING) AS store_id")))
        return (self.orders.join(never_broadcast(store), "order_id", "left")
                .withColumn("store_id", F.expr("COALESCE(store_id, 'ONLINE')")))

    @cached_property
    def lines(self) -> DataFrame:
        """Lines with revenue only: no join, for what needs neither cost nor date."""
        return self.raw("lineitem").selectExpr(
            f"{_LINE_ID} AS order_item_id", "l_orderkey AS order_id", "l_partkey AS product_id",
            "l_suppkey AS store_id", "CAST(l_quantity AS INT) AS quantity", f"{_UNIT_PRICE} AS unit_price",
            "CAST(l_discount AS DECIMAL(5,4)) AS discount_pct", f"{from_cents(_REVENUE)} AS line_revenue",
            "CAST(l_shipdate AS DATE) AS ship_date", "l_returnflag AS return_flag",
            "l_linestatus AS line_status")

    @cached_property
    def _lines_and_parts(self) -> DataFrame:
        return self.raw("lineitem").join(never_broadcast(self.raw("part")), F.expr("l_partkey = p_partkey"), "left")

    @cached_property
    def items(self) -> DataFrame:
        """Lines with cost and profit; the unit cost is the part's retail price."""
        return self._lines_and_parts.selectExpr(*_ITEM)

    @cached_property
    def items_dated(self) -> DataFrame:
        """`dated(items)`; the given columns, not the longer derived ones, go through both joins."""
        dates = self.raw("orders").selectExpr("o_orderkey", "CAST(o_orderdate AS DATE) AS order_date")
        both = self._lines_and_parts.join(never_broadcast(dates), F.expr("l_orderkey = o_orderkey"))
        return both.selectExpr(_ITEM[1], _ITEM[0], *_ITEM[2:], "order_date")

    @cached_property
    def items_per_product(self) -> DataFrame:
        """`items` summed per product before the one join with part, for results that only
        add lines up per product: a product with very many lines is a single row."""
        sold = (self.raw("lineitem").groupBy("l_partkey")
                .agg(F.expr(f"SUM({_REVENUE})").cast("bigint").alias("_revenue"),
                     F.expr("SUM(CAST(CAST(l_quantity AS INT) AS BIGINT))").alias("quantity")))
        cost = f"({cents('p_retailprice')} * quantity)"
        return (sold.join(self.raw("part"), F.expr("l_partkey = p_partkey"), "left")
                .selectExpr("l_partkey AS product_id", "quantity", f"{from_cents('_revenue')} AS line_revenue",
                            f"{from_cents(cost)} AS line_cost", f"{from_cents(f'(_revenue - {cost})')} AS line_profit"))

    def dated(self, items: DataFrame) -> DataFrame:
        """Lines with the date of their order. The lines are the left side, so an order
        with very many lines can be split between tasks."""
        dates = self.raw("orders").selectExpr("o_orderkey AS order_id", "CAST(o_orderdate AS DATE) AS order_date")
        return items.join(never_broadcast(dates), "order_id")

    def dated_totals(self, items: DataFrame, *measures: str, by: tuple[str, ...] = ()) -> DataFrame:
        """Lines summed per order (and `by`) before they meet the order dates.

        For results that only add lines up: an order with very many lines is a single row
        in the join, and every task combines its lines before the shuffle.
        """
        combined = items.groupBy("order_id", *by).agg(*[F.sum(m).alias(m) for m in measures])
        return self.dated(combined)

    @cached_property
    def returns(self) -> DataFrame:
        return (self.raw("lineitem").where("l_returnflag = 'R'")
                .join(never_broadcast(self.raw("part")), F.expr("l_partkey = p_partkey"), "left")
                .selectExpr(f"{_LINE_ID} AS return_id", "l_orderkey AS order_id",
                            f"{_LINE_ID} AS order_item_id", "CAST(l_shipdate AS DATE) AS return_date",
                            "p_type AS return_reason", f"{from_cents(_REVENUE)} AS refund_amount",
                            "l_linestatus = 'F' AS restocked"))

    @cached_property
    def inventory(self) -> DataFrame:
        return (self.raw("lineitem")
                .groupBy(F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("product_id"))
                .agg(F.expr("SUM(CAST(l_quantity AS BIGINT)) AS stock_on_hand"))
                .withColumn("reorder_point", F.lit(REORDER_POINT)))

    @cached_property
    def reviews(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            f"{_LINE_ID} AS review_id", "l_partkey AS product_id", "l_orderkey AS order_id",
            "CASE l_returnflag WHEN 'N' THEN 5 WHEN 'A' THEN 3 WHEN 'R' THEN 1 END AS rating")

    @cached_property
    def shipping(self) -> DataFrame:
        """One shipment per line; transit days are ship date minus order date."""
        return (self.raw("lineitem").join(self.raw("orders"), F.expr("l_orderkey = o_orderkey"))
                .selectExpr("l_orderkey AS order_id", "o_orderpriority AS carrier",
                            "DATEDIFF(l_shipdate, o_orderdate) AS actual_transit_days",
                            f"{PROMISED_DAYS} AS promised_delivery_days"))

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")

    @cached_property
    def campaigns(self) -> DataFrame:
        """One campaign per event key `k`: spend from clicks, revenue from purchases."""
        value = from_cents(cents("value"))
        return (self.events.groupBy(F.expr("CAST(GET_JSON_OBJECT(props, '$.k') AS INT) AS campaign_id"))
                .agg(F.expr("CAST(MIN(ts) AS DATE) AS start_date"),
                     F.expr(f"COALESCE(SUM(IF(event_type = 'click', {value}, NULL)), 0) AS budget_usd"),
                     F.expr(f"COALESCE(SUM(IF(event_type = 'purchase', {value}, NULL)), 0) AS revenue_generated_usd"),
                     F.expr("COUNT_IF(event_type = 'view') AS impressions"),
                     F.expr("COUNT_IF(event_type = 'click') AS clicks"),
                     F.expr("COUNT_IF(event_type = 'purchase') AS conversions"))
                .withColumn("channel", F.expr("CONCAT('channel-', campaign_id % 8)")))

    @cached_property
    def traffic(self) -> DataFrame:
        """Visitors (distinct users) and sessions (events) per day."""
        return (self.events.groupBy(F.expr("CAST(ts AS DATE) AS traffic_date"))
                .agg(F.expr("COUNT(DISTINCT user_id) AS visitors"), F.expr("COUNT(*) AS sessions")))

    @cached_property
    def daily_purchases(self) -> DataFrame:
        """Event revenue and spend per day, the series that shares its dates with traffic."""
        value = from_cents(cents("value"))
        return (self.events.groupBy(F.expr("CAST(ts AS DATE) AS day"))
                .agg(F.expr(f"SUM(IF(event_type = 'purchase', {value}, NULL)) AS revenue"),
                     F.expr(f"SUM(IF(event_type = 'click', {value}, NULL)) AS spend")))

    def tables(self) -> Tables:
        """The canonical table set for the quality gate and the full report."""
        return Tables({
            "dim_customers": self.customers_signed_up, "dim_products": self.products,
            "dim_stores": self.stores, "fact_orders": self.orders_in_store,
            "fact_order_items": self.items_dated, "fact_returns": self.returns,
            "fact_reviews": self.reviews, "fact_inventory": self.inventory,
            "fact_marketing_campaigns": self.campaigns, "fact_website_traffic": self.traffic,
        }, profile=self.directory.rsplit("/", 1)[-1])
