"""Row-level derivations: money on lines, statuses, bands, rates, the date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.functions.columns import MONEY, col, money, ratio, share_true

# Fixed values.
REVENUE_STATUSES = ("Completed", "Shipped")
CANCELLED = "Cancelled"
RETURNED = "Returned"
ONLINE = "Online"


def line_money(items: DataFrame) -> DataFrame:
    """Revenue, cost and profit of a line from price, unit cost, quantity and discount."""
    price, cost = money("unit_price"), money("unit_cost")
    discount = F.col("discount_pct").cast("decimal(5,4)")
    quantity = F.col("quantity").cast("decimal(8,0)")
    revenue = F.round(price * quantity * (F.lit(1).cast("decimal(1,0)") - discount), 2)
    return (items
            .withColumns({"line_revenue": revenue.cast(MONEY),
                          "line_cost": F.round(cost * quantity, 2).cast(MONEY)})
            .withColumn("line_profit", (F.col("line_revenue") - F.col("line_cost")).cast(MONEY)))


def order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with `total_amount` rolled up from their lines; 0 where there is none."""
    rolled = items.groupBy("order_id").agg(F.sum("line_revenue").alias("total_amount"))
    return (orders.drop("total_amount")
            .join(rolled, "order_id", "left")
            .withColumn("total_amount", F.coalesce(F.col("total_amount"), F.lit(0)).cast("decimal(22,2)")))


def product_margin(products: DataFrame) -> DataFrame:
    return products.withColumn(
        "margin_pct",
        ratio(money("unit_price") - money("unit_cost"), "unit_price", scale=100, digits=2))


def stock_status(inventory: DataFrame) -> DataFrame:
    return inventory.withColumn(
        "stock_status",
        F.when(F.col("stock_on_hand") == 0, "Out of Stock")
         .when(F.col("stock_on_hand") < F.col("reorder_point"), "Low Stock")
         .otherwise("In Stock"))


def shipping_delay(shipping: DataFrame) -> DataFrame:
    return shipping.withColumn(
        "is_delayed", F.col("actual_transit_days") > F.col("promised_delivery_days"))


def delay_rate(shipping: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Shipments, delayed shipments and delay rate (%), overall or per group."""
    return (shipping_delay(shipping).groupBy(*(by or []))
            .agg(F.count(F.lit(1)).alias("shipments"),
                 F.count_if(F.col("is_delayed")).alias("delayed"),
                 (share_true(F.col("is_delayed")) * 100).alias("delay_rate_pct")))


def campaign_rates(campaigns: DataFrame) -> DataFrame:
    """Click-through and conversion rate (%), and return on spend, per campaign."""
    clicks = F.greatest(F.col("clicks"), F.lit(1))
    return campaigns.withColumns({
        "ctr_pct": ratio("clicks", "impressions", scale=100, digits=3),
        "conversion_rate_pct": ratio("conversions", clicks, scale=100, digits=3),
        "roas": ratio("revenue_generated_usd", "budget_usd", digits=2),
    })


def rating_sentiment(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn(
        "sentiment",
        F.when(F.col("rating") <= 2, "Negative")
         .when(F.col("rating") == 3, "Neutral")
         .when(F.col("rating") >= 4, "Positive"))


def tenure_band(customers: DataFrame, as_of: Column) -> DataFrame:
    """Band 0..3 by days since signup: under 90, under 365, under 730, longer."""
    days = F.datediff(as_of, F.col("signup_date"))
    return customers.withColumns({
        "tenure_days": days,
        "tenure_band": F.when(days < 90, 0).when(days < 365, 1).when(days < 730, 2)
                        .when(days.isNotNull(), 3),
    })


def standardize_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.initcap(F.trim(F.col(c))) for c in columns})


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """First and last name joined by a blank; null when either part is null."""
    return F.concat(col(first), F.lit(" "), col(last))


def date_dimension(bounds: DataFrame, fiscal_start_month: int = 2, aligned: bool = False) -> DataFrame:
    """One row per day for each (start_date, end_date) row of `bounds`.

    The fiscal year starts in `fiscal_start_month`. The fiscal quarter is the calendar
    quarter unless `aligned`, which counts quarters from the fiscal start.
    """
    day = F.col("full_date")
    quarter = (F.floor((F.month(day) - fiscal_start_month + 12) % 12 / 3) + 1 if aligned
               else F.ceil(F.month(day) / 3))
    iso_dow = F.extract(F.lit("DAYOFWEEK_ISO"), day)
    return (bounds
            .select(F.explode(F.sequence("start_date", "end_date",
                                         F.expr("INTERVAL 1 DAY"))).alias("full_date"))
            .select(
                F.date_format(day, "yyyyMMdd").cast("int").alias("date_sk"),
                day,
                iso_dow.cast("smallint").alias("day_of_week"),
                F.date_format(day, "EEEE").alias("day_name"),
                F.dayofmonth(day).cast("smallint").alias("day_of_month"),
                F.dayofyear(day).cast("smallint").alias("day_of_year"),
                F.weekofyear(day).cast("smallint").alias("week_of_year"),
                F.month(day).cast("smallint").alias("month_num"),
                F.date_format(day, "MMMM").alias("month_name"),
                F.quarter(day).cast("smallint").alias("quarter"),
                F.year(day).cast("smallint").alias("year"),
                iso_dow.isin(6, 7).alias("is_weekend"),
                (F.year(day) - F.when(F.month(day) >= fiscal_start_month, 0).otherwise(1))
                .cast("smallint").alias("fiscal_year"),
                quarter.cast("smallint").alias("fiscal_quarter")))


def dim_date(spark, start: str, end: str, fiscal_start_month: int = 2, aligned: bool = False) -> DataFrame:
    """Date dimension for an inclusive day range given as ISO text."""
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("start_date"),
                                   F.to_date(F.lit(end)).alias("end_date"))
    return date_dimension(bounds, fiscal_start_month, aligned)
