"""Customer features with RFM scores and segments, their summary, and cohort retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.functions.columns import mean, month_index, month_of, ratio
from tallyline.functions.derive import REVENUE_STATUSES
from tallyline.operators.filters import revenue_orders
from tallyline.operators.ordering import ROWS_PER_BUCKET, quantile_score, share_of_total
from tallyline.session import never_broadcast


def rfm_segment(r: str = "R", f: str = "F", m: str = "M", buyer: str = "is_buyer") -> Column:
    """Segment name; the first matching rule wins."""
    r, f, m = F.col(r), F.col(f), F.col(m)
    # Segment names and their score bounds.
    rules = [
        ("Never Purchased", ~F.col(buyer)),
        ("Champions", (r >= 4) & (f >= 4) & (m >= 4)),
        ("Loyal Customers", (r >= 3) & (f >= 3) & (m >= 4)),
        ("New Customers", (r >= 4) & (f <= 2)),
        ("Potential Loyalists", (r >= 3) & (f >= 3)),
        ("At Risk", (r <= 2) & (f >= 3) & (m >= 3)),
        ("Can't Lose Them", (r <= 2) & (m >= 4)),
        ("Hibernating", (r <= 2) & (f <= 2)),
    ]
    return F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules], F.lit("Needs Attention"))


def purchase_summary(orders: DataFrame) -> DataFrame:
    """Per customer: distinct orders, amount, order dates."""
    return orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("frequency"), F.sum("total_amount").alias("monetary"),
        F.count("total_amount").alias("amounts"), F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"))


def customer_features(customers: DataFrame, orders: DataFrame, snapshot: str | None = None, k: int = 5,
                      status_in: Sequence[str] = REVENUE_STATUSES,
                      rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """All customers with recency, frequency, monetary, tenure, k-quantile scores and
    segment as of the snapshot date (default: the day after the last revenue order).

    A customer without a revenue order has frequency 0, scores 0, and the days since
    signup as recency.
    """
    rev = revenue_orders(orders, status_in)
    day = (F.to_date(F.lit(snapshot)) if snapshot else
           rev.agg(F.date_add(F.max("order_date"), 1)).scalar())
    base = (customers.join(never_broadcast(purchase_summary(rev)), "customer_id", "left")
            .withColumn("_day", day)
            .withColumns({
                "frequency": F.coalesce("frequency", F.lit(0)),
                "avg_order_value": F.coalesce(ratio("monetary", "amounts"), F.lit(0.0)),
                "tenure_days": F.datediff("_day", "signup_date"),
            })
            .withColumns({
                "monetary": F.coalesce("monetary", F.lit(0)).cast("decimal(22,2)"),
                "recency_days": F.coalesce(F.datediff("_day", "last_order"), F.col("tenure_days")),
                "is_buyer": F.col("frequency") > 0,
            })
            .drop("_day", "amounts"))
    scored = quantile_score(
        base, {"R": ("recency_days", True), "F": ("frequency", False), "M": ("monetary", False)},
        "customer_id", k, eligible=F.col("is_buyer"), rows_per_bucket=rows_per_bucket)
    return scored.withColumns({"rfm_score": F.col("R") + F.col("F") + F.col("M"),
                               "rfm_segment": rfm_segment()}).drop("is_buyer")


def rfm_summary(features: DataFrame) -> DataFrame:
    """Per segment: customers, mean recency and frequency, revenue, and revenue share."""
    grouped = features.groupBy("rfm_segment").agg(
        F.count("customer_id").alias("customers"),
        mean("recency_days", 2).alias("avg_recency_days"), mean("frequency", 2).alias("avg_frequency"),
        F.sum("monetary").alias("total_revenue"), mean("monetary", 2).alias("avg_monetary"))
    return share_of_total(grouped, "total_revenue", "revenue_share_pct")


def cohort_retention(customers: DataFrame, orders: DataFrame, max_periods: int = 12, last: int = 12,
                     status_in: Sequence[str] = REVENUE_STATUSES) -> DataFrame:
    """Long form: cohort month, its size, months since signup, active customers, rate (%).

    Every period that occurs anywhere is listed for every cohort, 0 where the cohort was
    inactive. A cohort without any activity keeps its rows with a null rate. Only the
    latest `last` cohorts are returned.
    """
    signed = customers.select("customer_id", month_of("signup_date").alias("cohort"))
    signed = signed.where(F.col("cohort").isNotNull())
    # distinct order months per customer first: the join sees at most one row per month
    months = (revenue_orders(orders, status_in)
              .select("customer_id", month_of("order_date").alias("order_month")).distinct())
    active = (months.join(never_broadcast(signed), "customer_id")
              .withColumn("period", month_index("order_month") - month_index("cohort"))
              .where(F.col("period").between(0, max_periods - 1))
              .groupBy("cohort", "period").agg(F.count_distinct("customer_id").alias("active")))
    sizes = (signed.groupBy("cohort").agg(F.count_distinct("customer_id").alias("cohort_size"))
             .orderBy(F.col("cohort").desc()).limit(last))
    grid = (sizes.withColumn("period", F.explode(F.sequence(F.lit(0), F.lit(max_periods - 1))))
            .join(active.select("period").distinct(), "period", "left_semi"))
    alive = active.select("cohort").distinct().withColumn("alive", F.lit(True))
    filled = grid.join(active, ["cohort", "period"], "left").join(alive, "cohort", "left")
    shown = F.when(F.col("alive"), F.coalesce("active", F.lit(0)))
    return filled.select("cohort", "cohort_size", "period", shown.alias("active_customers"),
                         ratio(shown, "cohort_size", scale=100, digits=1).alias("retention_pct"))


def pivot_periods(retention: DataFrame, n: int) -> DataFrame:
    """Wide retention matrix with one column per period 0..n-1; absent cells are 0,
    a cohort without any activity stays null."""
    wide = retention.groupBy("cohort", "cohort_size").pivot("period", list(range(n))).agg(F.first("retention_pct"))
    known = retention.groupBy("cohort").agg(F.max("active_customers").alias("_top"))
    cells = [F.when(F.col("_top").isNotNull(), F.coalesce(F.col(f"`{i}`"), F.lit(0))).alias(f"period_{i}")
             for i in range(n)]
    return wide.join(known, "cohort").select("cohort", "cohort_size", *cells)
