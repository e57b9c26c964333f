import pytest
from pyspark.sql import functions as F

from conftest import d, m, rows
from tallyline.operators import customers


def test_features_of_buyers_and_silent_customers(shop):
    got = {r.customer_id: r for r in customers.customer_features(shop["dim_customers"], shop["fact_orders"]).collect()}
    assert len(got) == 4
    c1 = got["c1"]  # the only buyer; snapshot 2023-04-16
    assert (c1.recency_days, c1.frequency, c1.monetary, c1.avg_order_value) == (1, 2, m("50.00"), 25.0)
    assert c1.tenure_days == 101 and (c1.first_order, c1.last_order) == (d("2023-03-01"), d("2023-04-15"))
    c4 = got["c4"]
    assert (c4.frequency, c4.R, c4.F, c4.M, c4.rfm_score, c4.rfm_segment) == (0, 0, 0, 0, 0, "Never Purchased")
    assert c4.recency_days == c4.tenure_days == 46


def test_snapshot_can_be_given(shop):
    got = customers.customer_features(shop["dim_customers"], shop["fact_orders"], snapshot="2023-12-31")
    assert got.where("customer_id = 'c1'").first().recency_days == 260


def test_segment_rules_cover_every_score(spark):
    def expected(r, f, m):
        if r >= 4 and f >= 4 and m >= 4:
            return "Champions"
        if r >= 3 and f >= 3 and m >= 4:
            return "Loyal Customers"
        if r >= 4 and f <= 2:
            return "New Customers"
        if r >= 3 and f >= 3:
            return "Potential Loyalists"
        if r <= 2 and f >= 3 and m >= 3:
            return "At Risk"
        if r <= 2 and m >= 4:
            return "Can't Lose Them"
        return "Hibernating" if r <= 2 and f <= 2 else "Needs Attention"
    grid = [(r, f, m, True) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(grid, "R int, F int, M int, is_buyer boolean")
    got = df.withColumn("s", customers.rfm_segment()).collect()
    assert all(x.s == expected(x.R, x.F, x.M) for x in got)
    assert len({x.s for x in got}) == 8


def _many(spark, n=400):
    people = spark.range(n).select(F.concat(F.lit("c"), "id").alias("customer_id"), F.lit(d("2023-01-01")).alias("signup_date"))
    orders = (spark.range(n * 3).select(
        F.concat(F.lit("o"), "id").alias("order_id"),
        # a third of all orders belong to one customer
        F.when(F.col("id") % 3 == 0, "c0").otherwise(F.concat(F.lit("c"), F.col("id") % (n - 7))).alias("customer_id"),
        F.date_add(F.lit(d("2023-01-01")), (F.col("id") * 7 % 300).cast("int")).alias("order_date"),
        F.lit("Completed").alias("order_status"),
        ((F.col("id") * 31 % 97) + 1).cast("decimal(12,2)").alias("total_amount")))
    return people, orders


@pytest.mark.parametrize("per_bucket", [60, 100_000])
def test_scores_bounded_and_money_reconciles(spark, per_bucket):
    people, orders = _many(spark)
    feats = customers.customer_features(people, orders, rows_per_bucket=per_bucket).cache()
    buyers = feats.where("frequency > 0")
    assert buyers.where("R not between 1 and 5 or F not between 1 and 5 or M not between 1 and 5").count() == 0
    assert feats.agg(F.sum("monetary")).first()[0] == orders.agg(F.sum("total_amount")).first()[0]
    assert feats.where("rfm_segment is null").count() == 0
    assert feats.select("rfm_segment").distinct().count() >= 3
    share = customers.rfm_summary(feats).agg(F.sum("revenue_share_pct")).first()[0]
    assert abs(float(share) - 100) < 0.5


def test_features_do_not_depend_on_partitioning_or_bucket_size(spark):
    people, orders = _many(spark)
    base = rows(customers.customer_features(people, orders))
    assert rows(customers.customer_features(people.repartition(7), orders.repartition(64), rows_per_bucket=50)) == base


def test_cohorts(spark):
    people = spark.createDataFrame([("a", d("2023-01-10")), ("b", d("2023-01-20")), ("c", d("2023-02-02")),
                                    ("e", d("2023-03-03"))], "customer_id string, signup_date date")
    orders = spark.createDataFrame([
        ("1", "a", d("2023-01-31"), "Completed"), ("2", "a", d("2023-01-31"), "Completed"),
        ("3", "b", d("2023-03-01"), "Shipped"), ("4", "c", d("2023-02-28"), "Completed"),
        ("5", "c", d("2023-01-01"), "Completed"), ("6", "e", d("2023-03-05"), "Cancelled")],
        "order_id string, customer_id string, order_date date, order_status string")
    got = {(str(r.cohort)[:7], r.period): (r.active_customers, r.retention_pct)
           for r in customers.cohort_retention(people, orders, max_periods=12).collect()}
    # period 1 occurs nowhere, so it is not listed; March has signups but no activity
    assert got == {("2023-01", 0): (1, m("50.0")), ("2023-01", 2): (1, m("50.0")),
                   ("2023-02", 0): (1, m("100.0")), ("2023-02", 2): (0, m("0.0")),
                   ("2023-03", 0): (None, None), ("2023-03", 2): (None, None)}
    latest = customers.cohort_retention(people, orders, last=1)
    assert {str(r.cohort)[:7] for r in latest.collect()} == {"2023-03"}
    wide = customers.pivot_periods(customers.cohort_retention(people, orders), 3)
    assert rows(wide, "period_0", "period_1", "period_2") == [
        (m("100.0"), m("0.0"), m("0.0")), (m("50.0"), m("0.0"), m("50.0")), (None, None, None)]
