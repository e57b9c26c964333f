"""More registered queries: baskets, upkeep of stored tables, scenarios, sources and sinks.

They are added to the catalogue's registry; their SQL is in `oracle_extended`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from tallyline.operators import (baskets, churn, clv, dimensions, metrics, scenarios, sketches)
from tallyline.plans.catalogue import OBS, _as_declared, _fresh, _labelled, _stream, query
from tallyline.session import cut_lineage
from tallyline.sources import readers, sinks
from tallyline.sources.bindings import DERIVED
from tallyline.sources.readers import Tables
from tallyline.streaming import daily, upsert

# Fixed values of the registered queries.
CLV_TRAIN, CLV_TEST = "2000-07-29", OBS
CSV_TABLES = ("dim_customers", "dim_products", "dim_stores", "fact_orders", "fact_reviews", "fact_returns")


# --- market baskets -----------------------------------------------------------------

def _category_lines(b) -> DataFrame:
    return b.lines.select("order_id", "product_id").join(b.products.select("product_id", "category"), "product_id")


@query
def basket_pairs(b):
    """Products bought together in two orders or more. The limit on a basket kept in one piece
    is low here, so that both ways of forming pairs are used."""
    return baskets.frequent_pairs(b.lines, max_items=5)


@query
def basket_sets(b):
    """Sets of categories in one order of a hundred or more, by FP-growth."""
    lines = cut_lineage(_category_lines(b))
    least = max(2, (lines.agg(F.count_distinct("order_id")).first()[0] or 0) // 100)
    return baskets.frequent_sets(lines, product="category", min_orders=least).select(
        F.array_join("items", " + ").alias("items"), "n_orders")


@query
def basket_rules(b):
    """Which category follows from which others, with confidence and lift."""
    lines = cut_lineage(_category_lines(b))
    n = lines.agg(F.count_distinct("order_id")).first()[0] or 0
    sets = baskets.frequent_sets(lines, product="category", min_orders=max(2, n // 100))
    return baskets.rules(sets, n).withColumn("antecedent", F.array_join("antecedent", " + "))


# --- dimensions ---------------------------------------------------------------------

@query
def key_map(b):
    """Dense customer keys after two loads: customers with a negative balance first, then all."""
    out = _fresh(b, "keys")
    owing = b.raw("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("customer_id"))
    dimensions.store_key_map(b.spark, out, owing, "customer_id", load=0)
    return dimensions.store_key_map(b.spark, out, b.customers, "customer_id", load=1)


@query
def audit_time(b):
    """Products with their change time: how many have one, and how many of these are of today's run."""
    start = b.spark.range(1).select(F.current_timestamp().alias("t")).first()["t"]
    touched = dimensions.touch(b.products)
    return touched.agg(F.count(F.lit(1)).alias("n_rows"), F.count("updated_at").alias("n_touched"),
                       F.count_if(F.col("updated_at") >= F.lit(start)).alias("n_fresh"))


# --- sketches, scenarios, customer value --------------------------------------------

@query
def distinct_rollup(b):
    """Distinct users per month and quarter from stored daily sketches, beside the exact counts."""
    out = _fresh(b, "sketches")
    sketches.daily_sketches(b.events, "ts", "user_id").write.parquet(out)
    stored = b.spark.read.parquet(out)
    parts = []
    for unit in ("month", "quarter"):
        exact = b.events.groupBy(F.trunc(F.col("ts").cast("date"), unit).alias("period")).agg(F.count_distinct("user_id").alias("users"))
        estimate = sketches.estimates(sketches.roll_up(stored, unit), "estimate")
        close = F.abs(F.col("estimate") - F.col("users")) <= F.col("users") * sketches.relative_error() + 1
        parts.append(exact.join(estimate, "period").select(F.lit(unit).alias("unit"), "period", "users", close.alias("is_close")))
    return parts[0].unionByName(parts[1])


@query
def anomaly_flags(b):
    """Months whose order revenue in a channel is far from that of the six months before."""
    monthly = b.orders.groupBy("channel", F.trunc("order_date", "MM").alias("month")).agg(F.sum("total_amount").alias("revenue"))
    return scenarios.anomaly_flags(monthly, "revenue", "month", 6, ["channel"])


@query
def budget_reallocation(b):
    """A fifth of every channel's spend moved to the channels above the common return."""
    return scenarios.reallocate_budget(metrics.marketing_performance(b.campaigns)["by_channel"]).withColumn(
        "expected_revenue", F.round("expected_revenue", 2))


@query
def clv_regression(b):
    """Spend ahead by segment, learned at one date and tested half a year later."""
    tables = {"dim_customers": b.customers, "dim_products": b.products, "fact_orders": b.orders,
              "fact_order_items": b.lines, "fact_returns": b.returns}
    errors = clv.clv_errors(clv.clv_rows(tables, CLV_TRAIN), clv.clv_rows(tables, CLV_TEST))
    sane = F.col("model_error").isNotNull() & ~F.isnan("model_error") & (F.col("model_error") >= 0)
    return errors.select("customer_segment", "n_train", "n_test", F.round("mean_error", 2).alias("mean_error"), sane.alias("has_model_error"))


# --- streaming ----------------------------------------------------------------------

@query
def stream_daily_windows(b):
    """Purchases per day with open days as state and a watermark of two days."""
    out = _fresh(b, "windows")
    bought = (_stream(b, "events").where(F.col("event_type") == "purchase")
              .withColumn("amount", F.col("value").cast("decimal(12,2)")))
    daily.stream_daily_windows(bought, out, f"{out}-state", "ts", "user_id", "amount").awaitTermination()
    return daily.read_daily_windows(b.spark, out)


@query
def stream_upsert_buckets(b):
    """The newest order of every customer, in buckets that a batch rewrites."""
    out = _fresh(b, "buckets")
    stream = _stream(b, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    upsert.stream_upsert_buckets(stream, out, f"{out}-state", "o_custkey", "o_orderkey", buckets=8).awaitTermination()
    return upsert.read_buckets(b.spark, out, stream.schema).drop("updated_at")


# --- sources and sinks --------------------------------------------------------------

@query
def csv_all_tables(b):
    """Six tables written as gzip CSV and loaded together; absent tables are skipped."""
    out, tables = _fresh(b, "csv-all"), b.tables()
    for name in CSV_TABLES:
        sinks.write_table(_as_declared(tables[name], name), f"{out}/{name}.csv.gz", "csv")
    return readers.row_counts(readers.load_tables(b.spark, out, names=(*CSV_TABLES,)))


@query
def csv_other_header(b):
    """Daily visitors from a file whose header names the date differently."""
    out = _fresh(b, "csv-header")
    rows = _as_declared(b.traffic, "fact_website_traffic").withColumnRenamed("traffic_date", "date")
    sinks.write_table(rows, f"{out}/fact_website_traffic.csv.gz", "csv")
    return readers.read_table(b.spark, out, "fact_website_traffic").select("traffic_date", "visitors", "sessions")


@query
def reconciled_load(b):
    """Orders as CSV with planted faults: every source row is landed or in quarantine."""
    out, name = _fresh(b, "checked"), "fact_orders"
    declared = _as_declared(b.orders, name)
    rows = declared.select(*[F.col(c).cast("string").alias(c) for c in declared.columns]).withColumns({
        "total_amount": F.when(F.pmod("order_id", F.lit(97)) == 0, "12,3x").otherwise(F.col("total_amount")),
        "order_date": F.when(F.pmod("order_id", F.lit(101)) == 0, "soon").otherwise(F.col("order_date"))})
    sinks.write_table(rows, f"{out}/in/{name}.csv.gz", "csv")
    return sinks.land_checked(b.spark, f"{out}/in", [name], f"{out}/out")


@query
def table_statistics(b):
    """Column statistics of a catalog table of orders, as the optimizer sees them."""
    table = f"tallyline_orders_{uuid.uuid4().hex}"
    b.orders.select("order_id", "customer_id").write.saveAsTable(table)
    try:
        sinks.analyze(b.spark, table)
        found = []
        for column in ("order_id", "customer_id"):
            facts = {r["info_name"]: r["info_value"] for r in b.spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect()}
            found.append((column, int(facts["min"]), int(facts["max"]), int(facts["num_nulls"])))
    finally:
        b.spark.sql(f"DROP TABLE {table}")
    return b.spark.createDataFrame(found, "column_name string, low bigint, high bigint, n_null bigint")


@query
def model_round_trip(b):
    """A logistic model stored and loaded again scores every customer alike."""
    rows = cut_lineage(churn.stratified_split(_labelled(b), "churned", "customer_id"))
    model, out = churn.fit_one(rows.where(~F.col("is_test"))), _fresh(b, "model")
    sinks.save_model(model, out)
    before = churn.with_probability(model, rows).select("customer_id", F.col("p").alias("p_before"))
    after = churn.with_probability(sinks.load_model(out), rows).select("customer_id", "p")
    return before.join(after, "customer_id").agg(F.count(F.lit(1)).alias("n_customers"),
                                                 F.count_if(F.col("p") == F.col("p_before")).alias("n_equal"))


@query
def all_blocks(b):
    """Rows of every block of a full run of the report. Tables that are not plain scans are landed first:
    the blocks and checks read the lines alone eight times, each time behind two joins."""
    blocks = metrics.compute_all(sinks.landed(b.tables(), _fresh(b, "blocks"), DERIVED))
    return readers.row_counts(Tables(blocks)).withColumnRenamed("table_name", "block")
