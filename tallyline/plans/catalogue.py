"""The registered queries: each binds the operators to a data directory.

Every query reads whole tables. `QUERIES` maps the name to a callable taking the session
and the directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.functions import derive
from tallyline.functions.columns import month_of, ratio, report_edge
from tallyline.operators import (churn, customers as cust, dimensions, filters, forecast, metrics,
                                 ordering, quality, sales)
from tallyline.plans.views import register_views
from tallyline.session import cut_lineage, shared_dir
from tallyline.sources import readers, sinks
from tallyline.sources.bindings import ONLINE_PRIORITY, Binding
from tallyline.sources.readers import Tables
from tallyline.sources.schemas import FOREIGN_KEYS, schema_of
from tallyline.streaming import daily, upsert, validate

# Fixed values of the registered queries.
AS_OF = "2001-08-02"
OBS = "2001-01-29"
FUTURE_FROM = "2001-06-30"
SCD_DAY = "1996-01-01"
GIVEN_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                "embeddings", "pages", "benchmark", "labels", "conversations")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Binding], DataFrame]) -> Callable[[Binding], DataFrame]:
    """Register a query under its function name."""
    def run(spark: SparkSession, directory: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return report_edge(fn(Binding(spark, directory)))
    QUERIES[fn.__name__] = run
    return fn


def _fresh(b: Binding, name: str) -> str:
    """A new folder below the shared directory for a query that writes."""
    return f"{shared_dir(b.spark)}/tallyline-{name}-{uuid.uuid4().hex}"


def _stream(b: Binding, name: str) -> DataFrame:
    return (b.spark.readStream.schema(b.raw(name).schema)
            .option("pathGlobFilter", f"{name}.parquet").parquet(b.directory))


# --- derivations -------------------------------------------------------------------

@query
def dim_date(b):
    """Every day from the first to the last order, with the orders placed on it."""
    bounds = b.orders.agg(F.min("order_date").alias("start_date"), F.max("order_date").alias("end_date"))
    placed = b.orders.groupBy(F.col("order_date").alias("full_date")).agg(F.count(F.lit(1)).alias("n_orders"))
    return (derive.date_dimension(bounds).join(placed, "full_date", "left")
            .withColumn("n_orders", F.coalesce("n_orders", F.lit(0))))


@query
def line_money(b):
    priced = (b.lines.select("order_item_id", "product_id", "quantity", "unit_price", "discount_pct")
              .join(b.products.select("product_id", "unit_cost"), "product_id"))
    return derive.line_money(priced).select("order_item_id", "product_id", "line_revenue", "line_cost", "line_profit")


@query
def order_total_rollup(b):
    return derive.order_totals(b.orders, b.lines).select("order_id", "total_amount")


@query
def product_margin(b):
    return derive.product_margin(b.products).select("product_id", "margin_pct")


@query
def stock_status(b):
    return derive.stock_status(b.inventory).select("store_id", "product_id", "stock_on_hand", "stock_status")


@query
def shipping_delay(b):
    return derive.delay_rate(b.shipping, ["carrier"])


@query
def campaign_rates(b):
    return derive.campaign_rates(b.campaigns).select("campaign_id", "ctr_pct", "conversion_rate_pct", "roas")


@query
def rating_sentiment(b):
    return (derive.rating_sentiment(b.reviews).groupBy("rating", "sentiment")
            .agg(F.count(F.lit(1)).alias("n_reviews")))


@query
def tenure_band(b):
    return (derive.tenure_band(b.customers_signed_up, F.to_date(F.lit(AS_OF)))
            .select("customer_id", "tenure_days", "tenure_band"))


@query
def standardize_text(b):
    padded = b.products.select("product_id", F.concat(F.lit("  "), "category", F.lit(" ")).alias("category"))
    return derive.standardize_text(padded, ["category"])


@query
def surrogate_keys(b):
    keyed = dimensions.with_surrogate_key(b.customers, "customer_id", "customer_sk")
    return keyed.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("customer_id").alias("n_keys"),
                     F.count_distinct("customer_sk").alias("n_surrogates"))


def _versions(b) -> DataFrame:
    """Segment history: customers with a negative balance move to DELINQUENT, customers
    who signed up on the day of the change or later are new."""
    base = b.customers.select("customer_id", "customer_segment", "country")
    known = b.customers_signed_up.where(F.col("signup_date") < F.to_date(F.lit(SCD_DAY)))
    dim = dimensions.scd2_open(known.select(*base.columns), "1995-01-01")
    moved = b.raw("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("balance"))
    segment = F.when(F.col("balance") < 0, "DELINQUENT").otherwise(F.col("customer_segment"))
    updates = base.join(moved, "customer_id").select("customer_id", segment.alias("customer_segment"), "country")
    return dimensions.scd2_apply(dim, updates, "customer_id", ["customer_segment", "country"], SCD_DAY)


@query
def scd2_apply(b):
    return _versions(b)


@query
def scd2_asof(b):
    facts = b.orders.select("order_id", "customer_id", "order_date", "total_amount")
    seen = dimensions.scd2_asof(facts, _versions(b), "customer_id", "order_date", ["customer_segment"])
    return seen.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("n_orders"),
                                                F.sum("total_amount").alias("revenue"))


# --- filters, existence joins, sets -------------------------------------------------

@query
def revenue_orders(b):
    return filters.revenue_orders(b.orders)


@query
def orders_not_cancelled(b):
    return filters.where_status(b.orders, status_not_in=["Cancelled"]).select("order_id", "order_status")


@query
def pit_split(b):
    return filters.pit_split(b.orders, OBS, 183).select("order_id", "customer_id", "order_date", "side")


@query
def eligibility(b):
    return filters.eligibility(b.orders, b.lines, online=ONLINE_PRIORITY, returned="Cancelled")


@query
def semi_join_items(b):
    return (filters.semi(b.lines, filters.revenue_orders(b.orders), "order_id")
            .select("order_item_id", "order_id", "product_id", "line_revenue"))


@query
def set_except_orders(b):
    return filters.keys_missing(b.orders, b.lines, "order_id")


@query
def dq_duplicate_keys(b):
    return filters.duplicate_keys(b.lines, ["order_item_id"])


@query
def dq_orphan_items(b):
    revenue = filters.revenue_orders(b.orders)
    return filters.orphans(b.lines, "order_id", revenue, "order_id").select("order_item_id", "order_id")


@query
def dq_invalid_values(b):
    lines = filters.invalid_values(b.items, {
        "negative revenue": F.col("line_revenue") < 0, "non-positive quantity": F.col("quantity") <= 0,
        "sold at a loss": F.col("line_profit") < 0})
    people = filters.invalid_values(b.customers, {"age out of range": (F.col("age") < 13) | (F.col("age") > 100)})
    goods = filters.invalid_values(b.products, {
        "non-positive price": F.col("unit_price") <= 0, "negative cost": F.col("unit_cost") < 0})
    return (lines.select(F.col("order_item_id").alias("key"), "reason")
            .unionByName(people.select(F.col("customer_id").cast("string").alias("key"), "reason"))
            .unionByName(goods.select(F.col("product_id").cast("string").alias("key"), "reason")))


@query
def dq_orders_without_items(b):
    return filters.orphans(b.orders, "order_id", b.lines, "order_id").select("order_id")


@query
def dq_future_dated(b):
    return filters.future_dated(b.orders, "order_date", FUTURE_FROM).select("order_id", "order_date")


@query
def dq_amount_outliers(b):
    return (quality.amount_outliers(b.orders, "total_amount", k=1.5).select("order_id", "total_amount"))


@query
def dq_null_audit(b):
    # line attributes of the orders: an order without lines has none
    revenue = b.lines.groupBy("order_id").agg(F.sum("line_revenue").alias("line_total"))
    wide = b.orders.join(revenue, "order_id", "left")
    return quality.null_audit(wide, ["order_id", "customer_id", "order_date", "line_total"])


# --- global order -------------------------------------------------------------------

@query
def prefix_scan(b):
    rows = b.orders.select("order_id", "total_amount")
    return ordering.prefix_scan(rows, "total_amount", "order_id", sums=["total_amount"], descending=True)


@query
def rank_within_channel(b):
    rows = b.orders.select("order_id", "channel", "total_amount")
    return ordering.rank_within(rows, ["channel"], "total_amount", "order_id")


@query
def top_products_per_category(b):
    revenue = b.lines.groupBy("product_id").agg(F.sum("line_revenue").alias("revenue"))
    named = revenue.join(b.products.select("product_id", "category"), "product_id")
    return ordering.top_k_within(named, ["category"], "revenue", "product_id", 3)


@query
def quantile_score(b):
    rows = b.orders.select("order_id", "total_amount", "order_date")
    return ordering.quantile_score(rows, {"amount_band": ("total_amount", False)}, "order_id", k=5)


# --- sales queries and views --------------------------------------------------------

@query
def top_customers(b):
    return sales.top_customers(b.customers, b.orders, b.lines)


@query
def top_products_ranked(b):
    return sales.top_products_ranked(b.lines, b.products)


@query
def monthly_revenue_mom(b):
    return sales.monthly_revenue_mom(b.dated_totals(b.lines, "line_revenue"))


@query
def quarterly_revenue_yoy(b):
    return sales.quarterly_revenue_yoy(b.dated_totals(b.lines, "line_revenue"))


@query
def monthly_retention(b):
    return sales.monthly_retention(b.orders)


@query
def customer_clv(b):
    return sales.customer_clv(b.customers, b.orders, b.lines)


@query
def inventory_turnover(b):
    return sales.inventory_turnover(b.products, b.items_per_product, b.inventory)


@query
def basket_size_by_channel(b):
    return sales.basket_size_by_channel(b.orders, b.lines)


@query
def category_margin(b):
    return sales.category_margin(b.items_per_product, b.products)


@query
def regional_sales(b):
    return sales.regional_sales(b.customers, b.orders, b.lines)


@query
def product_pareto(b):
    return sales.product_pareto(b.lines, b.products)


@query
def rolling_3mo_revenue(b):
    return sales.rolling_revenue(b.dated_totals(b.lines, "line_revenue"), 3)


@query
def order_summary(b):
    return sales.order_summary(b.orders, b.customers, b.items)


@query
def product_performance(b):
    return sales.product_performance(b.products, b.items_per_product, b.reviews)


@query
def store_performance(b):
    stores = b.stores.withColumn("store_id", F.col("store_id").cast("string"))
    return sales.store_performance(stores, b.orders_in_store, b.lines)


@query
def daily_sales_summary(b):
    return sales.daily_sales_summary(b.dated_totals(b.items, "quantity", "line_revenue", "line_profit"))


@query
def customer_rfm_base(b):
    return sales.customer_rfm_base(b.customers, b.orders, b.lines, AS_OF)


@query
def refresh_all(b):
    """Both stored summaries are rebuilt and read back."""
    out = _fresh(b, "refresh")
    sales.refresh_all({"fact_order_items": b.dated(b.items), "dim_customers": b.customers,
                       "fact_orders": b.orders}, out, AS_OF)
    days = b.spark.read.parquet(f"{out}/daily_sales_summary")
    base = b.spark.read.parquet(f"{out}/customer_rfm_base")
    return (days.agg(F.lit("daily_sales_summary").alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                     F.sum("revenue").alias("revenue"))
            .unionByName(base.agg(F.lit("customer_rfm_base").alias("table_name"),
                                  F.count(F.lit(1)).alias("n_rows"), F.sum("monetary").alias("revenue"))))


@query
def customer_clv_lookup(b):
    return sales.customer_clv_lookup(b.customers, b.orders, b.lines, 7)


# --- quality gate -------------------------------------------------------------------

def _gate(b) -> DataFrame:
    """All checks. Orders without lines have the store marker for online orders. The given data
    also names a store on the line, and that key is checked as well."""
    tables = Tables({"dim_customers": b.customers_signed_up, "dim_products": b.products,
                     "dim_stores": b.stores, "fact_orders": b.orders_in_store, "fact_order_items": b.lines,
                     "fact_returns": b.returns, "fact_reviews": b.reviews})
    return quality.quality_report(tables, fks=[*FOREIGN_KEYS, ("fact_order_items", "store_id", "dim_stores", "store_id")])


@query
def quality_report(b):
    return _gate(b).drop("detail")


@query
def quality_score(b):
    return quality.quality_score(_gate(b))


# --- features and metric blocks -----------------------------------------------------

def _enriched(b) -> DataFrame:
    return metrics.items_enriched(b.items, b.orders, b.products)


@query
def customer_features(b):
    return (cust.customer_features(b.customers_signed_up, b.orders)
            .select("customer_id", "recency_days", "frequency", "monetary", "avg_order_value", "first_order",
                    "last_order", "tenure_days", "R", "F", "M", "rfm_score", "rfm_segment"))


@query
def rfm_summary(b):
    return cust.rfm_summary(cust.customer_features(b.customers_signed_up, b.orders))


@query
def cohort_retention(b):
    return cust.cohort_retention(b.customers_signed_up, b.orders)


@query
def cohort_matrix(b):
    return cust.pivot_periods(cust.cohort_retention(b.customers_signed_up, b.orders, max_periods=6), 6)


@query
def monthly_revenue(b):
    return metrics.monthly_revenue(b.orders)


@query
def monthly_revenue_dense(b):
    return metrics.monthly_revenue(b.orders, dense=True)


@query
def monthly_trend(b):
    return metrics.monthly_trend(metrics.monthly_revenue(b.orders))


@query
def items_enriched(b):
    return _enriched(b).select("order_item_id", "order_id", "customer_id", "channel", "order_status",
                               "product_id", "category", "brand", "quantity", "line_revenue", "line_profit")


@query
def executive_kpis(b):
    return metrics.executive_kpis(b.orders, _enriched(b), b.returns)


@query
def geographic_performance(b):
    return metrics.geographic_performance(b.orders, b.customers)


@query
def category_performance(b):
    return metrics.category_performance(_enriched(b))


@query
def product_abc(b):
    return metrics.product_abc(_enriched(b), b.products)["classified"]


@query
def product_abc_summary(b):
    return metrics.product_abc(_enriched(b), b.products)["summary"]


@query
def product_abc_top(b):
    return metrics.product_abc(_enriched(b), b.products)["top"]


@query
def channel_mix(b):
    return metrics.channel_mix(b.orders)


@query
def marketing_by_channel(b):
    return metrics.marketing_performance(b.campaigns)["by_channel"]


@query
def marketing_funnel(b):
    return metrics.marketing_performance(b.campaigns)["funnel"]


@query
def returns_summary(b):
    return metrics.returns_analysis(b.returns)["summary"]


@query
def returns_by_reason(b):
    return metrics.returns_analysis(b.returns)["by_reason"]


@query
def revenue_forecast(b):
    return forecast.revenue_forecast(metrics.monthly_revenue(b.orders))


@query
def revenue_forecast_by_category(b):
    """One series per product category, from line revenue."""
    named = b.lines.join(b.products.select("product_id", "category"), "product_id")
    series = (b.dated_totals(named, "line_revenue", by=("category",))
              .groupBy("category", month_of("order_date").alias("month"))
              .agg(F.sum("line_revenue").alias("revenue")))
    return forecast.revenue_forecast(series, keys=["category"])


@query
def driver_correlations(b):
    """Daily purchase revenue against visitors and click spend."""
    day = F.col("traffic_date")
    visitors = b.traffic.select(day.alias("period"), F.lit("Website visitors").alias("driver"),
                                F.col("visitors").cast("decimal(22,2)").alias("value"))
    spend = b.daily_purchases.select(F.col("day").alias("period"), F.lit("Marketing spend").alias("driver"),
                                     F.col("spend").cast("decimal(22,2)").alias("value"))
    revenue = b.daily_purchases.select(F.col("day").alias("period"), "revenue")
    return forecast.driver_correlations(revenue, spend.unionByName(visitors))


@query
def linear_trend(b):
    """Monthly revenue trend per channel."""
    monthly = (b.orders.groupBy("channel", month_of("order_date").alias("month"))
               .agg(F.sum("total_amount").cast("double").alias("revenue"))
               .withColumn("x", (F.year("month") * 12 + F.month("month")).cast("double")))
    fit = forecast.linear_trend(monthly, "revenue", "x", ["channel"])
    return fit.select("channel", F.round("slope", 2).alias("slope"), F.round("intercept", 0).alias("intercept"), "n")


@query
def correlate(b):
    """Quantity against revenue of the lines, per return flag."""
    lines = b.lines.select("return_flag", F.col("quantity").alias("x"), F.col("line_revenue").alias("y"))
    return forecast.correlate(lines, "x", "y", ["return_flag"])


@query
def customer_clv_sql(b):
    """The value of one customer through the SQL table function."""
    register_views(b.spark, {"dim_customers": b.customers, "fact_orders": b.orders,
                             "fact_order_items": b.dated(b.items)}, AS_OF)
    return b.spark.sql("SELECT * FROM customer_clv_lookup(7)")


@query
def run_meta(b):
    """Size of a run over all tables given."""
    return readers.run_meta(Tables({n: b.given(n) for n in GIVEN_TABLES})).drop("profile", "generated_at")


# --- sources and sinks --------------------------------------------------------------

def _as_declared(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema_of(name).fields])


@query
def csv_round_trip(b):
    """Orders written as gzip CSV and read back with the declared types."""
    out = _fresh(b, "csv")
    sinks.write_table(_as_declared(b.orders, "fact_orders"), f"{out}/fact_orders.csv.gz", "csv")
    tables = readers.load_tables(b.spark, out, names=("fact_orders",))
    return tables["fact_orders"].select("order_id", "customer_id", "order_date", "order_status", "total_amount")


@query
def land_tables(b):
    """All canonical tables landed as Parquet, counted by reading them back."""
    return sinks.land(b.tables(), _fresh(b, "land"))


@query
def year_partitions(b):
    """Orders written by year with a default partition, summed by reading all of them back."""
    out = _fresh(b, "years")
    sinks.write_partitioned(b.orders, out, "order_date", 1996, 2000)
    stored = b.spark.read.parquet(out)
    return stored.groupBy(F.col("order_year").cast("string").alias("order_year")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("total_amount").alias("revenue"))


@query
def report_round_trip(b):
    """The category block written as report JSON and read back."""
    out = _fresh(b, "report")
    sinks.write_report({"category_performance": metrics.category_performance(_enriched(b))}, out)
    return b.spark.read.schema(
        "category string, revenue double, profit double, units bigint, margin_pct double, "
        "revenue_share_pct double").json(f"{out}/category_performance")


# --- churn --------------------------------------------------------------------------

def _churn_tables(b) -> Tables:
    return Tables({"dim_customers": b.customers, "dim_products": b.products, "fact_orders": b.orders,
                   "fact_order_items": b.lines, "fact_returns": b.returns})


def _labelled(b) -> DataFrame:
    return churn.churn_labels(churn.churn_features(_churn_tables(b), OBS), b.orders, OBS)


def _scored(b) -> DataFrame:
    """Labels with recency as a given score, for the evaluation queries."""
    rows = _labelled(b)
    return rows.withColumn("p", F.col("recency_days") / 365.0).select(
        "customer_id", "churned", "monetary", F.col("p").cast("double").alias("p"))


def _split(b) -> DataFrame:
    return cut_lineage(churn.stratified_split(_labelled(b), "churned", "customer_id"))


@query
def churn_features(b):
    return churn.churn_features(_churn_tables(b), OBS)


@query
def churn_labels(b):
    return _labelled(b).select("customer_id", "churned")


@query
def stratified_split(b):
    return (churn.stratified_split(_labelled(b), "churned", "customer_id").groupBy("churned", "is_test")
            .agg(F.count(F.lit(1)).alias("n_rows")))


@query
def evaluate(b):
    return churn.evaluate(_scored(b), "churned", "p")


@query
def roc_curve(b):
    return churn.roc_curve(_scored(b), "churned", "p")


@query
def decile_lift(b):
    return churn.decile_lift(_scored(b), "churned", "p", "customer_id")


@query
def risk_tier_summary(b):
    rows = _scored(b)
    return churn.risk_tier_summary(rows.withColumn("risk_tier", churn.risk_tier(F.col("p"))))


def _selected(b, rows: DataFrame) -> churn.Selection:
    """The model chosen by cross-validation on the training rows. Choosing is dear and does
    not depend on the query, so queries of one session over one directory share it."""
    key = (b.spark.sparkContext.applicationId, b.directory)
    if key not in _SELECTIONS:
        _SELECTIONS[key] = churn.train_select(rows.where(~F.col("is_test")))
    return _SELECTIONS[key]


_SELECTIONS: dict[tuple[str, str], churn.Selection] = {}


@query
def train_select(b):
    return _selected(b, _split(b)).leaderboard_frame(b.spark)


@query
def score_base(b):
    rows = _split(b)
    return churn.score_base(_selected(b, rows).model, rows).select(
        "customer_id", "churn_probability", "risk_tier", "actual_churned")


@query
def score_checks(b):
    """What must hold for any model: everyone eligible is scored once, within [0, 1], in a tier."""
    rows = _split(b)
    scores = churn.score_base(_selected(b, rows).model, rows)
    inside = F.col("churn_probability").between(0, 1) & ~F.isnan("churn_probability")
    return scores.agg(F.count(F.lit(1)).alias("n_scored"), F.count_distinct("customer_id").alias("n_customers"),
                      F.count_if(inside).alias("n_probabilities"), F.count("risk_tier").alias("n_in_a_tier"))


@query
def worklist(b):
    rows = _split(b)
    return churn.worklist(churn.score_base(_selected(b, rows).model, rows), 50).select(
        "customer_id", "churn_probability", "risk_tier")


@query
def permutation_importance(b):
    rows = _split(b)
    return churn.permutation_importance(_selected(b, rows).model, rows.where("is_test"),
                                        [*churn.NUMERIC_FEATURES, *churn.CATEGORICAL_FEATURES])


@query
def null_order_bands(b):
    """Order amounts in fifths, where every tenth id has no amount."""
    rows = b.orders.select("order_id", F.when(F.col("order_id") % 10 != 0, F.col("total_amount")).alias("amount"))
    return (ordering.quantile_score(rows, {"band": ("amount", False)}, "order_id", 5)
            .groupBy("band").agg(F.count(F.lit(1)).alias("n_orders"), F.count("amount").alias("n_amounts")))


# --- streaming ----------------------------------------------------------------------

@query
def stream_daily_sales(b):
    """Purchases per day from the event stream, every day of it."""
    out = _fresh(b, "daily")
    bought = (_stream(b, "events").where(F.col("event_type") == "purchase")
              .withColumn("amount", F.col("value").cast("decimal(12,2)")))
    daily.stream_daily_sales(bought, f"{out}/data", f"{out}/state", "ts", "user_id", "amount").awaitTermination()
    return daily.read_daily_sales(b.spark, f"{out}/data")


@query
def stream_validate(b):
    """Lines split by the row guard and a discount rule; rows per outcome."""
    out = _fresh(b, "validate")
    stream = _stream(b, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("line_revenue"), "l_discount")
    rules = {**validate.item_rules(), "discount too high": F.col("l_discount") > 0.09}
    validate.stream_validate(stream, f"{out}/good", f"{out}/bad", f"{out}/state", rules).awaitTermination()
    good = b.spark.read.parquet(f"{out}/good").select(F.lit("accepted").alias("outcome"), "line_revenue")
    bad = b.spark.read.parquet(f"{out}/bad").select(F.col("reason").alias("outcome"), "line_revenue")
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"),
                                                        F.sum("line_revenue").alias("line_revenue"))


@query
def stream_upsert(b):
    """The newest order of every customer, kept by upserts from the order stream."""
    out = _fresh(b, "upsert")
    stream = _stream(b, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    upsert.stream_upsert(stream, f"{out}/data", f"{out}/state", "o_custkey", "o_orderkey").awaitTermination()
    return upsert.read_upserted(b.spark, f"{out}/data", "o_custkey", "o_orderkey").drop("updated_at")
