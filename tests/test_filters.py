from pyspark.sql import functions as F

from conftest import d, rows
from tallyline.operators import filters


def ids(df, column="order_id"):
    return sorted(r[0] for r in df.select(column).collect())


def test_status_filters(shop):
    orders = shop["fact_orders"]
    assert ids(filters.revenue_orders(orders)) == ["o1", "o2"]
    assert ids(filters.where_status(orders, status_not_in=["Cancelled"])) == ["o1", "o2", "o3", "o5", "o6"]
    assert ids(filters.where_status(orders)) == ["o1", "o2", "o3", "o4", "o5", "o6"]


def test_null_status_passes_no_filter(spark):
    df = spark.createDataFrame([("a", None)], "order_id string, order_status string")
    assert ids(filters.where_status(df, status_not_in=["Cancelled"])) == []


def test_point_in_time_bounds(spark):
    orders = spark.createDataFrame([("a", d("2024-06-30")), ("b", d("2024-07-01")), ("c", d("2024-12-30")),
                                    ("e", d("2024-12-31"))], "order_id string, order_date date")
    split = {r.order_id: r.side for r in filters.pit_split(orders, "2024-06-30", 183).collect()}
    assert split == {"a": "history", "b": "future", "c": "future"}
    assert ids(filters.history(orders, "2024-06-30")) == ["a"]
    assert ids(filters.future(orders, "2024-06-30", 183)) == ["b", "c"]


def test_eligibility_subsets(shop):
    got = dict(filters.eligibility(shop["fact_orders"], shop["fact_order_items"]).collect())
    assert got == {"payable": 5, "shippable": 1, "returnable": 1}


def test_existence_joins_and_sets(spark, shop):
    items, orders = shop["fact_order_items"], shop["fact_orders"]
    assert ids(filters.semi(items, filters.revenue_orders(orders), "order_id"), "order_item_id") == ["i1", "i2", "i3"]
    broken = items.select("order_item_id", F.when(F.col("order_item_id") == "i2", "missing")
                          .when(F.col("order_item_id") == "i3", None).otherwise(F.col("order_id")).alias("order_id"))
    assert ids(filters.orphans(broken, "order_id", orders, "order_id"), "order_item_id") == ["i2", "i3"]
    assert ids(filters.keys_missing(orders, items, "order_id")) == ["o6"]


def test_bad_rows_and_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", -2), ("b", None), (None, 0), (None, 3)], "k string, v int")
    bad = filters.invalid_values(df, {"negative": F.col("v") < 0, "zero": F.col("v") == 0})
    assert rows(bad, "k", "reason") == [("a", "negative"), (None, "zero")]
    assert rows(filters.duplicate_keys(df, ["k"])) == [("a", 2), (None, 2)]
    assert rows(filters.future_dated(df.select(F.lit(d("2024-01-02")).alias("t")), "t", "2024-01-02")) == []


def test_populated_ignores_markers_in_any_case(spark):
    df = spark.createDataFrame([("ONLINE",), ("online",), ("",), (None,), ("n/a",), ("s1",)], "fk string")
    assert rows(filters.populated(df, "fk")) == [("s1",)]
