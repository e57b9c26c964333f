import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def d(text):
    return date.fromisoformat(text)


def m(value):
    return Decimal(str(value))


def rows(df, *columns):
    """Rows as sorted tuples, of the named columns if given."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture(scope="session")
def shop(spark):
    """Six orders of four customers: one per status, one without lines; a silent customer."""
    customers = spark.createDataFrame([
        ("c1", "Ada", "Li", "FR", "Web", "Gold", 30, True, d("2023-01-05")),
        ("c2", "Bo", "Ek", "DE", "Shop", "New", 45, False, d("2023-02-10")),
        ("c3", "Cy", None, "FR", "Web", "Gold", 17, True, d("2023-02-20")),
        ("c4", "Di", "Oz", None, "Web", "New", 60, False, d("2023-03-01")),
    ], "customer_id string, first_name string, last_name string, country string, acquisition_channel string, "
       "customer_segment string, age int, is_loyalty_member boolean, signup_date date")
    products = spark.createDataFrame([
        ("p1", "Pen", "Office", "b1", m("10.00"), m("4.00")),
        ("p2", "Cup", "Home", "b2", m("20.00"), m("12.50")),
        ("p3", "Mat", "Home", "b2", m("5.00"), m("6.00")),
    ], "product_id string, product_name string, category string, brand string, "
       "unit_price decimal(10,2), unit_cost decimal(10,2)")
    orders = spark.createDataFrame([
        ("o1", "c1", "s1", d("2023-03-01"), "In-Store", "Completed", m("30.00")),
        ("o2", "c1", "ONLINE", d("2023-04-15"), "Online", "Shipped", m("20.00")),
        ("o3", "c2", "s1", d("2023-04-20"), "In-Store", "Processing", m("10.00")),
        ("o4", "c2", "ONLINE", d("2023-05-02"), "Online", "Cancelled", m("40.00")),
        ("o5", "c3", "s2", d("2023-05-09"), "In-Store", "Returned", m("5.00")),
        ("o6", "c3", "ONLINE", d("2023-06-30"), "Online", "Refunded", m("0.00")),
    ], "order_id string, customer_id string, store_id string, order_date date, channel string, "
       "order_status string, total_amount decimal(12,2)")
    lines = [("i1", "o1", "2023-03-01", "p1", 1, "10.00", "4.00"), ("i2", "o1", "2023-03-01", "p2", 1, "20.00", "12.50"),
             ("i3", "o2", "2023-04-15", "p2", 1, "20.00", "12.50"), ("i4", "o3", "2023-04-20", "p1", 1, "10.00", "4.00"),
             ("i5", "o4", "2023-05-02", "p2", 2, "40.00", "25.00"), ("i6", "o5", "2023-05-09", "p3", 1, "5.00", "6.00")]
    items = spark.createDataFrame(
        [(i, o, d(day), p, q, m(r), m(c), m(r) - m(c)) for i, o, day, p, q, r, c in lines],
        "order_item_id string, order_id string, order_date date, product_id string, quantity int, "
        "line_revenue decimal(12,2), line_cost decimal(12,2), line_profit decimal(12,2)")
    stores = spark.createDataFrame([("s1", "North", "FR", "Lyon"), ("s2", "South", "FR", "Nice"),
                                    ("s3", "Empty", "DE", "Bonn")],
                                   "store_id string, store_name string, country string, city string")
    reviews = spark.createDataFrame([("r1", "p2", 5), ("r2", "p2", 2), ("r3", "p2", 4)],
                                    "review_id string, product_id string, rating int")
    returns = spark.createDataFrame([("t1", "o5", "i6", d("2023-05-20"), "Broken", m("5.00"), True),
                                     ("t2", "o5", "i6", d("2023-05-21"), None, m("1.00"), False)],
                                    "return_id string, order_id string, order_item_id string, return_date date, "
                                    "return_reason string, refund_amount decimal(12,2), restocked boolean")
    return {"dim_customers": customers, "dim_products": products, "dim_stores": stores, "fact_orders": orders,
            "fact_order_items": items, "fact_reviews": reviews, "fact_returns": returns}
