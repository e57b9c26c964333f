import pytest
from pyspark.sql import functions as F

from conftest import m, rows
from tallyline.operators import quality


def checks(report):
    return {r["check"]: (r.records_scanned, r.records_failed, r.passed) for r in report.collect()}


def test_full_gate_has_all_families(shop):
    report = quality.quality_report(shop)
    families = {r.family: r["count"] for r in report.groupBy("family").count().collect()}
    assert families == {"completeness": 15, "uniqueness": 5, "referential_integrity": 6, "validity": 5, "consistency": 1}
    got = checks(report)
    assert got["dim_customers.country not null"] == (4, 1, False)
    assert got["dim_customers.age in [18,100]"] == (4, 1, False)
    assert got["dim_products price > cost"] == (3, 1, False)
    assert got["every order has >=1 line item"] == (6, 1, False)
    assert got["fact_orders.store_id -> dim_stores.store_id"] == (3, 0, True)
    score = quality.quality_score(report).first()
    # (25 + 25 + 33.3333 + 16.6667) / 32 off 100
    assert (score.score, score.checks_total, score.checks_passed, score.checks_failed) == (96.88, 32, 28, 4)


def test_clean_tables_score_hundred(shop):
    clean = {"dim_stores": shop["dim_stores"]}
    assert quality.quality_score(quality.quality_report(clean)).first().score == 100.0
    assert quality.require_quality(quality.quality_report(clean), 95) == 100.0
    with pytest.raises(ValueError):
        quality.require_quality(quality.quality_report(shop), 99)


def test_integrity_ignores_null_and_markers(spark):
    child = spark.createDataFrame([(x,) for x in (None, "ONLINE", "online", "", "s1", "s1", "zz")], "fk string")
    parent = spark.createDataFrame([("s1",), ("s2",)], "pk string")
    assert tuple(quality.referential_integrity(child, "fk", parent, "pk").first()) == (3, 1)
    assert tuple(quality.referential_integrity(child.where("false"), "fk", parent, "pk").first()) == (0, 0)


def test_integrity_across_key_types(spark):
    child = spark.createDataFrame([(1,), (2,), (2,)], "fk bigint")
    parent = spark.createDataFrame([("1",)], "pk string")
    assert tuple(quality.referential_integrity(child, "fk", parent, "pk").first()) == (3, 2)


def test_duplicates_count_null_as_one_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert tuple(quality.duplicate_count(df, "k").first()) == (5, 2)


def test_absent_column_is_skipped_and_null_never_fails(spark):
    df = spark.createDataFrame([("o1", None)], "order_id string, total_amount decimal(12,2)")
    got = checks(quality.quality_report({"fact_orders": df}))
    assert got["fact_orders.total_amount >= 0"] == (1, 0, True)
    assert "fact_orders.customer_id not null" not in got


def test_outliers_and_null_audit(spark):
    df = spark.createDataFrame([(i, m(10 if i else 1000)) for i in range(30)], "id int, v decimal(12,2)")
    assert rows(quality.amount_outliers(df, "v"), "id") == [(0,)]
    nulls = df.select("id", F.when(F.col("id") > 26, F.col("v")).alias("v"))
    assert tuple(quality.null_audit(nulls, ["id", "v"]).first()) == (0, 27)
