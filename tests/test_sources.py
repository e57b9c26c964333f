import warnings

import pytest
from pyspark.sql import functions as F

from conftest import d, m, rows
from tallyline.operators import dimensions
from tallyline.session import cut_lineage, shared_dir
from tallyline.sources import readers, sinks
from tallyline.sources.readers import Tables
from tallyline.sources.schemas import DDL, FILE_HEADERS, file_schema_of, schema_of


def test_eighteen_declared_tables():
    assert len(DDL) == 18
    assert file_schema_of("fact_weather").names[0] == "date" and schema_of("fact_weather").names[0] == "weather_date"


def _as(df, name):
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema_of(name).fields])


def test_gzip_csv_round_trip_with_header_drift(spark, shop, tmp_path):
    traffic = spark.createDataFrame([(d("2024-01-01"), "FR", 10)], "traffic_date date, country string, visitors int")
    raw = _as(traffic, "fact_website_traffic").withColumnsRenamed(
        {v: k for k, v in FILE_HEADERS["fact_website_traffic"].items()})
    sinks.write_table(raw, f"{tmp_path}/fact_website_traffic.csv.gz", "csv")
    sinks.write_table(_as(shop["fact_orders"], "fact_orders"), f"{tmp_path}/fact_orders.csv.gz", "csv")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        tables = readers.load_tables(spark, str(tmp_path))
    assert len([w for w in seen if "not found" in str(w.message)]) == 16
    assert set(tables) == {"fact_orders", "fact_website_traffic"}
    assert rows(tables["fact_website_traffic"], "traffic_date", "visitors") == [(d("2024-01-01"), 10)]
    assert tables["fact_orders"].schema == schema_of("fact_orders")
    assert rows(tables["fact_orders"], "order_id", "order_date", "total_amount") == rows(
        shop["fact_orders"], "order_id", "order_date", "total_amount")
    meta = readers.run_meta(tables)
    assert tuple(meta.drop("generated_at").first()) == (2, 7, tmp_path.name) and meta.first().generated_at is not None


def test_wrong_header_is_reported(spark, shop, tmp_path):
    renamed = _as(shop["fact_orders"], "fact_orders").withColumnRenamed("channel", "kanal")
    sinks.write_table(renamed, f"{tmp_path}/fact_orders.csv.gz", "csv")
    with pytest.raises(Exception, match="kanal|header"):
        readers.read_table(spark, str(tmp_path), "fact_orders").collect()


def test_land_then_read_parquet(spark, shop, tmp_path):
    counts = dict(sinks.land(Tables(shop), str(tmp_path)).collect())
    assert counts["fact_orders"] == 6 and len(counts) == len(shop)
    again = readers.load_tables(spark, str(tmp_path), "parquet", names=tuple(shop))
    assert rows(again["fact_order_items"]) == rows(shop["fact_order_items"])
    with pytest.raises(ValueError):
        readers.read_table(spark, str(tmp_path), "fact_orders", "orc")


def test_year_partitions_prune_and_keep_strays(spark, tmp_path):
    df = spark.createDataFrame([(1, d("2020-05-01")), (2, d("2021-05-01")), (3, d("2022-05-01")), (4, None)], "id int, order_date date")
    sinks.write_partitioned(df, str(tmp_path), "order_date", 2021, 2025, sort_by="id")
    stored = spark.read.parquet(str(tmp_path))
    assert rows(stored.select("id", F.col("order_year").cast("string"))) == [
        (1, "default"), (2, "2021"), (3, "2022"), (4, "default")]
    plan = stored.where("order_year = '2021' and order_date >= date'2021-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan


def test_statistics(spark, shop):
    shop["dim_stores"].write.mode("overwrite").saveAsTable("stores_for_statistics")
    sinks.analyze(spark, "stores_for_statistics")
    detail = spark.sql("DESCRIBE EXTENDED stores_for_statistics").where("col_name = 'Statistics'").first()
    assert "3 rows" in detail.data_type
    spark.sql("DROP TABLE stores_for_statistics")


def test_shared_dir_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert cut_lineage(spark.range(3)).count() == 3


def test_surrogate_keys_are_stable(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    one = rows(dimensions.with_surrogate_key(df, "k"))
    assert one == rows(dimensions.with_surrogate_key(df.repartition(5), ["k"])) and len({r[2] for r in one}) == 2


def test_scd2_history_and_lookup(spark):
    schema = "k string, seg string, note string"
    dim = dimensions.scd2_open(spark.createDataFrame([("a", "x", "n"), ("b", "y", "n"), ("c", None, "n")], schema), "2020-01-01")
    updates = spark.createDataFrame([("a", "x", "changed note"), ("b", "z", "n"), ("c", None, "n"), ("e", "new", "n")], schema)
    v2 = dimensions.scd2_apply(dim, updates, "k", ["seg"], "2021-01-01")
    assert rows(v2, "k", "seg", "effective_date", "expiry_date", "is_current") == [
        ("a", "x", d("2020-01-01"), None, True), ("b", "y", d("2020-01-01"), d("2021-01-01"), False),
        ("b", "z", d("2021-01-01"), None, True), ("c", None, d("2020-01-01"), None, True),
        ("e", "new", d("2021-01-01"), None, True)]
    v3 = dimensions.scd2_apply(v2, spark.createDataFrame([("b", "y", "n")], schema), "k", ["seg"], "2022-01-01")
    assert v3.where("k = 'b'").count() == 3 and v3.where("k = 'b' and is_current").first().seg == "y"
    facts = spark.createDataFrame([(1, "b", d("2020-06-01")), (2, "b", d("2021-01-01")), (3, "b", d("2023-01-01")),
                                   (4, "b", d("2019-01-01")), (5, "q", d("2020-01-01"))], "id int, k string, day date")
    assert rows(dimensions.scd2_asof(facts, v3, "k", "day", ["seg"]), "id", "seg") == [
        (1, "y"), (2, "z"), (3, "y"), (4, None), (5, None)]
