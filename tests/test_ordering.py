"""Global order operators against plain windows, on ties and hot groups."""

import random
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from conftest import rows
from tallyline.operators.ordering import (cumulative_share, even_bands, even_starts, prefix_scan,
                                          quantile_score, quantile_starts, rank_within, share_of_total,
                                          top_k, top_k_within, top_ranked)

SMALL = 120  # rows per bucket, so that the bucketed path runs


@pytest.fixture(scope="module")
def skewed(spark):
    """1,500 rows: one group holds most rows, one value holds more than a third."""
    rng = random.Random(5)
    data = [(f"id{i:05d}", rng.choice(["a", "b", "b", "b", None]),
             Decimal(rng.choice([7, 7, 7, rng.randint(0, 40)])), rng.randint(0, 9)) for i in range(1500)]
    return spark.createDataFrame(data, "id string, g string, v decimal(10,2), x long").cache()


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("frame", ["rows", "range"])
@pytest.mark.parametrize("descending", [False, True])
def test_prefix_scan_equals_plain_window(skewed, by, frame, descending):
    key = F.col("v").desc() if descending else F.col("v").asc()
    exact = Window.partitionBy(*by).orderBy(key, "id")
    if frame == "rows":
        peers = exact.rowsBetween(Window.unboundedPreceding, 0)
    else:
        peers = Window.partitionBy(*by).orderBy(key).rangeBetween(Window.unboundedPreceding, 0)
    want = skewed.select("id", F.row_number().over(exact).cast("bigint"), F.count("*").over(peers),
                         F.sum("x").over(peers))
    got = prefix_scan(skewed, "v", "id", ["x"], by, frame, descending, SMALL)
    assert rows(got, "id", "row_number", "running_count", "running_x") == rows(want)


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_prefix_scan_does_not_depend_on_partitioning(skewed, partitions):
    base = prefix_scan(skewed, "v", "id", ["x"], rows_per_bucket=SMALL)
    moved = prefix_scan(skewed.repartition(partitions), "v", "id", ["x"], rows_per_bucket=SMALL)
    assert rows(base) == rows(moved)


def test_no_bucket_gathers_the_hot_value(skewed):
    from tallyline.operators.ordering import _BUCKET, _KEY, _with_buckets
    n, buckets = skewed.count(), 12
    keyed = _with_buckets(skewed.withColumn(_KEY, F.col("v")), [], "id", n, buckets)
    largest = keyed.groupBy(_BUCKET).count().agg(F.max("count")).first()[0]
    assert largest < n / 4


def test_rank_within_hot_group(skewed):
    want = skewed.select("id", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())).cast("bigint"))
    assert rows(rank_within(skewed, ["g"], "v", "id", rows_per_bucket=SMALL), "id", "rank") == rows(want)


@given(st.integers(1, 700), st.integers(2, 10))
@settings(max_examples=200, deadline=None)
def test_band_starts_follow_the_closed_forms(n, k):
    def bands(starts):
        return [1 + sum(r >= s for s in starts) for r in range(1, n + 1)]
    if n > 1:
        assert bands(quantile_starts(n, k)) == [max(1, -(-k * (r - 1) // (n - 1))) for r in range(1, n + 1)]
    else:
        assert bands(quantile_starts(n, k)) == [1]
    assert bands(even_starts(n, k)) == [-(-k * r // n) for r in range(1, n + 1)]


@pytest.mark.parametrize("per_bucket", [SMALL, 10_000])
def test_quantile_score_ties_and_eligibility(skewed, per_bucket):
    got = {r.id: (r.S, r.T) for r in quantile_score(
        skewed, {"S": ("v", False), "T": ("x", True)}, "id", 5, F.col("x") > 2, per_bucket).collect()}
    members = [r for r in skewed.collect() if r.x > 2]
    n = len(members)
    by_v = {r.id: i for i, r in enumerate(sorted(members, key=lambda r: (r.v, r.id)), 1)}
    by_x = {r.id: i for i, r in enumerate(sorted(members, key=lambda r: (r.x, r.id)), 1)}

    def score(i):
        return max(1, -(-5 * (i - 1) // (n - 1)))
    assert len(got) == skewed.count()
    for id, (s, t) in got.items():
        assert (s, t) == ((score(by_v[id]), 6 - score(by_x[id])) if id in by_v else (0, 0))


def test_seven_tied_buyers_get_the_closed_form_not_ntile(spark):
    df = spark.createDataFrame([(f"c{i}", 1) for i in range(7)], "id string, f int")
    got = [r.F for r in quantile_score(df, {"F": ("f", False)}, "id").orderBy("id").collect()]
    assert got == [1, 1, 2, 3, 4, 5, 5]


def test_single_row_scores_one(spark):
    df = spark.createDataFrame([("a", 3)], "id string, f int")
    assert quantile_score(df, {"F": ("f", False)}, "id").first()["F"] == 1


@pytest.mark.parametrize("per_bucket", [4, 1000])
def test_fifteen_scores_in_ten_bands(spark, per_bucket):
    df = spark.createDataFrame([(i, i / 15) for i in range(15)], "id int, p double")
    got = {r.id: r.band for r in even_bands(df, "p", "id", 10, "band", rows_per_bucket=per_bucket).collect()}
    assert [got[14 - (rn - 1)] for rn in range(1, 16)] == [-(-10 * rn // 15) for rn in range(1, 16)]


@pytest.mark.parametrize("per_bucket", [2, 1000])
def test_equal_values_share_the_range_sum_but_not_the_row_sum(spark, per_bucket):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1)], "id string, v long")
    ranged = cumulative_share(df, "v", "id", "range", per_bucket)
    rowed = cumulative_share(df, "v", "id", "rows", per_bucket)
    assert rows(ranged, "id", "running_v", "grand_total", "total_rows") == [
        ("a", 5, 12, 4), ("b", 11, 12, 4), ("c", 11, 12, 4), ("d", 12, 12, 4)]
    assert rows(rowed, "id", "running_v") == [("a", 5), ("b", 8), ("c", 11), ("d", 12)]


def test_top_operators_break_ties_by_id(spark):
    df = spark.createDataFrame([("a", "x", 3), ("b", "x", 3), ("c", "y", 3), ("d", "y", 1)],
                               "id string, g string, v int")
    assert rows(top_k(df, "v", "id", 2), "id") == [("a",), ("b",)]
    assert rows(top_k_within(df, ["g"], "v", "id", 1), "id") == [("a",), ("c",)]
    assert rows(top_ranked(df, "v", 1), "id") == [("a",), ("b",), ("c",)]


@pytest.mark.parametrize("group_rows", [True, False])
def test_share_of_total(spark, group_rows):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "id string, v int")
    got = share_of_total(df, "v", "pct", group_rows=group_rows)
    assert [(r.id, float(r.pct)) for r in got.orderBy("id").collect()] == [("a", 25.0), ("b", 75.0)]


def test_split_points_quote_odd_ids(spark):
    odd = ["it's", "back\\slash", "tab\t", "", "quote\"", "ünï", "a,b", "{x}"] * 20
    df = spark.createDataFrame([(f"{t}{i}", i % 3) for i, t in enumerate(odd)], "id string, v long")
    want = df.select("id", F.row_number().over(Window.orderBy("v", "id")).cast("bigint"))
    assert rows(prefix_scan(df, "v", "id", rows_per_bucket=10), "id", "row_number") == rows(want)


@pytest.mark.parametrize("kind", ["double", "date", "timestamp", "int"])
def test_order_column_types(spark, kind):
    base = spark.range(300).withColumn("n", (F.col("id") * 37 % 101) - 50)
    made = {"double": F.col("n") / 7, "int": F.col("n").cast("int"), "date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("n").cast("int")),
            "timestamp": F.timestamp_micros(F.col("n") * 1_234_567)}[kind]
    df = base.select("id", made.alias("v"))
    want = df.select("id", F.row_number().over(Window.orderBy("v", "id")).cast("bigint"))
    assert rows(prefix_scan(df, "v", "id", rows_per_bucket=20), "id", "row_number") == rows(want)


def test_empty_input(spark):
    df = spark.createDataFrame([], "id string, v long")
    assert prefix_scan(df, "v", "id", ["v"]).count() == 0
    assert quantile_score(df, {"S": ("v", False)}, "id").count() == 0


@pytest.mark.parametrize("per_bucket", [SMALL, 10_000])
def test_null_order_values_fill_the_first_bands(spark, per_bucket):
    df = spark.range(2000).select("id", F.when(F.col("id") % 4 != 0, F.col("id")).alias("v"))
    got = quantile_score(df, {"s": ("v", False)}, "id", 5, rows_per_bucket=per_bucket)
    assert rows(got.groupBy("s").agg(F.count("*"), F.count("v"))) == [
        (1, 400, 0), (2, 400, 300), (3, 400, 400), (4, 400, 400), (5, 400, 400)]
