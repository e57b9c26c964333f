"""Baskets, dense keys, sketches, scenarios, customer value, checked loads, the as-of sweep."""

import itertools
import random
from collections import Counter
from datetime import timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import d, m, rows
from tallyline.operators import baskets, clv, dimensions, scenarios, sketches
from tallyline.sources import readers, sinks


# --- baskets ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def bought(spark):
    rng = random.Random(3)
    data = [(o, p) for o in range(60) for p in rng.choices("abcdefgh", k=rng.randint(1, 5))]
    data += [(100, f"p{i:02d}") for i in range(30)] + [(101, f"p{i:02d}") for i in range(0, 30, 2)]   # large baskets
    data += [(None, "a"), (5, None), (200, "rare")]
    return data, spark.createDataFrame(data, "order_id int, product_id string").repartition(4)


def brute_sets(data, least, longest):
    held = {}
    for o, p in data:
        if o is not None and p is not None:
            held.setdefault(o, set()).add(p)
    counts = Counter(s for items in held.values() for n in range(1, longest + 1) for s in itertools.combinations(sorted(items), n))
    return {s: n for s, n in counts.items() if n >= least}, len(held)


@pytest.mark.parametrize("max_items", [3, 1000])
def test_pairs_equal_brute_force_for_small_and_large_baskets(bought, max_items):
    data, df = bought
    want, n = brute_sets(data, 2, 2)
    got = {(r.first, r.second): r for r in baskets.frequent_pairs(df, max_items=max_items).collect()}
    assert {k: r.n_orders for k, r in got.items()} == {s: c for s, c in want.items() if len(s) == 2}
    a, b = ("a", "b")
    r = got[a, b]
    assert r.confidence == r.n_orders / want[(a,)] and r.lift == pytest.approx(r.n_orders * n / (want[(a,)] * want[(b,)]))


def test_tasks_that_form_pairs_follow_the_pairs(bought, monkeypatch):
    data, df = bought
    monkeypatch.setattr(baskets, "PAIRS_PER_TASK", 40, raising=False)
    pairs = baskets.frequent_pairs(df, max_items=3)
    lines = pairs._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dealt = [int(line.split("],")[-1].split(",")[0].strip(" )")) for line in lines if "RepartitionByExpression" in line]
    assert len(dealt) == 3 and min(dealt) > 1
    want, _ = brute_sets(data, 2, 2)
    assert {(r.first, r.second): r.n_orders for r in pairs.collect()} == {s: c for s, c in want.items() if len(s) == 2}


def test_sets_and_rules_equal_brute_force(bought):
    data, df = bought
    small = [(o, p) for o, p in data if o is None or o < 100]
    frame = df.where("order_id < 100 or order_id is null")
    want, n = brute_sets(small, 4, 8)
    sets = baskets.frequent_sets(frame, min_orders=4)
    assert {tuple(r["items"]): r.n_orders for r in sets.collect()} == want
    rules = {(tuple(r.antecedent), r.consequent): r for r in baskets.rules(sets, n, 0.3).collect()}
    expected = {(tuple(x for x in s if x != c), c) for s, k in want.items() if len(s) > 1 for c in s
                if k >= want[tuple(x for x in s if x != c)] * 0.3}
    assert set(rules) == expected and expected
    for (before, c), r in rules.items():
        whole = want[tuple(sorted((*before, c)))]
        assert r.confidence == whole / want[before] and r.lift == pytest.approx(float(Fraction(whole * n, want[before] * want[(c,)])))


def test_oversized_baskets_are_refused_not_cut(bought):
    with pytest.raises(ValueError, match="a basket of 15 products"):
        baskets.frequent_sets(bought[1], max_items=10)
    empty = baskets.frequent_sets(bought[1].limit(0))
    assert empty.count() == 0 and baskets.frequent_pairs(bought[1].limit(0)).count() == 0


# --- dimensions ---------------------------------------------------------------------

def history(rng, keys):
    versions = []
    for k in keys:
        days = sorted(rng.sample(range(0, 400), rng.randint(1, 6)))
        for i, day in enumerate(days):
            start = d("2024-01-01") + timedelta(days=day)
            end = d("2024-01-01") + timedelta(days=days[i + 1]) if i + 1 < len(days) else None
            if end and rng.random() < 0.2:
                end = start + timedelta(days=(end - start).days // 2)        # a gap, sometimes no day at all
            versions.append((k, f"s{rng.randint(0, 9)}", start, end, end is None))
    return versions


def test_sweep_equals_the_range_join(spark):
    rng = random.Random(12)
    versions = history(rng, ["a", "b", "c", "hot"]) + [(None, "none", d("2024-01-01"), None, True)]
    facts = [(i, rng.choice(["a", "b", "c", "x", None]), d("2024-01-01") + timedelta(days=rng.randint(-20, 450))) for i in range(300)]
    facts += [(i, "hot", d("2024-01-01") + timedelta(days=rng.randint(-20, 450))) for i in range(300, 2300)]
    facts += [(5000 + i, "hot", d("2024-06-01")) for i in range(700)] + [(9000, "a", None), (9001, None, None)]
    dim = spark.createDataFrame(versions, "k string, seg string, effective_date date, expiry_date date, is_current boolean")
    fact = spark.createDataFrame(facts, "id int, k string, day date").repartition(6)
    got = dimensions.scd2_asof(fact, dim, "k", "day", ["seg"])
    assert got.columns == ["id", "k", "day", "seg"]

    def valid(k, day):
        hits = [s for key, s, start, end, _ in versions if k is not None and key == k and day is not None and start <= day and (end is None or day < end)]
        return hits[0] if hits else None
    assert rows(got) == sorted(((i, k, day, valid(k, day)) for i, k, day in facts), key=repr)


def test_sweep_has_no_range_condition_and_splits_a_hot_key(spark):
    dim = spark.createDataFrame([("hot", "x", d("2024-01-01"), None, True)], "k string, seg string, effective_date date, expiry_date date, is_current boolean")
    fact = spark.range(4000).select(F.col("id"), F.lit("hot").alias("k"), F.date_add(F.lit(d("2024-01-01")), (F.col("id") % 300).cast("int")).alias("day"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = dimensions.scd2_asof(fact, dim, "k", "day", ["seg"])
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert joins and all("<=" not in line and ">=" not in line for line in joins)
        assert got.where("seg = 'x'").count() == 4000
        leaf = got._jdf.queryExecution().analyzed().collectLeaves().head()
        assert leaf.rdd().getNumPartitions() == 4          # the one key lies in all of the ranges
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_dense_keys_stay_and_continue(spark, tmp_path):
    first = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string")
    second = spark.createDataFrame([("0",), ("b",), ("z",)], "k string")
    for _ in range(2):                                        # a repeated load gives the same
        assert rows(dimensions.store_key_map(spark, f"{tmp_path}/m", first, "k", load=0)) == [("a", 1), ("b", 2)]
    grown = dimensions.store_key_map(spark, f"{tmp_path}/m", second, "k", load=1)
    assert rows(grown) == [("0", 3), ("a", 1), ("b", 2), ("z", 4)]
    assert rows(dimensions.extend_key_map(dimensions.extend_key_map(None, first, "k"), second, "k")) == rows(grown)
    assert rows(dimensions.with_dense_key(first, grown, "k")) == [("a", 1), ("b", 2), ("b", 2), (None, None)]
    assert rows(dimensions.store_key_map(spark, f"{tmp_path}/m", first.limit(0), "k", load=2)) == rows(grown)


# --- sketches and scenarios ---------------------------------------------------------

def test_sketches_merge_over_days(spark):
    visits = spark.range(60_000).select((F.col("id") % 7000).cast("string").alias("user"),
                                        F.date_add(F.lit(d("2024-01-01")), (F.col("id") % 91).cast("int")).alias("ts"))
    days = sketches.daily_sketches(visits.unionByName(visits.limit(5).withColumn("user", F.lit(None).cast("string"))), "ts", "user")
    bound = sketches.relative_error()
    for unit, n in (("month", 3), ("quarter", 1), ("year", 1)):
        got = sketches.estimates(sketches.roll_up(days, unit), "users")
        exact = dict(rows(visits.groupBy(F.trunc("ts", unit).alias("p")).agg(F.count_distinct("user"))))
        found = dict(rows(got, "period", "users"))
        assert set(found) == set(exact) and len(found) == n
        assert all(abs(found[p] - exact[p]) <= bound * exact[p] for p in exact)
    twice = sketches.roll_up(sketches.roll_up(days, "month").withColumnRenamed("period", "day"), "year")
    assert rows(sketches.estimates(twice)) == rows(sketches.estimates(sketches.roll_up(days, "year")))


def test_anomalies_leave_the_month_out_of_its_baseline(spark):
    data = [("a", i, v) for i, v in enumerate([10, 12, 11, 13, 40, 12])] + [("flat", i, v) for i, v in enumerate([5, 5, 5, 5, 6])]
    data += [("hole", i, v) for i, v in enumerate([1, None, 2, 3, 9])]
    df = spark.createDataFrame([(k, i, None if v is None else m(v)) for k, i, v in data], "k string, t int, v decimal(12,2)")
    got = {(r.k, r.t): r for r in scenarios.anomaly_flags(df, "v", "t", 3, ["k"]).collect()}
    assert all(got["a", t].is_anomaly is None and got["a", t].baseline is None for t in range(3))
    assert not got["a", 3].is_anomaly and got["a", 3].baseline == 11.0 and got["a", 3].deviation == 2.0
    assert got["a", 4].is_anomaly and got["a", 4].deviation == 28.0 and not got["a", 5].is_anomaly
    assert got["flat", 3].is_anomaly is False and got["flat", 4].is_anomaly and got["flat", 4].deviation is None
    assert all(got["hole", t].is_anomaly is None for t in range(5))


def channels(spark, data):
    return spark.createDataFrame([(c, None if s is None else m(s), None if r is None else m(r)) for c, s, r in data],
                                 "channel string, spend decimal(20,2), revenue decimal(20,2)")


@pytest.mark.parametrize("seed", range(4))
def test_budgets_add_up_and_keep_the_limits(spark, seed):
    rng = random.Random(seed)
    data = [(f"c{i}", rng.randint(1, 10**rng.randint(2, 7)) / 100, rng.randint(0, 10**7) / 100) for i in range(9)]
    got = scenarios.reallocate_budget(channels(spark, data), 20, 50).collect()
    assert len(got) == 9 and sum(r.new_spend for r in got) == sum(r.spend for r in got)
    assert sum(r.taken for r in got) == sum(r.given for r in got)
    common = sum(m(r) for _, _, r in data) / sum(m(s) for _, s, _ in data)
    returns = {c: m(r) / m(s) for c, s, r in data}
    for r in got:
        assert 0 <= r.given <= r.spend / 2 and 0 <= r.taken <= r.spend / 5
        assert r.given == 0 or returns[r.channel] > common
    # channels with room left got alike per return, up to a cent
    level = [r.given / returns[r.channel] for r in got if returns[r.channel] > common and r.given + m("0.01") < r.spend / 2]
    if len(level) > 1:
        assert max(level) - min(level) <= m("0.02") / min(returns[c] for c in returns if returns[c] > common) + max(level) * m("0.0001")


def test_budget_edges(spark):
    one = scenarios.reallocate_budget(channels(spark, [("a", "10", "20"), (None, "5", "5"), ("b", "0", "9"), ("c", None, "1")])).collect()
    assert [(r.channel, r.spend, r.new_spend, r.given) for r in one] == [("a", m("10.00"), m("10.00"), m("0.00"))]
    two = {r.channel: r for r in scenarios.reallocate_budget(channels(spark, [("a", "100", "50"), ("b", "10", "90")])).collect()}
    assert two["b"].given == m("5.00") and two["a"].new_spend + two["b"].new_spend == m("110.00")
    assert scenarios.reallocate_budget(channels(spark, [("a", "1", "1")]).limit(0)).count() == 0


def test_value_models_beat_the_segment_mean(spark):
    def sample(seed):
        h = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000)) / 1000
        seg = F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, "y")
        slope = F.when(F.col("id") % 3 == 0, 100.0).when(F.col("id") % 3 == 1, -40.0).otherwise(7.0)
        return spark.range(900).select(
            F.col("id").alias("customer_id"), seg.alias("customer_segment"), (h * 10).alias("recency_days"), (F.col("id") % 5).cast("double").alias("frequency"),
            F.lit(None).cast("double").alias("monetary"), F.lit(3.0).alias("avg_order_value"), F.lit(1.0).alias("tenure_days"),
            (500 + slope * h * 10 + F.col("id") % 5).alias("spend_ahead"))
    got = {r.customer_segment: r for r in clv.clv_errors(sample(1), sample(2)).collect()}
    assert set(got) == {"x", "y", None}
    assert all(r.model_error < 0.1 * r.mean_error and (r.n_train, r.n_test) == (300, 300) for r in got.values())
    odd = clv.predict_clv(clv.fit_clv(sample(1)), sample(2).withColumn("customer_segment", F.lit("new")))
    assert odd.where("predicted = 0").count() == 900


# --- checked loads ------------------------------------------------------------------

def test_bad_rows_go_to_quarantine_and_all_rows_are_accounted_for(spark, tmp_path):
    folder = tmp_path / "in" / "dim_stores.csv.gz"
    folder.mkdir(parents=True)
    names = [f.name for f in readers.file_schema_of("dim_stores").fields]
    kinds = [f.dataType.simpleString() for f in readers.file_schema_of("dim_stores").fields]
    odd = next(i for i, k in enumerate(kinds) if k != "string")
    plain = ["2024-01-01" if k == "date" else "true" if k == "boolean" else "s" if k == "string" else "1" for k in kinds]

    def line(values):
        return ",".join(values)
    bad = plain[:odd] + ["no such value"] + plain[odd + 1:]
    (folder / "part-0.csv").write_text("\n".join([line(names), line(plain), line(bad), line(plain[:2])]) + "\n")
    (folder / "part-1.csv").write_text("\n".join([line(names), line(plain), line([*plain, "more"])]) + "\n")
    got = sinks.land_checked(spark, str(tmp_path / "in"), ["dim_stores"], str(tmp_path / "out")).collect()
    assert [tuple(r) for r in got] == [("dim_stores", 5, 2, 3, True)]
    kept = spark.read.parquet(f"{tmp_path}/out/_quarantine/dim_stores")
    assert rows(kept) == sorted([(line(bad),), (line(plain[:2]),), (line([*plain, "more"]),)], key=repr)
    assert spark.read.parquet(f"{tmp_path}/out/dim_stores").count() == 2
