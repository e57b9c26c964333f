import pytest
from pyspark.sql import functions as F

from conftest import d, m, rows
from tallyline.operators import churn
from tallyline.sources.sinks import load_model, save_model

OBS = "2024-06-30"


def test_features_look_back_only(spark, shop):
    orders = spark.createDataFrame([
        ("o1", "c1", d("2024-01-01"), "Completed", m("10")), ("o2", "c1", d("2024-06-30"), "Shipped", m("20")),
        ("o3", "c1", d("2024-07-01"), "Completed", m("99")), ("o4", "c2", d("2023-07-01"), "Completed", m("5")),
        ("o5", "c3", d("2023-06-30"), "Completed", m("5")), ("o6", "c4", d("2024-05-01"), "Cancelled", m("5"))],
        "order_id string, customer_id string, order_date date, order_status string, total_amount decimal(12,2)")
    lines = spark.createDataFrame([("o1", "p1"), ("o1", "p2"), ("o2", "p3"), ("o3", "p1")], "order_id string, product_id string")
    returned = spark.createDataFrame([("t1", "o1", d("2024-02-01")), ("t2", "o1", d("2024-08-01"))],
                                     "return_id string, order_id string, return_date date")
    tables = {**shop, "fact_orders": orders, "fact_order_items": lines, "fact_returns": returned}
    feats = churn.churn_features(tables, OBS)
    assert feats.columns == ["customer_id", *churn.NUMERIC_FEATURES, *churn.CATEGORICAL_FEATURES]
    got = {r.customer_id: r for r in feats.collect()}
    assert set(got) == {"c1", "c2"}  # c3 is 366 days back, c4 only cancelled
    c1 = got["c1"]
    assert (c1.recency_days, c1.frequency, c1.monetary, c1.avg_order_value, c1.tenure_days) == (0, 2, m("30.00"), 15.0, 181)
    assert (c1.distinct_categories, c1.n_returns, c1.is_loyalty_member) == (2, 1, "true")
    assert (got["c2"].recency_days, got["c2"].distinct_categories, got["c2"].n_returns) == (365, 0, 0)
    labels = {r.customer_id: r.churned for r in churn.churn_labels(feats, orders, OBS).collect()}
    assert labels == {"c1": 0, "c2": 1}


@pytest.mark.parametrize("offset,churned", [(1, 0), (183, 0), (184, 1), (0, 1)])
def test_label_window(spark, offset, churned):
    feats = spark.createDataFrame([("a",)], "customer_id string")
    orders = spark.createDataFrame([("a", "Completed")], "customer_id string, order_status string").withColumn(
        "order_date", F.date_add(F.lit(d(OBS)), offset))
    assert churn.churn_labels(feats, orders, OBS).first().churned == churned


@pytest.fixture(scope="module")
def planted(spark):
    """2,000 customers whose churn follows their recency, with some noise."""
    h = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    rows_ = spark.range(2000).select(
        F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("customer_id"),
        F.floor(h * 365).cast("int").alias("recency_days"), (F.col("id") % 9 + 1).alias("frequency"),
        (F.col("id") % 500).cast("decimal(12,2)").alias("monetary"), (F.col("id") % 70).cast("double").alias("avg_order_value"),
        F.lit(400).alias("tenure_days"), (F.col("id") % 4).alias("distinct_categories"), F.lit(0).alias("n_returns"),
        (F.col("id") % 50 + 20).alias("age"), F.concat(F.lit("n"), F.col("id") % 5).alias("country"),
        F.lit("Web").alias("acquisition_channel"), F.concat(F.lit("s"), F.col("id") % 3).alias("customer_segment"),
        (F.col("id") % 2 == 0).cast("string").alias("is_loyalty_member"),
        (h + F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1000)) / 1000 * 0.6 > 0.8).cast("int").alias("churned"))
    return churn.stratified_split(rows_, "churned", "customer_id").cache()


@pytest.fixture(scope="module")
def chosen(planted):
    return churn.train_select(planted.where(~F.col("is_test")), rounds=3)


def test_split_is_stratified_and_stable(planted):
    rates = {(r.is_test, r.fold): r.avg for r in planted.groupBy("is_test", "fold").agg(F.avg("churned").alias("avg")).collect()}
    overall = planted.agg(F.avg("churned")).first()[0]
    assert len(rates) == 10 and all(abs(v - overall) < 0.01 for v in rates.values())
    again = churn.stratified_split(planted.drop("is_test", "fold").repartition(13), "churned", "customer_id", rows_per_bucket=150)
    assert rows(again, "customer_id", "is_test", "fold") == rows(planted, "customer_id", "is_test", "fold")


def test_model_beats_a_coin_flip(chosen, planted, tmp_path):
    assert chosen.name in ("Logistic Regression", "Gradient Boosting") and len(chosen.leaderboard) == 2
    test = churn.with_probability(chosen.model, planted.where("is_test")).cache()
    q = churn.evaluate(test, "churned", "p").first()
    assert q.roc_auc > 0.8 and q.tn + q.fp + q.fn + q.tp == test.count()
    lift = [r.lift for r in churn.decile_lift(test, "churned", "p", "customer_id").orderBy("decile").collect()]
    assert lift[0] > lift[-1]
    imp = {r.feature: r.importance for r in churn.permutation_importance(
        chosen.model, planted.where("is_test"), [*churn.NUMERIC_FEATURES, *churn.CATEGORICAL_FEATURES], repeats=2).collect()}
    assert len(imp) == 12 and max(imp, key=imp.get) == "recency_days" and imp["tenure_days"] == 0
    scores = churn.score_base(chosen.model, planted)
    assert scores.where("churn_probability not between 0 and 1 or risk_tier is null").count() == 0
    assert churn.worklist(scores, 5).count() == 5
    save_model(chosen.model, f"{tmp_path}/model")
    assert rows(churn.with_probability(load_model(f"{tmp_path}/model"), planted.where("is_test")), "customer_id", "p") == rows(test, "customer_id", "p")


def test_unseen_category_scores(chosen, planted):
    odd = planted.limit(3).withColumn("country", F.lit("nowhere"))
    assert churn.with_probability(chosen.model, odd).where("p is null").count() == 0


@pytest.mark.parametrize("per_bucket", [3, 1000])
def test_exact_metrics_with_ties(spark, per_bucket):
    data = [(1, .9), (0, .8), (1, .8), (1, .7), (0, .7), (0, .3), (1, .3), (0, .1)]
    df = spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(data)], "id int, y int, p double")
    pos, neg = [p for y, p in data if y], [p for y, p in data if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0.0
    for t in sorted({p for _, p in data}, reverse=True):
        tp = sum(p >= t for p in pos)
        ap += (tp / len(pos) - seen) * tp / sum(p >= t for _, p in data)
        seen = tp / len(pos)
    q = churn.evaluate(df, "y", "p", rows_per_bucket=per_bucket).first()
    assert (q.roc_auc, q.pr_auc) == (round(auc, 4), round(ap, 4))
    assert (q.tn, q.fp, q.fn, q.tp) == (2, 2, 1, 3)
    assert (q.precision, q.recall, q.f1, q.baseline_churn_rate) == (0.6, 0.75, 0.6667, 0.5)
    curve = churn.roc_curve(df, "y", "p", rows_per_bucket=per_bucket)
    assert rows(curve, "fpr", "tpr")[0] == (0.0, 0.0) and rows(curve, "fpr", "tpr")[-1] == (1.0, 1.0)


def test_empty_deciles_are_listed(spark):
    df = spark.createDataFrame([(i, i % 2, i / 7) for i in range(7)], "id int, y int, p double")
    got = churn.decile_lift(df, "y", "p", "id").orderBy("decile").collect()
    assert [r.decile for r in got] == list(range(1, 11)) and (got[0].churn_rate, got[0].lift) == (0.0, 0.0)


def test_tier_bounds_are_right_closed(spark):
    df = spark.createDataFrame([(p, m("10")) for p in (0.0, 0.3, 0.30001, 0.6, 0.8, 0.80001, 1.0)], "p double, monetary decimal(12,2)")
    tiered = df.withColumn("risk_tier", churn.risk_tier(F.col("p")))
    assert [r.risk_tier for r in tiered.orderBy("p").collect()] == ["Low", "Low", "Medium", "Medium", "High", "Critical", "Critical"]
    assert rows(churn.risk_tier_summary(tiered), "risk_tier", "customers", "revenue_at_risk") == [
        ("Critical", 2, m("20.00")), ("High", 1, m("10.00")), ("Low", 2, m("0.00")), ("Medium", 2, m("0.00")),
        ("Total", 7, m("30.00"))]
    low = churn.risk_tier_summary(tiered.where("p < 0.2"))
    assert rows(low, "risk_tier", "customers", "revenue_at_risk") == [
        ("Critical", 0, m("0.00")), ("High", 0, m("0.00")), ("Low", 1, m("0.00")), ("Medium", 0, m("0.00")), ("Total", 1, m("0.00"))]


def test_missing_inputs_are_trained_on_and_scored(planted):
    holes = planted.withColumn("age", F.when(F.col("age") % 10 != 0, F.col("age")))
    model = churn.fit_one(holes.where(~F.col("is_test")))
    scores = churn.score_base(model, holes)
    assert scores.count() == planted.count()
    odd = F.isnan("churn_probability") | F.col("churn_probability").isNull() | F.col("risk_tier").isNull()
    assert scores.where(odd).count() == 0
    best = churn.worklist(scores, 5).collect()
    assert all(0.5 < r.churn_probability <= 1 for r in best)


def test_folds_have_the_auc_of_fits_of_their_own(planted):
    """The concurrent search gives what fitting each fold by hand gives."""
    train = planted.where(~F.col("is_test"))
    chosen = churn.train_select(train, candidates={"Logistic Regression": churn.logistic(1500, 20)})
    found = []
    for fold in range(5):
        inside, outside = train.where(F.col("fold") != fold), train.where(F.col("fold") == fold)
        weighted = churn.balance_weights(train)
        model = churn.Pipeline(stages=[*churn.preprocessing(inside), churn.logistic(1500, 20)]).fit(weighted.where(F.col("fold") != fold))
        found.append(churn.evaluate(churn.with_probability(model, outside), "churned", "p").first().roc_auc)
    assert chosen.leaderboard["Logistic Regression"] == pytest.approx(sum(found) / 5, abs=2e-4)


def test_boosting_stops_early_only_above_ten_thousand_rows(planted):
    assert not churn.default_candidates(10_000)["Gradient Boosting"].isSet("validationIndicatorCol")
    assert churn.default_candidates(10_001)["Gradient Boosting"].getValidationIndicatorCol() == "_watch"
    model = churn.fit_one(planted, churn.boosting(60, early_stop=True))
    assert 1 <= model.stages[-1].getNumTrees < 60


def test_registered_queries_train_every_round(spark, planted, monkeypatch, tmp_path):
    """The queries fit what the operator fits by default: 300 rounds, as the reference does."""
    from types import SimpleNamespace

    from tallyline.plans import catalogue
    seen = []

    def candidates(n_rows, rounds=300):
        seen.append(churn.boosting(rounds).getMaxIter())
        return {"Logistic Regression": churn.logistic(n_rows, 5)}
    monkeypatch.setattr(churn, "default_candidates", candidates)
    monkeypatch.setattr(catalogue, "_SELECTIONS", {})
    catalogue._selected(SimpleNamespace(spark=spark, directory=str(tmp_path)), planted)
    assert seen == [300]
