"""Point-in-time churn: features, labels, training on MLlib, exact evaluation, scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import (Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler,
                                VectorSlicer)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tallyline.functions.columns import ratio
from tallyline.functions.derive import REVENUE_STATUSES
from tallyline.operators.filters import active_within, future, history, revenue_orders
from tallyline.operators.ordering import (ROWS_PER_BUCKET, even_bands, prefix_scan, top_k,
                                          with_totals)
from tallyline.session import cut_lineage

# Model inputs, in order.
NUMERIC_FEATURES = ["recency_days", "frequency", "monetary", "avg_order_value", "tenure_days",
                    "distinct_categories", "n_returns", "age"]
CATEGORICAL_FEATURES = ["country", "acquisition_channel", "customer_segment", "is_loyalty_member"]
LABEL = "churned"
# Upper bounds of the risk tiers, inclusive.
RISK_TIERS = [("Low", 0.3), ("Medium", 0.6), ("High", 0.8), ("Critical", 1.01)]


def churn_features(tables: Mapping[str, DataFrame], obs: str, active_days: int = 365,
                   status_in: Sequence[str] = REVENUE_STATUSES) -> DataFrame:
    """One row per customer active in the `active_days` before the observation date, from
    orders, lines and returns dated on or before it."""
    day = F.to_date(F.lit(obs))
    past = history(revenue_orders(tables["fact_orders"], status_in), obs)
    agg = (past.where(F.col("customer_id").isNotNull()).groupBy("customer_id")
           .agg(F.max("order_date").alias("last_order"), F.min("order_date").alias("first_order"),
                F.count_distinct("order_id").alias("frequency"), F.sum("total_amount").alias("monetary"),
                F.count("total_amount").alias("amounts"))
           .select("customer_id", F.datediff(day, "last_order").alias("recency_days"), "frequency",
                   "monetary", ratio("monetary", "amounts").alias("avg_order_value"),
                   F.datediff(day, "first_order").alias("tenure_days")))
    agg = active_within(agg, "recency_days", active_days)

    owner = past.select("order_id", "customer_id")
    lines = tables["fact_order_items"]
    if "order_date" in lines.columns:
        lines = lines.where(F.col("order_date") <= day)
    category = tables["dim_products"].select("product_id", "category")
    breadth = (lines.select("order_id", "product_id").join(owner, "order_id")
               .join(category, "product_id").where(F.col("category").isNotNull())
               .select("customer_id", "category").distinct()
               .groupBy("customer_id").agg(F.count(F.lit(1)).alias("distinct_categories")))

    out = agg.join(breadth, "customer_id", "left")
    if "fact_returns" in tables:
        ret = tables["fact_returns"]
        if "return_date" in ret.columns:
            ret = ret.where(F.col("return_date") <= day)
        per_order = ret.groupBy("order_id").agg(F.count("return_id").alias("n"))
        returned = per_order.join(owner, "order_id").groupBy("customer_id").agg(F.sum("n").alias("n_returns"))
        out = out.join(returned, "customer_id", "left")
    else:
        out = out.withColumn("n_returns", F.lit(0))
    attributes = tables["dim_customers"].select("customer_id", "age", *CATEGORICAL_FEATURES)
    return (out.join(attributes, "customer_id", "left")
            .withColumns({"distinct_categories": F.coalesce("distinct_categories", F.lit(0)),
                          "n_returns": F.coalesce("n_returns", F.lit(0)),
                          "is_loyalty_member": F.col("is_loyalty_member").cast("string")})
            .select("customer_id", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES))


def churn_labels(features: DataFrame, orders: DataFrame, obs: str, horizon: int = 183,
                 status_in: Sequence[str] = REVENUE_STATUSES) -> DataFrame:
    """Add the label: 1 if the customer has no revenue order in the `horizon` days after
    the observation date."""
    buyers = (future(revenue_orders(orders, status_in), obs, horizon)
              .select("customer_id").distinct().withColumn("_bought", F.lit(True)))
    return (features.join(buyers, "customer_id", "left")
            .withColumn(LABEL, F.when(F.col("_bought"), 0).otherwise(1)).drop("_bought"))


def stratified_split(df: DataFrame, label: str, id: str, test_share: float = 0.25, seed: int = 42,
                     folds: int = 5, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add `is_test` and `fold`, both balanced within each class.

    Rows are ordered by a seeded hash of the id, so the split does not depend on how the
    data is partitioned; the first share of every class is the test set.
    """
    mixed = cut_lineage(df.withColumn("_dice", F.xxhash64(F.col(id), F.lit(seed))))
    placed = prefix_scan(mixed, "_dice", id, by=[label], rows_per_bucket=rows_per_bucket, stored=True, size="_size")
    quota = F.round(F.col("_size") * test_share).cast("bigint")
    return (placed.withColumns({"is_test": F.col("row_number") <= quota,
                                "fold": (F.col("row_number") % folds).cast("int")})
            .drop("_dice", "_size", "row_number", "running_count"))


def balance_weights(df: DataFrame, label: str = LABEL, name: str = "weight") -> DataFrame:
    """Weight n / (2 * class size), so that both classes weigh the same."""
    totals = with_totals(df, {"_n": F.count(F.lit(1)), "_pos": F.sum(F.col(label).cast("bigint"))})
    size = F.when(F.col(label) == 1, F.col("_pos")).otherwise(F.col("_n") - F.col("_pos"))
    return totals.withColumn(name, ratio("_n", size * 2)).drop("_n", "_pos")


def preprocessing(df: DataFrame, numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
                  categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES)) -> list:
    """Stages: standardised numbers and one-hot categories in one `features` vector.

    A missing number becomes the median of the rows the stages are fitted on, so every row
    has a score. An unseen category encodes as all zeros. A category with two values keeps one column.
    """
    indexed = [f"_{c}_ix" for c in categorical]
    indexer = StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep",
                            stringOrderType="alphabetAsc").fit(df)
    filled = [f"_{c}_filled" for c in numeric]
    stages = [Imputer(inputCols=list(numeric), outputCols=filled, strategy="median"),
              VectorAssembler(inputCols=filled, outputCol="_num"),
              StandardScaler(inputCol="_num", outputCol="_num_std", withMean=True, withStd=True),
              indexer,
              # the last index is the "unseen" slot: dropping it leaves zeros for unseen values
              OneHotEncoder(inputCols=indexed, outputCols=[f"_{c}_oh" for c in categorical], dropLast=True)]
    parts = ["_num_std"]
    for c, labels in zip(categorical, indexer.labelsArray):
        if len(labels) == 2:
            stages.append(VectorSlicer(inputCol=f"_{c}_oh", outputCol=f"_{c}_one", indices=[1]))
        parts.append(f"_{c}_one" if len(labels) == 2 else f"_{c}_oh")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages


def logistic(n_rows: int, max_iter: int = 1000) -> LogisticRegression:
    """Class-balanced logistic regression with unit inverse penalty strength."""
    return LogisticRegression(labelCol=LABEL, featuresCol="features", weightCol="weight", maxIter=max_iter,
                              regParam=1.0 / max(n_rows, 1), standardization=False)


def boosting(rounds: int = 300, seed: int = 42, early_stop: bool = False) -> GBTClassifier:
    """Boosted trees on binned features, at most 32 leaves of 20 rows or more each.

    With `early_stop`, rows marked `_watch` are not trained on, and training ends before
    `rounds` at the first round that does not lower their error.
    """
    watch = {"validationIndicatorCol": "_watch", "validationTol": 1e-7} if early_stop else {}
    return GBTClassifier(labelCol=LABEL, featuresCol="features", maxIter=rounds, stepSize=0.08, maxDepth=5,
                         minInstancesPerNode=20, seed=seed, checkpointInterval=10, **watch)


def default_candidates(n_rows: int, rounds: int = 300) -> dict:
    """Boosting stops early above 10,000 rows."""
    return {"Logistic Regression": logistic(n_rows), "Gradient Boosting": boosting(rounds, early_stop=n_rows > 10_000)}


@dataclass
class Selection:
    """Result of `train_select`."""
    name: str
    model: PipelineModel
    leaderboard: dict[str, float]

    def leaderboard_frame(self, spark) -> DataFrame:
        rows = [(n, round(float(v), 4), n == self.name) for n, v in self.leaderboard.items()]
        return spark.createDataFrame(rows, "model string, cv_roc_auc double, selected boolean")


def _prepare(train: DataFrame, rows_per_task: int) -> tuple[DataFrame, int]:
    """Weighted training rows, stored in as few partitions as `rows_per_task` allows, and
    their count. All rows stay.

    A round of boosting is several jobs over all rows, and with few rows a job costs what
    its tasks cost to start; so partitions follow the rows, not the cores.
    """
    n = train.count()
    weighted = balance_weights(train).withColumn("_watch", F.pmod(F.xxhash64(*train.columns), F.lit(10)) == 0)
    return cut_lineage(weighted.coalesce(max(1, -(-n // rows_per_task)))), n


def train_select(train: DataFrame, candidates: dict | None = None, folds: int = 5, rounds: int = 300,
                 parallelism: int = 6, rows_per_task: int = 200_000) -> Selection:
    """Cross-validate each candidate by exact ROC-AUC on the `fold` column; the best is fitted
    on all rows.

    Every pair of a candidate and a fold is a fit of its own, and up to `parallelism` of them
    run at a time, as their jobs are small and follow one another. Medians and scales are
    fitted inside every fold, so a validation row never reaches its own preparation. One scan
    over the stacked scores gives all the AUCs. A fold without rows of both classes has no
    AUC and does not count.
    """
    rows, n = _prepare(train, rows_per_task)
    candidates = candidates or default_candidates(n, rounds)

    def one_fold(task: tuple[str, int]) -> DataFrame:
        name, fold = task
        inside = rows.where(F.col("fold") != fold)
        model = Pipeline(stages=[*preprocessing(inside), candidates[name]]).fit(inside)
        # a column of its own per fold: frames of one origin do not union while they share it
        scored = with_probability(model, rows.where(F.col("fold") == fold)).select(
            F.lit(name).alias("model"), F.lit(fold).alias("fold"), F.col(LABEL).cast("bigint").alias(LABEL), "p")
        return cut_lineage(scored)

    # the dear candidate first, so that no long fit starts last
    tasks = [(name, fold) for name in sorted(candidates, key=lambda c: not isinstance(candidates[c], GBTClassifier))
             for fold in range(folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        scored = list(pool.map(one_fold, tasks))
    stacked = reduce(DataFrame.unionByName, scored)
    auc = ranking_quality(threshold_scan(stacked, LABEL, "p", by=["model", "fold"]), by=["model", "fold"])
    board = {r["model"]: r["auc"] for r in auc.groupBy("model").agg(F.avg("roc_auc").alias("auc")).collect()}
    board = {name: board.get(name) or 0.0 for name in candidates}
    best = max(board, key=board.get)
    return Selection(best, Pipeline(stages=[*preprocessing(rows), candidates[best]]).fit(rows), board)


def fit_one(train: DataFrame, estimator=None, rows_per_task: int = 200_000) -> PipelineModel:
    """Fit a single candidate (default: logistic regression) without a search."""
    rows, n = _prepare(train, rows_per_task)
    return Pipeline(stages=[*preprocessing(rows), estimator or logistic(n)]).fit(rows)


def with_probability(model: PipelineModel, df: DataFrame, name: str = "p") -> DataFrame:
    """Model probability of churn, without the intermediate vectors."""
    keep = df.columns
    return model.transform(df).select(*keep, F.round(vector_to_array("probability")[1], 12).alias(name))


def threshold_scan(scored: DataFrame, label: str, p: str, by: Sequence[str] = (),
                   rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Per distinct score, from the highest down: its positives and negatives, and the
    true and false positives when everything at or above it is flagged.

    Equal scores are combined first, so ties of any size are one row.
    """
    per_score = scored.groupBy(*by, F.col(p).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum(F.lit(1) - F.col(label).cast("bigint")).alias("neg"))
    # within a group the score is unique, so it is its own tie-break
    keyed = per_score.withColumn("score_id", F.col("score"))
    return (prefix_scan(keyed, "score", "score_id", sums=["pos", "neg"], by=by, descending=True,
                        rows_per_bucket=rows_per_bucket)
            .withColumnsRenamed({"running_pos": "tp", "running_neg": "fp"})
            .drop("score_id", "running_count"))


def ranking_quality(scan: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC (ties count half) and average precision from a threshold scan."""
    totals = scan.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    if by:
        joined = scan.join(totals, list(by))
    else:
        joined = (scan.withColumn("_t", totals.select(F.struct("_p", "_n")).scalar())
                  .withColumns({"_p": F.col("_t._p"), "_n": F.col("_t._n")}))
    # doubled, so that half ties stay whole numbers
    wins = F.col("pos").cast("decimal(19,0)") * (2 * F.col("_n") - 2 * F.col("fp") + F.col("neg")).cast("decimal(19,0)")
    precision_part = ratio("pos", "_p") * ratio("tp", F.col("tp") + F.col("fp"))
    return joined.groupBy(*by).agg(
        ratio(F.sum(wins), F.first("_p").cast("double") * F.first("_n").cast("double") * 2).alias("roc_auc"),
        F.sum(precision_part).alias("pr_auc"))


def confusion(scan: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Confusion counts at the threshold, from the per-score counts of a threshold scan."""
    flagged = F.col("score") >= threshold

    def counted(condition, c):
        return F.coalesce(F.sum(F.when(condition, F.col(c))), F.lit(0))
    return scan.agg(counted(~flagged, "neg").alias("tn"), counted(flagged, "neg").alias("fp"),
                    counted(~flagged, "pos").alias("fn"), counted(flagged, "pos").alias("tp"))


def evaluate(scored: DataFrame, label: str, p: str, threshold: float = 0.5,
             rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row: exact ROC-AUC, average precision, precision, recall, F1, base rate and the
    confusion matrix at the threshold. The scored rows are read once."""
    scan = threshold_scan(scored, label, p, rows_per_bucket=rows_per_bucket)
    quality = ranking_quality(scan)
    out = confusion(scan, threshold).withColumn(
        "_q", quality.select(F.struct("roc_auc", "pr_auc")).scalar())

    def rounded(c):
        return F.round(F.coalesce(c, F.lit(0.0)), 4)
    return out.select(
        F.round("_q.roc_auc", 4).alias("roc_auc"), F.round("_q.pr_auc", 4).alias("pr_auc"),
        rounded(ratio("tp", F.col("tp") + F.col("fp"))).alias("precision"),
        rounded(ratio("tp", F.col("tp") + F.col("fn"))).alias("recall"),
        rounded(ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn"))).alias("f1"),
        rounded(ratio(F.col("tp") + F.col("fn"), F.col("tp") + F.col("fn") + F.col("tn") + F.col("fp")))
        .alias("baseline_churn_rate"), "tn", "fp", "fn", "tp")


def roc_curve(scored: DataFrame, label: str, p: str, points: int = 60,
              rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """About `points` (fpr, tpr) pairs at evenly spaced thresholds, and the end points."""
    scan = cut_lineage(threshold_scan(scored, label, p, rows_per_bucket=rows_per_bucket))
    m = scan.count()
    step = max(1, m // points)
    whole = with_totals(scan, {"_p": F.sum("pos"), "_n": F.sum("neg")})
    picked = whole.where(((F.col("row_number") % step) == 0) | (F.col("row_number") == m))
    curve = picked.select(F.col("row_number").alias("point"), F.round(ratio("fp", "_n"), 4).alias("fpr"),
                          F.round(ratio("tp", "_p"), 4).alias("tpr"))
    origin = scored.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("point"),
                                                 F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(curve)


def decile_lift(scored: DataFrame, label: str, p: str, id: str, n: int = 10,
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Churn rate and lift over the base rate per band of descending score; ties by id."""
    banded = even_bands(scored.select(id, label, p), p, id, n, "decile", rows_per_bucket=rows_per_bucket)
    y = F.col(label).cast("bigint")
    base = banded.agg(ratio(F.sum(y), F.count(y))).scalar()
    rates = banded.groupBy("decile").agg(F.sum(y).alias("s"), F.count(y).alias("c"))
    spine = scored.sparkSession.range(1, n + 1).select(F.col("id").cast("int").alias("decile"))
    rate = F.coalesce(ratio("s", "c"), F.lit(0.0))
    return (spine.join(F.broadcast(rates), "decile", "left").withColumn("_base", base)
            .select("decile", F.round(rate, 4).alias("churn_rate"),
                    F.round(F.coalesce(ratio(rate, "_base"), F.lit(0.0)), 2).alias("lift")))


def permutation_importance(model: PipelineModel, df: DataFrame, columns: Sequence[str], label: str = LABEL,
                           id: str = "customer_id", repeats: int = 5, seed: int = 42,
                           rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Mean ROC-AUC drop when one raw column is shuffled among the rows.

    A repeat pairs the row at position i in id order with the row at position i in a
    seeded hash order. Every row is then scored once as it is and once per column with the
    partner's value, in a single pass, and the AUC of all variants comes from one scan.
    """
    columns = list(columns)
    rows = df.select(id, label, *columns)
    at = cut_lineage(prefix_scan(rows, id, id, rows_per_bucket=rows_per_bucket)
                     .withColumnRenamed("row_number", "_pos").drop("running_count"))
    dice = (at.select(id, *columns).withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
            .withColumn("_dice", F.xxhash64(F.col(id), F.lit(seed), "repeat")))
    shuffled = prefix_scan(dice, "_dice", id, by=["repeat"], rows_per_bucket=rows_per_bucket)
    partner = shuffled.select(F.col("row_number").alias("_pos"), "repeat", F.struct(*columns).alias("_partner"))
    swapped = F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 *[(F.col(f"_partner.{k}") if k == c else F.col(k)).alias(k) for k in columns])
        for c in columns])
    variants = (at.join(partner, "_pos").select(label, "repeat", F.explode(swapped).alias("v"))
                .select(label, "repeat", "v.*"))
    original = at.select(label, F.lit(0).alias("repeat"), F.lit("").alias("feature"), *columns)
    stacked = variants.unionByName(original)
    scored = with_probability(model, stacked).select("repeat", "feature", label, "p")
    scan = threshold_scan(scored, label, "p", by=["repeat", "feature"], rows_per_bucket=rows_per_bucket)
    auc = cut_lineage(ranking_quality(scan, by=["repeat", "feature"]))
    base = auc.where(F.col("repeat") == 0).select("roc_auc").scalar()
    return (auc.where(F.col("repeat") > 0).groupBy("feature")
            .agg(F.avg("roc_auc").alias("m"))
            .select("feature", F.round(base - F.col("m"), 4).alias("importance")))


def risk_tier(p: Column) -> Column:
    """Tier by upper bound, inclusive on the right."""
    return F.coalesce(*[F.when(p <= bound, F.lit(name)) for name, bound in RISK_TIERS])


def score_base(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Churn probability (four decimals) and risk tier of every eligible customer.

    The rows come unsorted; `worklist` returns the leading ones.
    """
    scored = with_probability(model, df, "_p")
    out = scored.withColumns({"churn_probability": F.round("_p", 4), "risk_tier": risk_tier(F.col("_p"))})
    if LABEL in df.columns:
        out = out.withColumnRenamed(LABEL, "actual_churned")
    return out.drop("_p")


def worklist(scores: DataFrame, k: int, id: str = "customer_id") -> DataFrame:
    return top_k(scores, "churn_probability", id, k)


def risk_tier_summary(scores: DataFrame) -> DataFrame:
    """Customers and revenue per tier, and in all; revenue is at risk in High and Critical.
    All four tiers are listed, with 0 where nobody is in one."""
    money = F.col("monetary")
    at_risk = F.when(F.col("risk_tier").isin("High", "Critical"), money)
    sums = [F.count(F.lit(1)).alias("customers"), F.coalesce(F.sum(money), F.lit(0)).alias("monetary"),
            F.coalesce(F.sum(at_risk), F.lit(0)).alias("revenue_at_risk")]
    found = scores.groupBy("risk_tier").agg(*sums)
    tiers = scores.sparkSession.createDataFrame([(name,) for name, _ in RISK_TIERS], "risk_tier string")
    listed = tiers.join(found, "risk_tier", "left").select(
        "risk_tier", *[F.coalesce(c, F.lit(0)).cast(found.schema[c].dataType).alias(c)
                       for c in ("customers", "monetary", "revenue_at_risk")])
    return listed.unionByName(scores.agg(*sums).withColumn("risk_tier", F.lit("Total")))


def run_facts(split: DataFrame, obs: str, horizon: int) -> DataFrame:
    """One row: sizes of the split, customers scored, observation date and horizon."""
    return split.agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test"),
                     F.count(F.lit(1)).alias("n_scored")).withColumns(
        {"observation_date": F.lit(obs), "horizon_days": F.lit(horizon)})


def churn_report(tables: Mapping[str, DataFrame], obs: str, horizon: int = 183, active_days: int = 365,
                 rounds: int = 300, seed: int = 42) -> dict[str, object]:
    """The whole workflow: features and labels, split, selection, evaluation, scores."""
    features = churn_features(tables, obs, active_days)
    labelled = cut_lineage(churn_labels(features, tables["fact_orders"], obs, horizon))
    split = cut_lineage(stratified_split(labelled, LABEL, "customer_id", seed=seed))
    chosen = train_select(split.where(~F.col("is_test")), rounds=rounds)
    test = cut_lineage(with_probability(chosen.model, split.where("is_test")))
    scores = cut_lineage(score_base(chosen.model, labelled))
    return {"selection": chosen, "metrics": evaluate(test, LABEL, "p"),
            "roc_curve": roc_curve(test, LABEL, "p"),
            "decile_lift": decile_lift(test, LABEL, "p", "customer_id"),
            "feature_importance": permutation_importance(
                chosen.model, test.drop("p"), [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES], seed=seed),
            "scores": scores, "risk_tiers": risk_tier_summary(scores),
            "run_facts": run_facts(split, obs, horizon)}
