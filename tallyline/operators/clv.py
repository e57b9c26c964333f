"""Customer value ahead: spend after an observation date, one linear model per segment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Interaction, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from tallyline.functions.columns import ratio
from tallyline.functions.derive import REVENUE_STATUSES
from tallyline.operators.churn import churn_features
from tallyline.operators.filters import future, revenue_orders
from tallyline.session import cut_lineage

INPUTS = ("recency_days", "frequency", "monetary", "avg_order_value", "tenure_days")
TARGET = "spend_ahead"


def clv_rows(tables: Mapping[str, DataFrame], obs: str, horizon: int = 183, active_days: int = 365,
             status_in: Sequence[str] = REVENUE_STATUSES) -> DataFrame:
    """Features of the customers active before the observation date, from what is dated on or
    before it, and `spend_ahead`: their revenue orders in the `horizon` days after it, 0 if none."""
    ahead = (future(revenue_orders(tables["fact_orders"], status_in), obs, horizon)
             .groupBy("customer_id").agg(F.sum("total_amount").alias(TARGET)))
    rows = churn_features(tables, obs, active_days, status_in)
    return (rows.join(ahead, "customer_id", "left")
            .withColumn(TARGET, F.coalesce(TARGET, F.lit(0)).cast("double"))
            .select("customer_id", "customer_segment", *[F.col(c).cast("double").alias(c) for c in INPUTS], TARGET))


def fit_clv(train: DataFrame, segment: str = "customer_segment", inputs: Sequence[str] = INPUTS,
            penalty: float = 1e-6) -> PipelineModel:
    """One model per segment, in one fit: the segment's indicator times an intercept and every
    input. Without common terms that is the same as a regression in each segment, but one pass
    over the rows adds up all the normal equations. A null segment is one of its own, an
    unseen one scores 0; a missing input is 0. The slight penalty keeps equal inputs solvable."""
    filled = [f"_{c}" for c in inputs]
    stages = [
        StringIndexer(inputCol="_segment", outputCol="_ix", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=["_ix"], outputCols=["_hot"], dropLast=True),
        VectorAssembler(inputCols=["_one", *filled], outputCol="_in"),
        Interaction(inputCols=["_hot", "_in"], outputCol="features"),
        LinearRegression(labelCol=TARGET, featuresCol="features", predictionCol="predicted", fitIntercept=False,
                         regParam=penalty, solver="normal", standardization=True)]
    return Pipeline(stages=stages).fit(_with_inputs(train, segment, inputs))


def _with_inputs(df: DataFrame, segment: str, inputs: Sequence[str]) -> DataFrame:
    return df.withColumns({"_segment": F.coalesce(F.concat(F.lit("="), F.col(segment).cast("string")), F.lit("none")), "_one": F.lit(1.0),
                           **{f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in inputs}})


def predict_clv(model: PipelineModel, df: DataFrame, segment: str = "customer_segment",
                inputs: Sequence[str] = INPUTS) -> DataFrame:
    """`df` with `predicted`, the spend ahead; never below zero."""
    scored = model.transform(_with_inputs(df, segment, inputs))
    return scored.select(*df.columns, F.greatest(F.col("predicted"), F.lit(0.0)).alias("predicted"))


def clv_errors(train: DataFrame, test: DataFrame, segment: str = "customer_segment",
               inputs: Sequence[str] = INPUTS) -> DataFrame:
    """Out-of-time errors per segment: `n_train`, `n_test`, `mean_error` of always saying the
    training mean of the segment, `model_error`, both mean absolute errors on `test`, whose
    observation date should be after that of `train`. Segments without test rows are listed."""
    train, test = cut_lineage(train), cut_lineage(test)
    known = train.groupBy(segment).agg(F.count(F.lit(1)).alias("n_train"), F.avg(TARGET).alias("_mean"))
    scored = predict_clv(fit_clv(train, segment, inputs), test, segment, inputs)
    means = known.select(F.col(segment).alias("_s"), "_mean")
    rated = scored.join(F.broadcast(means), F.col(segment).eqNullSafe(F.col("_s")), "left")
    errors = rated.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n_test"),
        ratio(F.sum(F.abs(F.col(TARGET) - F.coalesce("_mean", F.lit(0.0)))), F.count(F.lit(1))).alias("mean_error"),
        ratio(F.sum(F.abs(F.col(TARGET) - F.col("predicted"))), F.count(F.lit(1))).alias("model_error"))
    left = known.select(segment, "n_train")
    return left.join(errors.withColumnRenamed(segment, "_s"), F.col(segment).eqNullSafe(F.col("_s")), "full_outer").select(
        F.coalesce(segment, "_s").alias(segment), F.coalesce("n_train", F.lit(0)).alias("n_train"),
        F.coalesce("n_test", F.lit(0)).alias("n_test"), "mean_error", "model_error")
