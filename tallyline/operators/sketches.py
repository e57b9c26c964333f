"""Distinct counts that merge: HyperLogLog sketches per day, rolled up without the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

LG_K = 12


def relative_error(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """Bound on the error of an estimate; at four standard deviations one estimate in some
    ten thousand is outside it."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def daily_sketches(df: DataFrame, ts: str, id: str, by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """`day`, `by`, `sketch` of the distinct `id`s. A sketch has at most some 2**lg_k bytes,
    whatever it counts, so a hot day is map-side combined like any sum. Null ids do not count;
    rows without a time have a null day. Store it, partitioned by day if it is large."""
    return df.groupBy(F.col(ts).cast("date").alias("day"), *by).agg(
        F.hll_sketch_agg(F.col(id).cast("string"), F.lit(lg_k)).alias("sketch"))


def roll_up(sketches: DataFrame, unit: str = "month", by: Sequence[str] = ()) -> DataFrame:
    """`period` (first day of the week, month, quarter or year), `by` and the merged `sketch`,
    which can be stored and rolled up further: days of any stored table, in any order."""
    period = F.trunc(F.col("day"), unit) if unit != "day" else F.col("day")
    return sketches.groupBy(period.alias("period"), *by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimates(sketches: DataFrame, name: str = "distinct_count") -> DataFrame:
    """The sketches as numbers."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")
