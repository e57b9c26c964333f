"""Validation queries and the scored quality gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.functions.columns import ratio
from tallyline.operators.filters import NA_SENTINELS, populated
from tallyline.operators.ordering import with_totals
from tallyline.session import never_broadcast
from tallyline.sources.schemas import CRITICAL_COLUMNS, FOREIGN_KEYS, PRIMARY_KEYS


def amount_outliers(df: DataFrame, amount: str, k: float = 4.0) -> DataFrame:
    """Rows more than k sample standard deviations above the mean."""
    x = F.col(amount).cast("double")
    bounded = with_totals(df, {"mean_amount": F.avg(x), "std_amount": F.stddev_samp(x)})
    return bounded.where(x > F.col("mean_amount") + k * F.col("std_amount"))


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows, and rows beyond the first of their key; null is one key value."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("scanned"),
                       F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failed"))


def validity_rules() -> dict[str, list[tuple[str, Column]]]:
    """Per table: check name and the condition of a bad row (null is not bad)."""
    # Check names.
    return {
        "fact_orders": [("fact_orders.total_amount >= 0", F.col("total_amount") < 0)],
        "fact_order_items": [("fact_order_items.quantity > 0", F.col("quantity") <= 0)],
        "dim_products": [("dim_products price > cost", F.col("unit_price") <= F.col("unit_cost"))],
        "dim_customers": [("dim_customers.age in [18,100]", ~F.col("age").between(18, 100))],
        "fact_reviews": [("fact_reviews.rating in [1,5]", ~F.col("rating").between(1, 5))],
    }


def _row_checks(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """All per-row checks of a table in one scan: (name, family, bad-row condition)."""
    counts = df.agg(F.count(F.lit(1)).alias("scanned"),
                    *[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
    rows = [F.struct(F.lit(name).alias("check"), F.lit(family).alias("family"),
                     F.col("scanned"), F.col(f"c{i}").alias("failed"))
            for i, (name, family, _) in enumerate(checks)]
    return counts.select(F.inline(F.array(*rows)))


def _labelled(counts: DataFrame, check: str, family: str) -> DataFrame:
    return counts.select(F.lit(check).alias("check"), F.lit(family).alias("family"), "scanned", "failed")


def referential_integrity(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                          sentinels: Sequence[str] = NA_SENTINELS) -> DataFrame:
    """Populated key values and those without a parent row.

    The child is counted per key value first: a key that fills a third of the table is
    one row when it meets the parent.
    """
    kind, parent_kind = child.schema[fk].dataType, parent.schema[pk].dataType
    same = kind == parent_kind
    child_key = F.col(fk) if same else F.col(fk).cast("string")
    parent_key = F.col(pk) if same else F.col(pk).cast("string")
    per_key = populated(child, fk, sentinels).groupBy(child_key.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(parent_key.alias("k")).distinct().withColumn("found", F.lit(True))
    return per_key.join(never_broadcast(known), "k", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("scanned"),
        F.coalesce(F.sum(F.when(F.col("found").isNull(), F.col("n"))), F.lit(0)).alias("failed"))


def orders_without_items_count(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct order ids, and those that no line refers to."""
    ids = orders.select("order_id").distinct()
    used = items.select("order_id").distinct().withColumn("found", F.lit(True))
    return ids.join(never_broadcast(used), "order_id", "left").agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(F.col("found").isNull()).alias("failed"))


def quality_report(tables: Mapping[str, DataFrame], critical: Mapping[str, list[str]] = CRITICAL_COLUMNS,
                   pks: Mapping[str, str] = PRIMARY_KEYS, fks: Sequence[tuple] = tuple(FOREIGN_KEYS),
                   rules: Mapping[str, list[tuple[str, Column]]] | None = None,
                   sentinels: Sequence[str] = NA_SENTINELS) -> DataFrame:
    """One row per check: scanned, failed, failure rate (%) and whether it passed.

    Checks on absent tables or columns are left out.
    """
    rules = validity_rules() if rules is None else rules
    parts: list[DataFrame] = []
    for table, df in tables.items():
        checks = [(f"{table}.{c} not null", "completeness", F.col(c).isNull())
                  for c in critical.get(table, []) if c in df.columns]
        checks += [(name, "validity", bad) for name, bad in rules.get(table, [])]
        if checks:
            parts.append(_row_checks(df, checks))
    for table, key in pks.items():
        if table in tables and key in tables[table].columns:
            parts.append(_labelled(duplicate_count(tables[table], key), f"{table}.{key} unique", "uniqueness"))
    for child, fk, parent, pk in fks:
        if (child in tables and parent in tables and fk in tables[child].columns
                and pk in tables[parent].columns):
            counts = referential_integrity(tables[child], fk, tables[parent], pk, sentinels)
            parts.append(_labelled(counts, f"{child}.{fk} -> {parent}.{pk}", "referential_integrity"))
    if "fact_orders" in tables and "fact_order_items" in tables:
        counts = orders_without_items_count(tables["fact_orders"], tables["fact_order_items"])
        parts.append(_labelled(counts, "every order has >=1 line item", "consistency"))
    report = reduce(DataFrame.unionByName, parts)
    return report.select(
        "check", "family", F.col("scanned").alias("records_scanned"), F.col("failed").alias("records_failed"),
        F.coalesce(ratio("failed", "scanned", scale=100, digits=4), F.lit(0)).alias("failure_rate_pct"),
        (F.col("failed") == 0).alias("passed"), F.lit("").alias("detail"))


def quality_score(report: DataFrame) -> DataFrame:
    """One row: 100 less the mean failure rate over all checks, and the check counts."""
    penalty = F.sum(F.when(~F.col("passed"), F.least(F.col("failure_rate_pct").cast("double"), F.lit(100.0))))
    return report.agg(
        F.coalesce(
            F.round(F.greatest(F.lit(0.0), F.lit(100.0) - F.coalesce(penalty, F.lit(0.0)) / F.count(F.lit(1))), 2),
            F.lit(100.0)).alias("score"),
        F.count(F.lit(1)).alias("checks_total"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(~F.col("passed")).alias("checks_failed"))


def require_quality(report: DataFrame, fail_below: float) -> float:
    """The score as a number; raises when it is below the threshold."""
    score = quality_score(report).first()["score"]
    if score < fail_below:
        raise ValueError(f"quality score {score} is below {fail_below}")
    return score
